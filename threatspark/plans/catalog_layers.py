"""Registered queries over files and layer tables that Spark writes from the
driver's tables: the layer pipeline end to end, reports, quarantine, table
replacement, and the small row operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatspark.functions.strings import cve_of, lowercase_in
from threatspark.operators import incremental as inc
from threatspark.operators import quality
from threatspark.operators.merge import commit_table, read_appended, read_current, read_bucketed, replace_bucketed, rows_of, upsert_bucketed
from threatspark.plans import catalog, feeds, findings, layers
from threatspark.plans import fact as fact_mod
from threatspark.plans.catalog import _scratch, query
from threatspark.plans.silver import silver_epss, silver_nvd
from threatspark.session import materialised, shuffles_removed
from threatspark.sources import feeds as src
from threatspark.sources.epss import bronze_epss
from threatspark.sources.pages import all_hrefs, page_metadata
from threatspark.sources.tables import read_driver_table

RUN = _dt.datetime(2024, 6, 1)
FIRST, SECOND = _dt.datetime(2024, 1, 1), _dt.datetime(2024, 2, 1)


# ------------------------------------------------------------------ layers to fact

def _land_feeds(spark: SparkSession, sf: str, base: str) -> dict[str, str]:
    """The five feeds in their landed formats. JSON documents of bounded size, one per line."""
    nvd = feeds.feed_nvd(spark, sf)
    text = lambda c: F.transform(c, lambda x: F.struct(F.lit("en").alias("lang"), x.alias("value")))
    cve = F.struct(
        F.col("cve_id").alias("id"), F.col("vuln_status").alias("vulnStatus"),
        F.date_format("last_modified", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("lastModified"),
        text(F.col("descriptions")).alias("descriptions"),
        F.transform("references", lambda x: F.struct(x.alias("url"))).alias("references"),
        F.transform("weaknesses", lambda x: F.struct(F.array(F.struct(F.lit("en").alias("lang"), x.alias("value"))).alias("description"))).alias("weaknesses"),
        F.map_filter(F.create_map(  # the other versions are present, but not scored (Q8)
            F.lit("cvssMetricV31"), F.col("metrics_cvssMetricV31"), F.lit("cvssMetricV40"), F.col("metrics_cvssMetricV31"),
            F.lit("cvssMetricV2"), F.col("metrics_cvssMetricV31")), lambda k, v: v.isNotNull()).alias("metrics"))
    page = F.floor(F.conv(F.substring_index("cve_id", "-", -1), 10, 10).cast("long") / 500)
    nvd.groupBy(page.alias("p")).agg(F.collect_list(F.struct(cve.alias("cve"))).alias("vulnerabilities")).select(  # at most 500
        F.to_json(F.struct("vulnerabilities")).alias("value")).write.text(base + "/nvd")
    kev = feeds.feed_kev(spark, sf)
    entry = F.struct(F.col("cve_id").alias("cveID"), F.col("vendor_project").alias("vendorProject"), "product",
                     F.col("vulnerability_name").alias("vulnerabilityName"), F.col("date_added").alias("dateAdded"),
                     F.col("required_action").alias("requiredAction"),
                     F.col("known_ransomware_campaign_use").alias("knownRansomwareCampaignUse"), "cwes")
    kev.groupBy(page.alias("p")).agg(F.collect_list(entry).alias("vulnerabilities")).select(
        F.to_json(F.struct(F.lit("2024.12.01").alias("catalogVersion"), "vulnerabilities")).alias("value")).write.text(base + "/kev")
    epss = materialised(feeds.feed_epss(spark, sf), "feed-epss")  # read for rows and for both kinds of heads
    day = F.substring("date", 1, 4)
    lines = epss.select(day.alias("y"), F.lit(2).alias("o"), F.concat_ws(",", "cve", "epss", "percentile").alias("value"))
    heads = epss.select(day.alias("y")).distinct()
    head = heads.select("y", F.lit(0).alias("o"), F.concat(F.lit("#model_version:v1,score_date:"), "y", F.lit("-12-31T00:00:00+0000")).alias("value"))
    names = heads.select("y", F.lit(1).alias("o"), F.lit("cve,epss,percentile").alias("value"))
    (head.unionByName(names).unionByName(lines).repartition("y").sortWithinPartitions("y", "o").drop("o")
     .write.partitionBy("y").option("compression", "gzip").text(base + "/epss"))
    x = materialised(feeds.feed_exploit(spark, sf), "feed-exploit")  # read for the index and for the pages
    have = {"id", "file", "date_published", "date_updated", "type", "platform", "port", "source_url"}
    x.select(*[F.col(c) if c in have else F.array_join("codes", ";").alias(c) if c == "codes"
               else F.col("verified").cast("string").alias(c) if c == "verified" else F.lit(None).cast("string").alias(c)
               for c in src.EXPLOIT_INDEX_COLUMNS]).write.option("header", True).option("escape", '"').csv(base + "/exploit/index")
    # a page for every other exploit; its meta tag repeats the codes, its icon the flag
    paged = x.filter(F.col("id").cast("long") % 2 == 0)
    html = F.concat(F.lit('<META CONTENT="'), F.array_join("codes", ", "), F.lit(', Remote" NAME=keywords><i class="mdi '),
                    F.when(F.col("verified"), F.lit("mdi-check")).otherwise(F.lit("mdi-check-circle")), F.lit('"></i>'))
    paged.select("id", F.col("source_url").alias("url"), html.alias("html")).write.parquet(base + "/exploit/pages")
    mods, refs = feeds.feed_modules(spark, sf), feeds.feed_module_refs(spark, sf)
    rec = mods.join(refs.groupBy("fullname").agg(F.array_sort(F.collect_list("ref")).alias("references")), "fullname", "left")
    rec.select(F.to_json(F.create_map("fullname", F.struct("name", "type", "platform", "mod_time", "references"))).alias("value")) \
        .write.text(base + "/modules")
    return {"nvd": base + "/nvd", "cisa": base + "/kev", "epss": base + "/epss", "exploit": base + "/exploit", "metasploit": base + "/modules"}


def _by_lines() -> dict[str, layers.SourceSpec]:
    """The registered sources, with readers for a document per line."""
    from dataclasses import replace
    r = layers.REGISTRY
    return {
        "nvd": replace(r["nvd"], reader=lambda s, p, since: src.bronze_nvd(src.read_nvd_pages(s, p, lines=True))),
        "cisa": replace(r["cisa"], reader=lambda s, p, since: src.read_kev(s, p, lines=True)),
        "epss": r["epss"], "exploit": r["exploit"],
        "metasploit": replace(r["metasploit"], reader=lambda s, p, since: src.read_modules(s, p, since, lines=True))}


@query("fact_from_layers")
def fact_from_layers(spark: SparkSession, sf: str) -> DataFrame:
    """A1-A8, B1-B10, C3, C4, C10, C11, G10 end to end: the feeds are written in
    their landed formats, loaded through bronze, silver and gold, and the star
    schema is built from the committed gold tables behind the rule check."""
    base = _scratch(spark, "layers")
    landing = _land_feeds(spark, sf, base + "/landing")
    status = layers.run_layers(spark, base + "/lake", landing, run_ts=RUN, registry=_by_lines())
    failed = status.filter("status <> 'ok'").collect()  # at most a row per source and layer
    if failed:
        raise RuntimeError(f"layer loads failed: {failed}")
    return layers.build_star(spark, base + "/lake", RUN).select("cve_id", "vrr_score")


# ------------------------------------------------------------------ a source of one's own

def _part_source(name: str = "parts") -> layers.SourceSpec:
    """Hooks of a source over landed Parquet; names in capitals and prices as text."""
    def silver(b: DataFrame) -> tuple[DataFrame, DataFrame]:
        from threatspark.functions.casts import split_quarantine
        rows = b.select("id", F.upper("name").alias("name"), F.col("price").try_cast("double").alias("price"), "seen")
        return split_quarantine(rows, {"missing_key": F.col("id").isNull() | (F.col("id") == ""), "price_not_a_number": F.col("price").isNull()})
    return layers.SourceSpec(name, lambda s, p, since: s.read.parquet(p), lambda d: d, "id", "seen", "1970-01-01", silver, "id",
                             ("seen", "seen"), gold_exclude=["name"], gold_manual={"origin": "parts"})


def _two_deliveries(spark: SparkSession, sf: str, base: str, root: str) -> list[DataFrame]:
    """All parts, then a second delivery: every third part at a new price, and a
    few parts that the first one lacked; each part's price is text, every
    eleventh unreadable. Returns the status of both runs."""
    p = read_driver_table(spark, sf, "part")
    k = F.col("p_partkey")

    def rows(df: DataFrame, factor: int, seen: str) -> DataFrame:
        price = F.when(k % 11 == 0, F.lit("n/a")).otherwise((F.col("p_size") * factor).cast("string"))
        return df.select(k.cast("string").alias("id"), F.col("p_name").alias("name"), price.alias("price"), F.lit(seen).alias("seen"))

    rows(p.filter(k % 7 != 0), 1, "2024-01-01").write.parquet(base + "/first")
    rows(p.filter((k % 3 == 0) | (k % 7 == 0)), 2, "2024-02-01").write.parquet(base + "/second")
    sources = {"parts": _part_source(), "broken": _part_source("broken")}
    return [layers.run_layers(spark, root, {"parts": f"{base}/{n}", "broken": f"{base}/nowhere"}, run_ts=t, registry=sources)
            for n, t in (("first", FIRST), ("second", SECOND))]


@query("custom_source")
def custom_source(spark: SparkSession, sf: str) -> DataFrame:
    """Gold of a source added through the registry, after two deliveries."""
    base = _scratch(spark, "custom")
    _two_deliveries(spark, sf, base, base + "/lake")
    g = read_current(spark, base + "/lake/gold/parts")
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return g.select("id", "price", "seen", "origin", day("gold_created_at"), day("gold_updated_at"))


@query("gold_any_run_ts")
def gold_any_run_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after three deliveries, the second stamped like the
    first and the third earlier than both: gold follows silver's commits."""
    base = _scratch(spark, "stamps")
    p = read_driver_table(spark, sf, "part")
    k, sources = F.col("p_partkey"), {"parts": _part_source()}
    for n, (held, ts) in enumerate([(k % 7 != 0, SECOND), ((k % 3 == 0) | (k % 7 == 0), SECOND), (k % 5 == 0, FIRST)], 1):
        rows = p.filter(held).select(k.cast("string").alias("id"), F.col("p_name").alias("name"), (F.col("p_size") * n).cast("string").alias("price"),
                                     F.lit(f"2024-0{n}-01").alias("seen"))
        rows.write.parquet(f"{base}/land{n}")
        layers.run_layers(spark, base + "/lake", {"parts": f"{base}/land{n}"}, run_ts=ts, registry=sources)
    return read_current(spark, base + "/lake/gold/parts").select("id", "price", "seen")


@query("rows_per_interval")
def rows_per_interval(spark: SparkSession, sf: str) -> DataFrame:
    """J12 with overlapping intervals of unlike length: line items shipped
    while a part is on offer, from a day to over five years long. Offers run
    between whole days, so the items are added up by day first."""
    days = F.when(F.col("p_partkey") % 50 == 0, F.col("p_size") * 40).otherwise(F.col("p_size")).cast("int")
    start = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("p_partkey") * 7 % 2400).cast("int"))
    offers = read_driver_table(spark, sf, "part").select("p_partkey", start.alias("start"), F.date_add(start, days).alias("stop"))
    items = read_driver_table(spark, sf, "lineitem").groupBy(inc.day_or_within("l_shipdate").alias("shipped")).agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    pairs = inc.join_intervals(items, "shipped", offers, "start", "stop")
    return pairs.groupBy("p_partkey").agg(F.sum("n").alias("n_rows"), F.sum("q").alias("quantity"))


@query("growing_table")
def growing_table(spark: SparkSession, sf: str) -> DataFrame:
    """C1 by linear hashing: a table that starts with the orders of few
    customers, then gets all orders at once, then the upsert's batch, at 5,000
    rows a bucket; with the columns of upsert_bucketed_result."""
    path = _scratch(spark, "growing") + "/orders"
    t = catalog._orders_target(spark, sf).drop("created_at", "updated_at", "VRRScore")
    upsert_bucketed(spark, path, t.filter("o_custkey < 10"), "o_orderkey", per_bucket=5000)
    for rows in (t, catalog._orders_incoming(spark, sf)):
        upsert_bucketed(spark, path, rows, "o_orderkey", per_bucket=5000)
    return read_bucketed(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "feed")


@query("fact_incremental")
def fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The fact refreshed after each of three deliveries to
    gold. At first every other CVE is missing, and exploits, modules, EPSS and
    KEV rows are wrong: exploits are dated in the future and modules too, so
    they win everywhere; the later deliveries put them right, so their CVEs
    fall back to the right winners, and bring the missing CVEs."""
    root = _scratch(spark, "refresh") + "/lake"
    right = {"nvd": feeds.feed_nvd(spark, sf), "cisa": feeds.feed_kev(spark, sf), "epss": feeds.feed_epss(spark, sf), "exploit": feeds.feed_exploit(spark, sf)}
    refs = feeds.feed_module_refs(spark, sf).withColumn("slice", F.pmod(F.xxhash64("ref"), F.lit(64)))
    held = refs.repartition("fullname", "slice").groupBy("fullname", "slice").agg(F.collect_set("ref").alias("references"))  # a 64th of a module's CVEs in a row
    body = feeds.feed_modules(spark, sf)
    right["metasploit"] = (body.drop("references").join(held, "fullname").withColumn("fullname", F.concat_ws("#", "fullname", "slice")).drop("slice"))
    right = {n: materialised(df, f"feed-{n}") for n, df in right.items()}  # each is delivered three times
    half = lambda n: F.pmod(F.xxhash64(layers._STAR[n][1]), F.lit(2)) == 0
    wrong = {"cisa": right["cisa"].withColumn("known_ransomware_campaign_use", F.lit("Known")), "epss": right["epss"].withColumn("epss", F.lit(0.99).cast(right["epss"].schema["epss"].dataType)),
             "exploit": right["exploit"].withColumn("date_published", F.lit("2999-01-01")).withColumn("codes", F.transform("codes", F.reverse)),
             "metasploit": right["metasploit"].withColumn("mod_time", F.lit("2999-01-01 00:00:00 +0000"))}
    deliveries = [{"nvd": right["nvd"].filter(half("nvd")), **wrong}, {n: df.filter(half(n)) for n, df in right.items() if n != "nvd"},
                  {n: df.filter(~half(n)) for n, df in right.items()}]
    for n, tables in enumerate(deliveries):
        for name, rows in tables.items():
            upsert_bucketed(spark, f"{root}/gold/{name}", rows.filter(F.col(layers._STAR[name][1]).isNotNull()), layers._STAR[name][1])
        layers.refresh_star(spark, root, RUN)
    return read_current(spark, root + "/star/fct_final").select("cve_id", "vrr_score")


@query("fact_rows_by_key")
def fact_rows_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """J5 by skipping: rows of the stored fact for a few CVEs (buckets, sorted
    pages, Bloom filters) and for many (a join), with nulls, repeats and unknown CVEs among them."""
    path = _scratch(spark, "fact-by-key")
    rows = feeds.feed_nvd(spark, sf).count()  # the fact has a row for each; counting the fact would work it out
    replace_bucketed(spark, fact_mod.fact_from_feeds(spark, sf), path, "cve_id", rows=rows, per_bucket=2_000)
    n = read_driver_table(spark, sf, "nation")
    few = n.select(F.explode(F.array(cve_of(F.col("n_nationkey") * 40), cve_of(F.col("n_regionkey") * 40), F.lit(None).cast("string"))).alias("k"))
    many = read_driver_table(spark, sf, "lineitem").select(cve_of(F.col("l_partkey") * 2).alias("k"))
    return rows_of(spark, path, few).select("cve_id", "vrr_score", F.lit("few").alias("asked")).unionByName(
        rows_of(spark, path, many).select("cve_id", "vrr_score", F.lit("many").alias("asked")))


@query("fact_colocated")
def fact_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """The fact's inputs stored bucketed by CVE, then joined without a shuffle."""
    from threatspark.plans import colocated
    folder = colocated.store_colocated(
        spark, feeds.feed_nvd(spark, sf), feeds.feed_kev(spark, sf), feeds.feed_epss(spark, sf), feeds.feed_exploit(spark, sf),
        feeds.feed_modules(spark, sf), feeds.feed_module_refs(spark, sf), _scratch(spark, "colocated"),
        tasks=feeds.line_tasks(spark, sf))
    return colocated.fact_colocated(spark, folder).select("cve_id", "vrr_score")


@query("layer_status")
def layer_status(spark: SparkSession, sf: str) -> DataFrame:
    """The status rows of both runs; one source fails at every bronze load, the other goes on."""
    base = _scratch(spark, "status")
    one, two = _two_deliveries(spark, sf, base, base + "/lake")
    both = one.withColumn("run", F.lit(1)).unionByName(two.withColumn("run", F.lit(2)))
    return both.select("run", "source", "layer", F.split("status", ":")[0].alias("status"), "rows")


@query("quarantine_rows")
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    """the rows that silver rejected in either run, each kept with its reason and run."""
    base = _scratch(spark, "quarantine")
    _two_deliveries(spark, sf, base, base + "/lake")
    q = read_appended(spark, base + "/lake/quarantine/silver/parts")
    return q.select("id", "reason", "seen", F.date_format("quarantined_at", "yyyy-MM-dd").alias("run"))


@query("replicate_tables")
def replicate_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The copy lacks what the second delivery changed, as only new keys are inserted."""
    base = _scratch(spark, "replicate")
    sources = {"parts": _part_source()}
    p = read_driver_table(spark, sf, "part")
    for n, price in ((0, "p_size"), (1, "p_size * 2")):
        rows = p.filter(f"p_partkey % 7 <> 0 OR {n} = 1").selectExpr(
            "cast(p_partkey AS string) AS id", "p_name AS name", f"cast({price} AS string) AS price", f"'2024-0{n + 1}-01' AS seen")
        rows.write.parquet(f"{base}/land{n}")
        layers.run_layers(spark, base + "/lake", {"parts": f"{base}/land{n}"}, run_ts=(FIRST, SECOND)[n], registry=sources)
        layers.replicate(spark, base + "/lake", base + "/copy", tables=[("gold", "parts")], registry=sources)
    return read_current(spark, base + "/copy/gold/parts").select("id", "price")


@query("replace_report")
def replace_report(spark: SparkSession, sf: str) -> DataFrame:
    """A table's contents replaced as a whole; a reader sees the last commit."""
    path = _scratch(spark, "replace") + "/report"
    o = read_driver_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    commit_table(spark, o, path)
    commit_table(spark, o.filter("o_orderstatus <> 'F'").withColumn("state", F.lower("o_orderstatus")), path)
    return read_current(spark, path)


# ------------------------------------------------------------------ scanner report and enricher

def _written_findings(spark: SparkSession, sf: str, path: str) -> None:
    """The findings as scanner CSV files whose name order is the row order."""
    f = feeds.feed_findings(spark, sf).withColumn("Name", F.concat("Name", F.lit(" row "), F.col("row_id").cast("string")))
    f = f.withColumn("CVE", F.when(F.col("row_id") % 9 == 0, F.lit("N/A")).otherwise(F.col("CVE")))
    renamed = f.repartitionByRange("row_id").sortWithinPartitions("row_id").drop("row_id").withColumnRenamed("Plugin ID", " Plugin ID ")
    renamed.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


@query("scanner_csv_roundtrip")
def scanner_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A9, B15, B17, B18, C5, C6, H14, Q14 end to end: scanner CSV files with
    multi-line cells, NA words and blanks in a header, enriched, merged by
    finding (the last row of a finding stays) and exported; the merged table
    with each finding's number of exported JSON records."""
    base = _scratch(spark, "scanner")
    with shuffles_removed(spark):
        _written_findings(spark, sf, base + "/upload")
    fact = fact_mod.fact_from_feeds(spark, sf)
    layers.process_scanner_csv(spark, base + "/upload", fact, base + "/lake", run_ts=RUN, export_dir=base + "/out", compression="gzip")
    records = spark.read.text(base + "/out/json").select(F.get_json_object("value", "$.HostFindingsID").alias("HostFindingsID"))
    merged = read_current(spark, base + "/lake/gold/vrr_risk_report")
    return merged.join(records.groupBy("HostFindingsID").agg(F.count("*").alias("n_records")), "HostFindingsID", "left").select(
        "HostFindingsID", "vrr_score", F.array_join("vulnerabilities", "|").alias("vulnerabilities"), "VulnerabilityName",
        "ScannerReportedSeverity", "n_records")


@query("enricher_roundtrip")
def enricher_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV with a CVE column, enriched, exported as CSV
    and stored in place of the former contents."""
    base = _scratch(spark, "enricher")
    span = feeds.known_span(spark, sf)
    e = read_driver_table(spark, sf, "events").select("event_id", cve_of(F.col("event_id") % span).alias("CVE ID"))
    e.write.option("header", True).csv(base + "/in")
    layers.enrich_csv(spark, base + "/in", fact_mod.fact_from_feeds(spark, sf), base + "/table", base + "/out", compression="gzip")
    stored = read_current(spark, base + "/table")
    exported = spark.read.option("header", True).csv(base + "/out/csv")
    return stored.join(exported.groupBy("event_id").agg(F.count("*").alias("n_exported")), "event_id").select(
        F.col("event_id").cast("long").alias("event_id"), F.col("CVE ID").alias("cve_id"), "vrr_score", "n_exported")


@query("report_columns")
def report_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched report's columns in order, with how many rows hold a value in each."""
    r = findings.enrich_findings(feeds.feed_findings(spark, sf), fact_mod.fact_from_feeds(spark, sf))
    counts = r.agg(*[F.count(F.col(c)).alias(c) for c in r.columns])
    return counts.select(F.posexplode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in r.columns]))).select(
        F.col("pos").alias("position"), "col.name", F.col("col.n").alias("n_values"))


@query("zero_risk_dropped")
def zero_risk_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """the documented filter on findings without risk, switched on."""
    r = findings.enrich_findings(feeds.feed_findings(spark, sf), fact_mod.fact_from_feeds(spark, sf))
    return findings.drop_zero_risk(r, enabled=True).select("row_id", "vrr_score")


# ------------------------------------------------------------------ pages

@query("exploit_page_metadata")
def exploit_page_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Pages built from part, with attributes in either order, case and
    quoting, entities, nested tags and near misses of class and attribute names."""
    k = F.col("p_partkey")
    t = k.cast("string")
    link = F.concat(F.lit("https://soft.example/get?id="), t, F.lit("&amp;v=1"))
    shot = F.when(k % 3 == 0, F.concat(F.lit("<A HREF='/shots/"), t, F.lit(".png' CLASS='btn screenshot-url'>s</A>"))).when(
        k % 3 == 1, F.concat(F.lit('<a class="no-screenshot-url" href="/x">n</a>'))).otherwise(F.lit(""))
    icon = F.when(k % 4 == 0, F.lit('<i class="mdi mdi-check"></i>')).when(k % 4 == 1, F.lit('<i class="mdi mdi-check-circle"></i>')).when(
        k % 4 == 2, F.lit("<I data-class='fa-check' class=fa-check-square></I>")).otherwise(F.lit("<i class = 'fa\nfa-check' ></i>"))
    app = F.when(k % 5 == 0, F.concat(F.lit('<a target=_blank href="'), link, F.lit('"><b>Vulnerable App</b>:</a>'))).when(
        k % 5 == 1, F.concat(F.lit('<a href="https://www.exploit-db.com/download/1">d</a><a href="'), link, F.lit('&amp;download">d</a>'))).otherwise(
        F.lit('<a href="/plain">p</a>'))
    words = F.concat(F.lit("CVE-2024-"), t, F.lit(", osvdb-"), t, F.lit(" ,Remote, R&amp;D,, "), F.repeat(F.lit("x"), 60))
    meta = F.when(k % 2 == 0, F.concat(F.lit('<META CONTENT="'), words, F.lit('" NAME=Keywords>'))).otherwise(
        F.concat(F.lit("<meta name='description' content='no'><meta name='keywords' content='"), words, F.lit("'/>")))
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))  # keys are narrow, their pages' work is not
    parts = read_driver_table(spark, sf, "part").select("p_partkey").repartition(spread)
    pages = parts.select(k.alias("id"), F.concat(F.lit("<html>"), meta, shot, icon, app, F.lit("</html>")).alias("html"))
    m = page_metadata(pages, url_col=None)
    return m.select("id", "screenshot_url", "verified", "application_url", F.array_join("codes", "|").alias("codes"), F.array_join("tags", "|").alias("tags"))


@query("page_markup")
def page_markup(spark: SparkSession, sf: str) -> DataFrame:
    """All pages, each with what only looks like markup put before it:
    tags in a comment, a script, a style and an attribute's value, a sign that
    ends no tag, a text cut by a comment, references that yield references."""
    k = F.col("page_id")
    t = k.cast("string")
    looks = F.lit('<!-- <a class="screenshot-url" href="/commented"><i class="mdi-check"></i> --><script>var i = "<i class=fa-check></i>";</script>'
                  '<style>a > b { content: "<a href=/download/style>" }</style><img alt="<a class=screenshot-url href=/download/alt>">')
    shot = F.when(k % 2 == 0, F.concat(F.lit('<a title="1 > 0" class="screenshot-url" href="/shots/'), t, F.lit('.png"></a>'))).otherwise(F.lit(""))
    app = F.when(k % 3 == 0, F.concat(F.lit("<a href='/app/"), t, F.lit("?q=&#38;lt;&#x41;'>Vulnerable<!-- </a> --> App</a>"))).when(
        k % 3 == 1, F.concat(F.lit("<a href=/x href=/software/"), t, F.lit(">s</a>"))).otherwise(F.lit(""))
    icon = F.when(k % 5 == 0, F.lit("<i title='</i>' class=fa-check>")).otherwise(F.lit(""))
    page = read_driver_table(spark, sf, "pages").select("page_id", F.concat(looks, shot, app, icon, F.coalesce("html", F.lit(""))).alias("html"))
    m = page_metadata(page.withColumn("n_links", F.size(all_hrefs(F.col("html")))), url_col=None)
    return m.select("page_id", "n_links", "screenshot_url", "verified", "application_url")


# ------------------------------------------------------------------ small row operators

@query("epss_silver")
def epss_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows with missing keys, empty and unreadable
    numbers through bronze and silver; unrounded values of six and more decimals."""
    li = read_driver_table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    raw = li.select(F.when(n != 5, cve_of(F.col("l_partkey"))).alias("cve"),
                    F.when(n == 6, F.lit(" ")).when(n == 7, F.lit("n/a")).otherwise(F.format_string("0.%09d", F.col("l_partkey").cast("long"))).alias("epss"),
                    F.lit("0.5").alias("percentile"), F.date_format("l_shipdate", "yyyy").alias("date"))
    good, bad = bronze_epss(raw)
    silver, rejects = silver_epss(good)
    s = silver.groupBy("date").agg(F.count("*").alias("n_good"), F.sum((F.col("epss") * 1_000_000_000).cast("long")).alias("billionths"))
    b = bad.unionByName(rejects, allowMissingColumns=True).groupBy("date").agg(F.count("*").alias("n_bad"))
    return s.join(b, "date", "full").select("date", "n_good", "billionths", "n_bad")


@query("range_rows")
def range_rows(spark: SparkSession, sf: str) -> DataFrame:
    """a closed range of days, both ends in."""
    o = read_driver_table(spark, sf, "orders")
    day = o.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return inc.range_filter(day, "day", _dt.date(1995, 1, 1), _dt.date(1995, 12, 31)).select("o_orderkey", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("incremental_lookback")
def incremental_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """Rows after the watermark, with a margin of ten days before it."""
    o = read_driver_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    return inc.incremental(o, "ts", _dt.datetime(1996, 6, 1), _dt.timedelta(days=10)).select("o_orderkey")


@query("nvd_slices_backfill")
def nvd_slices_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """A backfill read slice by slice. Slices share their ends, so
    rows on an edge are read twice; the newest delivery of a key stays."""
    o = read_driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    read = inc.read_by_slices(o, "ts")
    from threatspark.operators.dedup import latest_by_key
    newest = latest_by_key(read, ["o_custkey"], ["ts", "o_orderkey", "slice_no"])
    return newest.select("o_custkey", "o_orderkey", "slice_no")


@query("key_except")
def key_except(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of one table that another lacks, as a set."""
    li = read_driver_table(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("k"))
    return quality.key_difference(read_driver_table(spark, sf, "part").select(F.col("p_partkey").alias("k")), li, ["k"])


@query("required_keys")
def required_keys(spark: SparkSession, sf: str) -> DataFrame:
    """rows whose key is missing or empty text go."""
    e = read_driver_table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit("")).when(
        F.col("event_id") % 3 == 1, F.col("event_type")).alias("key"))
    return quality.require_key(e, "key")


@query("risk_membership")
def risk_membership(spark: SparkSession, sf: str) -> DataFrame:
    """membership in a list of words, whatever the case."""
    e = read_driver_table(spark, sf, "events").withColumn("type", F.initcap("event_type"))
    return e.filter(lowercase_in("type", ["VIEW", "click"])).groupBy("type").agg(F.count("*").alias("n"))


@query("sample_ordered")
def sample_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows in an order; the sample is the feature."""
    return quality.sample_rows(read_driver_table(spark, sf, "orders"), 5, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("typed_guards")
def typed_guards(spark: SparkSession, sf: str) -> DataFrame:
    """H5: NVD items whose lists are texts, numbers or missing read as empty lists; the rows stay."""
    k = F.col("p_partkey").cast("string")
    value = F.when(F.col("p_partkey") % 4 == 0, F.lit('"oops"')).when(F.col("p_partkey") % 4 == 1, F.lit("7")).when(
        F.col("p_partkey") % 4 == 2, F.lit("null")).otherwise(F.lit('[{"lang":"en","value":"fine"}]'))
    item = F.concat(F.lit('{"vulnerabilities":[{"cve":{"id":"CVE-'), k, F.lit('","descriptions":'), value, F.lit("}}]}"))
    base = _scratch(spark, "guards")
    read_driver_table(spark, sf, "part").select(item.alias("value")).write.text(base)
    good, _ = silver_nvd(src.bronze_nvd(src.read_nvd_pages(spark, base, lines=True)))
    return good.select("cve_id", F.array_join("descriptions", "|").alias("descriptions"), F.size("references").alias("n_references"))
