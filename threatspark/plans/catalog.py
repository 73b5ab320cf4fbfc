"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator
family of the survey. Outputs are scalar columns (arrays joined with '|',
decimals as double or short text, timestamps as text) so that results can be
compared value by value with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatspark.plans import fact as factmod
from threatspark.plans import feeds
from threatspark.plans.rules import COLLECTIONS, threat_rules

QUERIES: dict = {}


def query(name: str):
    """Register a query. Every query runs with the session clock in UTC (the
    library's convention, Q20), whoever built the session."""
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ------------------------------------------------------------------ fact family

@query("vrr_score_per_cve")
def vrr_score_per_cve(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: J1-J4, N1, G2, C11."""
    return factmod.fact_from_feeds(spark, sf).select("cve_id", "vrr_score")


@query("threat_attributes_per_cve")
def threat_attributes_per_cve(spark: SparkSession, sf: str) -> DataFrame:
    """The threats record, one column per rule."""
    return factmod.flat_threats(factmod.fact_from_feeds(spark, sf))


@query("score_breakdown_by_rule")
def score_breakdown_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    """G3 with dim_vrr."""
    return factmod.score_breakdown(factmod.addends_from_feeds(spark, sf), factmod.dim_vrr(spark))


@query("threat_coverage")
def threat_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """dim_threats (C10) with the number of CVEs holding each attribute."""
    fact = factmod.fact_from_feeds(spark, sf)
    keys = [r.key for r in threat_rules()]
    counts = fact.agg(*[F.count(F.col("threats")[k]).alias(k) for k in keys])
    long = counts.unpivot([], keys, "key", "n_cves")
    dims = factmod.dim_threats(spark).select(
        F.concat_ws("_", "category", "name").alias("key"), "category", "name", "source_collection")
    return dims.join(long, "key", "left")


@query("score_band_counts")
def score_band_counts(spark: SparkSession, sf: str) -> DataFrame:
    """G2 + groupBy: CVEs per 10-point score band."""
    fact = factmod.fact_from_feeds(spark, sf)
    band = (F.floor(F.col("vrr_score") / 10) * 10).cast("long")
    return fact.groupBy(band.alias("band")).agg(F.count("*").alias("n_cves"),
                                                F.max("vrr_score").alias("max_score"))


@query("latest_epss_per_cve")
def latest_epss_per_cve(spark: SparkSession, sf: str) -> DataFrame:
    """N1 on the EPSS feed."""
    e = feeds.feed_epss(spark, sf)
    return e.select("cve", F.col("epss").cast("double").alias("epss"),
                    F.col("percentile").cast("double").alias("percentile"), "date")


@query("exploit_codes_exploded")
def exploit_codes_exploded(spark: SparkSession, sf: str) -> DataFrame:
    """J3 lookup: winning exploit per code."""
    x = factmod.exploit_lookup(feeds.feed_exploit(spark, sf))
    return x.select("code", "id", "type", "platform", "source_url")


@query("module_refs_exploded")
def module_refs_exploded(spark: SparkSession, sf: str) -> DataFrame:
    """J4 lookup: winning module per CVE reference, S5 prefix test."""
    m = factmod.module_lookup(feeds.feed_modules(spark, sf), feeds.feed_module_refs(spark, sf))
    return m.select("ref", "fullname", "name", "platform", "mod_time")


@query("rule_field_presence")
def rule_field_presence(spark: SparkSession, sf: str) -> DataFrame:
    """G10/F11 over the gold-shaped feeds."""
    refs = feeds.feed_module_refs(spark, sf).groupBy("fullname").agg(F.count("ref").alias("references"))
    modules = feeds.feed_modules(spark, sf).join(refs, "fullname", "left")
    tables = {"CISA": feeds.feed_kev(spark, sf), "NVD": feeds.feed_nvd(spark, sf),
              "EPSS": feeds.feed_epss(spark, sf), "ExploitDB": feeds.feed_exploit(spark, sf),
              "Metasploit": modules}
    return factmod.validate_rules(tables).withColumn(
        "collection", F.create_map(*[x for k, v in COLLECTIONS.items() for x in (F.lit(k), F.lit(v))])
        [F.col("source")])


# ------------------------------------------------------------------ findings family

def _findings(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed_findings(spark, sf)


@query("finding_cves_normalized")
def finding_cves_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """S1 normaliser and S3 finding id."""
    from threatspark.functions.strings import finding_id, normalize_cves
    f = _findings(spark, sf)
    cves = normalize_cves(F.col("CVE"))
    return f.select("row_id", finding_id(F.col("Host"), F.col("`Plugin ID`")).alias("HostFindingsID"),
                    F.array_join(cves, "|").alias("cves"), F.size(cves).alias("n_cves"))


@query("enriched_findings")
def enriched_findings(spark: SparkSession, sf: str) -> DataFrame:
    """The report's risk columns."""
    from threatspark.plans.findings import enrich_findings
    r = enrich_findings(_findings(spark, sf), factmod.fact_from_feeds(spark, sf))
    return r.select("row_id", "HostFindingsID", "vrr_score",
                    F.array_join("vulnerabilities", "|").alias("vulnerabilities"),
                    "IPAddress", "ScannerPluginID", "ScannerReportedSeverity", "ScannerName", "Status")


@query("finding_weaknesses")
def finding_weaknesses(spark: SparkSession, sf: str) -> DataFrame:
    """Every threat value holding 'CWE-', distinct and sorted, per finding."""
    from threatspark.plans.findings import enrich_findings
    r = enrich_findings(_findings(spark, sf), factmod.fact_from_feeds(spark, sf))
    return r.select("row_id", F.array_join("weaknesses", "|").alias("weaknesses"),
                    F.size("weaknesses").alias("n_weaknesses"))


@query("finding_threats_long")
def finding_threats_long(spark: SparkSession, sf: str) -> DataFrame:
    """Threats merged by set union per key, one row per finding and
    key. The merge runs once per distinct CVE set; each finding then picks up
    its set's rows by an equi-join on the set key."""
    from threatspark.functions.strings import normalize_cves
    from threatspark.plans.findings import finding_intel
    f = _findings(spark, sf)
    intel = finding_intel(f, factmod.fact_from_feeds(spark, sf))
    per_set = intel.select("_set", F.explode("threats").alias("threat_key", "vals")).select(
        "_set", "threat_key", F.array_join("vals", "|").alias("vals"), F.size("vals").alias("n_vals"))
    keys = f.select("row_id", F.array_join(normalize_cves(F.col("CVE")), ",").alias("_set"))
    return keys.join(per_set, "_set").drop("_set")


@query("enrich_simple")
def enrich_simple_q(spark: SparkSession, sf: str) -> DataFrame:
    """Exact-match enrichment with a 'cve_id' column."""
    from threatspark.functions.strings import cve_of
    from threatspark.plans.findings import enrich_simple
    from threatspark.sources.tables import read_driver_table
    ev = read_driver_table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"), cve_of(F.col("event_id") % feeds.known_span(spark, sf)).alias("cve_id"))
    return enrich_simple(ev, factmod.fact_from_feeds(spark, sf), cve_column="Vulnerability")


@query("intel_coverage")
def intel_coverage_q(spark: SparkSession, sf: str) -> DataFrame:
    """G11, X2, G13."""
    from threatspark.plans.findings import intel_coverage
    return intel_coverage(_findings(spark, sf), factmod.fact_from_feeds(spark, sf))


@query("top_risks")
def top_risks_q(spark: SparkSession, sf: str) -> DataFrame:
    """T4 (T1): the 20 riskiest findings."""
    from threatspark.plans.findings import enrich_findings, top_risks
    r = enrich_findings(_findings(spark, sf), factmod.fact_from_feeds(spark, sf))
    return top_risks(r, 20).select("row_id", "HostFindingsID", "vrr_score",
                                   F.array_join("vulnerabilities", "|").alias("vulnerabilities"))


@query("report_preview")
def report_preview_q(spark: SparkSession, sf: str) -> DataFrame:
    """First ten rows of four columns and the count of the rest."""
    from threatspark.plans.findings import enrich_findings, report_preview
    r = enrich_findings(_findings(spark, sf), factmod.fact_from_feeds(spark, sf))
    p = report_preview(r, 10)
    return p.withColumn("vulnerabilities", F.array_join("vulnerabilities", "|"))


@query("finding_report_text")
def finding_report_text(spark: SparkSession, sf: str) -> DataFrame:
    """Description text, optional columns with defaults."""
    from threatspark.plans.findings import join_text, optional_col
    f = _findings(spark, sf)
    return f.select("row_id",
                    join_text(F.col("Description"), F.col("Synopsis")).alias("Description"),
                    optional_col(f, "Plugin Output").alias("PluginOutput"),
                    optional_col(f, "See Also").alias("PossiblePatches"),
                    optional_col(f, "Solution").alias("PossibleSolutions"))


# ------------------------------------------------------------------ merge family

MERGE_RUN_TS = "2024-06-01 00:00:00"


def _orders_target(spark: SparkSession, sf: str) -> DataFrame:
    from threatspark.sources.tables import read_driver_table
    o = read_driver_table(spark, sf, "orders").filter(F.col("o_orderdate") < "1998-01-01")
    ts = F.col("o_orderdate").cast("timestamp")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                    (F.col("o_totalprice") / 1000).alias("VRRScore"),
                    ts.alias("created_at"), ts.alias("updated_at"))


def _orders_incoming(spark: SparkSession, sf: str) -> DataFrame:
    from threatspark.sources.tables import read_driver_table
    o = read_driver_table(spark, sf, "orders").filter(F.col("o_orderdate") >= "1997-01-01")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 5 == 0, F.lit(None)).when(k % 3 == 0, F.col("o_orderstatus"))
         .otherwise(F.lit("U")).alias("o_orderstatus"),
        (F.col("o_totalprice") + F.when(k % 2 == 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("o_totalprice"),
        "o_orderpriority", F.lit("delta").alias("feed"))


def _run_ts():
    return F.to_timestamp(F.lit(MERGE_RUN_TS))


@query("upsert_result")
def upsert_result(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming columns overwrite (nulls too); absent columns keep old values."""
    from threatspark.operators.merge import upsert
    t = _orders_target(spark, sf).drop("created_at", "updated_at", "VRRScore")
    out = upsert(t, _orders_incoming(spark, sf), "o_orderkey")
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "feed")


@query("upsert_audit")
def upsert_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Created kept (run time for new keys), updated = run time when touched."""
    from threatspark.operators.merge import upsert
    t = _orders_target(spark, sf).drop("VRRScore")
    out = upsert(t, _orders_incoming(spark, sf), "o_orderkey", audit=("created_at", "updated_at"),
                 run_ts=_run_ts())
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select("o_orderkey", F.date_format("created_at", fmt).alias("created_at"),
                      F.date_format("updated_at", fmt).alias("updated_at"))


@query("upsert_keep_nulls")
def upsert_keep_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """C6 + B20: null inputs keep old values; legacy column unset on touched rows."""
    from threatspark.operators.merge import upsert
    t = _orders_target(spark, sf).drop("created_at", "updated_at")
    out = upsert(t, _orders_incoming(spark, sf), "o_orderkey", nulls="keep", drop_columns=["VRRScore"])
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "feed", "VRRScore")


@query("insert_if_absent")
def insert_if_absent_q(spark: SparkSession, sf: str) -> DataFrame:
    """Only new keys are added."""
    from threatspark.operators.merge import insert_if_absent
    t = _orders_target(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return insert_if_absent(t, _orders_incoming(spark, sf).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "feed"), "o_orderkey")


@query("merge_stats")
def merge_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    """Processed / inserted / matched / modified."""
    from threatspark.operators.merge import merge_stats
    return merge_stats(_orders_target(spark, sf), _orders_incoming(spark, sf), "o_orderkey")


# ------------------------------------------------------------------ incremental family

@query("kev_since")
def kev_since(spark: SparkSession, sf: str) -> DataFrame:
    """strict '>' on dateAdded, rows without a date dropped."""
    from threatspark.operators.incremental import since_filter
    k = feeds.feed_kev(spark, sf)
    return since_filter(k, "date_added", "2022-06-01", keep_null=False).select("cve_id", "date_added")


@query("exploit_since")
def exploit_since(spark: SparkSession, sf: str) -> DataFrame:
    """updated-else-published date, strict '>', rows without a date kept."""
    from threatspark.operators.incremental import exploit_change_date, since_filter
    x = feeds.feed_exploit(spark, sf).withColumn("change_date", exploit_change_date())
    return since_filter(x, "change_date", "1998-06-01", keep_null=True).select("id", "change_date")


@query("module_since")
def module_since(spark: SparkSession, sf: str) -> DataFrame:
    """text compare on mod_time, strict '>', rows without a time kept."""
    from threatspark.operators.incremental import since_filter
    m = feeds.feed_modules(spark, sf)
    return since_filter(m, "mod_time", "2000-06-01 00:00:00 +0000", keep_null=True) \
        .select("fullname", "mod_time")


@query("watermark_per_source")
def watermark_per_source(spark: SparkSession, sf: str) -> DataFrame:
    """G1 + F7 + F8: the resume point of every source."""
    from threatspark.operators.incremental import (NVD_DEFAULT_START, OTHER_DEFAULT_START,
                                                   sane_watermark)
    from threatspark.sources.tables import read_driver_table
    parts = [
        ("nvd", feeds.feed_nvd(spark, sf).agg(F.max(F.date_format(
            "last_modified", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("w")), NVD_DEFAULT_START),
        ("cisa", feeds.feed_kev(spark, sf).agg(F.max("date_added").alias("w")), OTHER_DEFAULT_START),
        ("epss", feeds.feed_epss(spark, sf).agg(F.max("date").alias("w")), OTHER_DEFAULT_START),
        ("exploit", feeds.feed_exploit(spark, sf).agg(F.max("date_published").alias("w")),
         OTHER_DEFAULT_START),
        ("metasploit", feeds.feed_modules(spark, sf).agg(F.max("mod_time").alias("w")),
         OTHER_DEFAULT_START),
        # a snapshot-metadata text stored as a watermark: corrupt -> full refresh
        ("epss_meta", read_driver_table(spark, sf, "events").agg(F.max(F.concat(
            F.lit("model_version:v2023.03.01,score_date:"), F.date_format("ts", "yyyy-MM-dd"))).alias("w")),
         OTHER_DEFAULT_START),
    ]
    out = None
    for name, df, default in parts:
        row = df.select(F.lit(name).alias("source"), F.col("w").alias("raw_max"),
                        sane_watermark(F.col("w"), default).alias("watermark"))
        out = row if out is None else out.unionByName(row)
    return out


@query("snapshot_gate_newest")
def snapshot_gate_newest(spark: SparkSession, sf: str) -> DataFrame:
    """Each day of events is a snapshot whose '#' metadata line
    carries score_date; snapshots dated on or before 'since' are skipped,
    admitted rows are stamped with their snapshot's date."""
    from threatspark.operators.incremental import snapshot_gate
    from threatspark.sources.epss import score_date_of
    from threatspark.sources.tables import read_driver_table
    ev = read_driver_table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("snapshot"), "event_id")
    meta = ev.select("snapshot").distinct().select(
        "snapshot", F.concat(F.lit("#model_version:v2023.03.01,score_date:"),
                             F.substring("snapshot", 1, 4), F.lit("-"), F.substring("snapshot", 5, 2),
                             F.lit("-"), F.substring("snapshot", 7, 2), F.lit("T00:00:00+0000"))
        .alias("line"))
    meta = snapshot_gate(meta.select("snapshot", score_date_of(F.col("line")).alias("score_date")),
                         "2024-01-20")
    rows = ev.join(meta, "snapshot")
    return rows.groupBy("score_date").agg(F.count("*").alias("n_rows"))


@query("rows_per_time_slice")
def rows_per_time_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per 119-day closed slice of the order-date range."""
    from threatspark.operators.incremental import rows_per_slice
    from threatspark.sources.tables import read_driver_table
    o = read_driver_table(spark, sf, "orders").select("o_orderdate")
    r = rows_per_slice(o, "o_orderdate")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return r.select("slice_no", F.date_format("lo", fmt).alias("lo"), F.date_format("hi", fmt).alias("hi"),
                    F.col("n_rows").cast("long").alias("n_rows"))


# ------------------------------------------------------------------ quality family

@query("missing_in_target")
def missing_in_target(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys present in lineitem (bronze) but not in the
    non-pending orders (silver)."""
    from threatspark.operators.incremental import repair
    from threatspark.sources.tables import read_driver_table
    bronze = read_driver_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    silver = read_driver_table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return repair(bronze, silver, "o_orderkey")


@query("late_rows_repaired")
def late_rows_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders load first; the strict '>' watermark run then
    misses back-dated open/pending orders, which the key-difference repair
    finds."""
    from threatspark.operators.incremental import repair
    from threatspark.sources.tables import read_driver_table
    o = read_driver_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    first = o.filter(F.col("o_orderstatus") == "F")
    wm = first.agg(F.max("o_orderdate")).scalar()  # scalar subquery: evaluated once, no join
    second = o.filter(F.col("o_orderdate") > wm)
    silver = first.unionByName(second)
    fixed = repair(o, silver, "o_orderkey")
    return (first.withColumn("found_by", F.lit("initial"))
            .unionByName(second.withColumn("found_by", F.lit("incremental")))
            .unionByName(fixed.withColumn("found_by", F.lit("repair")))
            .select("o_orderkey", "o_orderstatus", "found_by"))


@query("cutoff_counts")
def cutoff_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before / from a cutoff date, bronze vs silver."""
    from threatspark.operators.quality import cutoff_counts as counts
    from threatspark.sources.tables import read_driver_table
    o = read_driver_table(spark, sf, "orders")
    return counts({"bronze": o, "silver": o.filter(F.col("o_orderstatus") == "F")},
                  "o_orderdate", "1998-01-01")


@query("duplicate_keys")
def duplicate_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    """Finding ids held by more than one row (Q11)."""
    from threatspark.functions.strings import finding_id
    from threatspark.operators.merge import duplicate_keys
    f = _findings(spark, sf).select(finding_id(F.col("Host"), F.col("`Plugin ID`")).alias("HostFindingsID"))
    return duplicate_keys(f, "HostFindingsID")


@query("table_counts")
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per driver table."""
    from threatspark.operators.quality import table_counts as counts
    from threatspark.sources.tables import read_driver_table
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    return counts({n: read_driver_table(spark, sf, n) for n in names})


# ------------------------------------------------------------------ gold family

@query("mirror_include")
def mirror_include(spark: SparkSession, sf: str) -> DataFrame:
    """Include list (missing names ignored) plus the key."""
    from threatspark.plans.gold import mirror
    from threatspark.sources.tables import read_driver_table
    c = read_driver_table(spark, sf, "customer").withColumnRenamed("c_custkey", "id")
    return mirror(c, include=["c_name", "c_acctbal", "c_phone"])


@query("mirror_exclude_manual")
def mirror_exclude_manual(spark: SparkSession, sf: str) -> DataFrame:
    """B12 + B13: exclude list, constant columns override same-named ones."""
    from threatspark.plans.gold import mirror
    from threatspark.sources.tables import read_driver_table
    c = read_driver_table(spark, sf, "customer").withColumnRenamed("c_custkey", "id")
    return mirror(c, exclude=["c_mktsegment"], manual={"tier": "gold", "c_nationkey": 0})


@query("factor_table_long")
def factor_table_long(spark: SparkSession, sf: str) -> DataFrame:
    """Configured paths unpivoted to long rows, nulls skipped."""
    from threatspark.plans.gold import Factor, factor_table
    kev = feeds.feed_kev(spark, sf)
    nvd = feeds.feed_nvd(spark, sf)
    sources = {
        "cisa": (kev, [Factor("vendor", "vendor_project", "CISA", "Static"),
                       Factor("ransomware", "known_ransomware_campaign_use", "CISA"),
                       Factor("first_cwe", "cwes.0", "CISA")]),
        "nvd": (nvd, [Factor("cvss", "metrics_cvssMetricV31.0.cvssData.baseScore", "NVD", "Static"),
                      Factor("in_nvd", "TRUE"),
                      Factor("first_weakness", "weaknesses.0", "NVD"),
                      Factor("missing", "no.such.path")]),
    }
    return factor_table(sources, "dim_factors")


# ------------------------------------------------------------------ readers / silver family

@query("page_metadata")
def page_metadata_q(spark: SparkSession, sf: str) -> DataFrame:
    """Page HTML -> metadata columns, as native regex columns."""
    from threatspark.sources.pages import all_hrefs, page_metadata
    from threatspark.sources.tables import read_driver_table
    p = read_driver_table(spark, sf, "pages")
    meta = page_metadata(p.select("page_id", "url", "html",
                                  F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
                                  F.regexp_extract("html", r"<html[^>]*lang=\"([^\"]*)\"", 1).alias("lang"),
                                  F.size(all_hrefs(F.col("html"))).alias("n_links"),
                                  F.get(all_hrefs(F.col("html")), 0).alias("first_href")))
    return meta.select("page_id", "title", "lang", "n_links", "first_href", "screenshot_url", "verified",
                       "application_url", F.size("codes").alias("n_codes"), F.size("tags").alias("n_tags"))


@query("tolerant_casts")
def tolerant_casts(spark: SparkSession, sf: str) -> DataFrame:
    """S7, S8, S11, S12, F12 on text built from events."""
    from threatspark.functions.casts import (EPSS_DECIMAL, decimal_or_zero, parse_day, parse_iso,
                                             tolerant_int)
    from threatspark.sources.tables import read_driver_table
    e = read_driver_table(spark, sf, "events")
    eid = F.col("event_id")
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    iso = (F.when(eid % 4 == 0, base).when(eid % 4 == 1, F.concat(base, F.lit("Z")))
           .when(eid % 4 == 2, F.concat(base, F.lit("+02:00")))
           .otherwise(F.concat(F.lit("junk-"), eid.cast("string"))))
    day = (F.when(eid % 3 == 0, F.date_format("ts", "yyyy-MM-dd"))
           .when(eid % 3 == 1, F.concat_ws("-", F.year("ts").cast("string"), F.month("ts").cast("string"),
                                            F.dayofmonth("ts").cast("string")))
           .otherwise(F.lit("not-a-date")))
    port = (F.when(eid % 5 == 0, F.col("user_id").cast("string"))
            .when(eid % 5 == 1, F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
            .when(eid % 5 == 2, F.col("value").cast("string")).when(eid % 5 == 3, F.lit("")))
    epss = (F.when(eid % 4 == 0, (F.col("value") / 100).cast(feeds.FEED_DECIMAL).cast("string"))
            .when(eid % 4 == 1, F.lit("")).when(eid % 4 == 3, F.lit("n/a")))
    t = e.select("event_id", iso.alias("iso_text"), day.alias("day_text"), port.alias("port_text"),
                 epss.alias("epss_text"))
    parsed_e = decimal_or_zero(F.col("epss_text"), EPSS_DECIMAL)
    return t.select(
        "event_id", "iso_text", F.date_format(parse_iso(F.col("iso_text")), "yyyy-MM-dd HH:mm:ss").alias("parsed_ts"),
        "day_text", F.date_format(parse_day(F.col("day_text")), "yyyy-MM-dd").alias("parsed_day"),
        "port_text", tolerant_int(F.col("port_text")).alias("port"),
        "epss_text", parsed_e.cast("double").alias("epss"), parsed_e.isNull().alias("quarantined"))


def _metrics_json(score) -> F.Column:
    s = F.concat(F.lit('{"cvssData":{"baseScore":'), score, F.lit("}}"))
    k = F.col("p_partkey") % 4
    return (F.when(k == 0, F.concat(F.lit('{"cvssMetricV31":['), s, F.lit("]}")))
            .when(k == 1, F.concat(F.lit('{"cvssMetricV31":[],"cvssMetricV2":['), s, F.lit("]}")))
            .when(k == 2, F.concat(F.lit('{"cvssMetricV2":['), s, F.lit('],"cvssMetricV30":['), s, F.lit("]}")))
            .otherwise(F.lit("{}")))


@query("cvss_from_nested")
def cvss_from_nested(spark: SparkSession, sf: str) -> DataFrame:
    """H4 (flatten non-empty metric lists), H7 (v3.1 score with nested
    fallback), H6 (dotted path) over metric JSON text built from part."""
    from threatspark.functions.casts import CVSS_DECIMAL
    from threatspark.functions.nested import cvss_base, metric_columns, non_empty_metrics, path_col
    from threatspark.functions.strings import cve_of
    from threatspark.sources.feeds import METRIC
    from threatspark.sources.tables import read_driver_table
    p = read_driver_table(spark, sf, "part")
    score = ((F.col("p_retailprice") - 900) / 10).cast(CVSS_DECIMAL).cast("string")
    raw = p.select(cve_of(F.col("p_partkey")).alias("cve_id"), "p_partkey",
                   F.from_json(_metrics_json(score), f"map<string,{METRIC}>").alias("metrics"))
    flat = raw.select("cve_id", "p_partkey", "metrics", *metric_columns(F.col("metrics")))
    # documents whose flat v3.1 column was never written use the nested fallback
    flat = flat.withColumn("metrics_cvssMetricV31", F.when(F.col("p_partkey") % 8 != 4,
                                                           F.col("metrics_cvssMetricV31")))
    return flat.select(
        "cve_id",
        F.array_join(F.array_sort(F.map_keys(non_empty_metrics(F.col("metrics")))), "|").alias("metric_types"),
        cvss_base(flat.schema).cast("double").alias("cvss_base"),
        path_col(flat, "metrics_cvssMetricV2.0.cvssData.baseScore").alias("v2_score"))


@query("english_descriptions")
def english_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """H1 (English values of a description list) over whole document texts."""
    from threatspark.functions.nested import english_values
    from threatspark.functions.strings import cve_of
    from threatspark.sources.tables import read_driver_table
    d = read_driver_table(spark, sf, "documents")
    descs = F.array(F.struct(F.col("lang").alias("lang"), F.col("text").alias("value")),
                    F.struct(F.concat(F.col("lang"), F.lit("-x")).alias("lang"), F.col("source").alias("value")))
    en = english_values(descs)
    return d.select(cve_of(F.col("doc_id")).alias("cve_id"), F.size(en).alias("n_en"),
                    F.md5(F.array_join(en, "\n")).alias("en_md5"))


@query("first_weakness")
def first_weakness(spark: SparkSession, sf: str) -> DataFrame:
    """H3 (first description per weakness, any language), H9 (English CWE
    values), H2 (pluck) over conversation turns shaped as weakness lists."""
    from threatspark.functions.nested import cwe_list, first_descriptions, pluck
    from threatspark.sources.tables import read_driver_table
    c = read_driver_table(spark, sf, "conversations")
    lang = F.when(F.col("role") == "user", F.lit("en")).otherwise(F.lit("es"))
    w = F.array(
        F.struct(F.col("role").alias("source"),
                 F.array(F.struct(lang.alias("lang"), F.col("text").alias("value")),
                         F.struct(F.lit("en").alias("lang"), F.col("role").alias("value"))).alias("description")),
        F.struct(F.lit("none").alias("source"),
                 F.array().cast("array<struct<lang:string,value:string>>").alias("description")))
    rec = c.select("conv_id", "turn", w.alias("weaknesses"))
    first = first_descriptions(F.col("weaknesses"))
    cwe = cwe_list(rec.schema, "weaknesses")
    return rec.select("conv_id", "turn", F.md5(F.array_join(first, "|")).alias("first_md5"),
                      F.size(cwe).alias("n_en"), F.array_join(pluck(F.col("weaknesses"), "source"), "|")
                      .alias("sources"))


# ------------------------------------------------------------------ file round trips / streaming

def _scratch(spark: SparkSession, name: str) -> str:
    import uuid
    from threatspark.session import work_dir
    return work_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("stream_upsert_equals_batch")
def stream_upsert_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed as one folder per day, drained by Structured
    Streaming (availableNow, several micro-batches) into a hash-bucketed keyed
    table; each micro-batch rewrites only the buckets it touches with a
    last-record-wins upsert. Equals the batch answer."""
    from threatspark.sources.tables import read_driver_table
    from threatspark.streaming.stream import stream_layer
    base = _scratch(spark, "stream")
    e = read_driver_table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", "yyyyMMdd").alias("day"))
    e.repartition("day").write.mode("overwrite").partitionBy("day").parquet(base + "/landing")
    out = stream_layer(spark, base + "/landing", EVENT_SCHEMA, base + "/table", "user_id", base + "/checkpoint",
                       order=["ts", "event_id"], max_files_per_trigger=FILES_PER_TRIGGER, buckets=_user_buckets(e))
    return _latest_events(out)


EVENT_SCHEMA = "user_id long, event_id long, event_type string, ts timestamp"
FILES_PER_TRIGGER = 16  # landed files that one micro-batch of these queries takes


def _user_buckets(events: DataFrame) -> int:
    from threatspark.operators.merge import buckets_for
    return buckets_for(events.agg(F.count("*")).first()[0])  # no more users than events


def _latest_events(out: DataFrame) -> DataFrame:
    return out.select("user_id", "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("stream_redelivery")
def stream_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """N1, R1, R2 over several deliveries: two thirds of the events arrive
    first; a second delivery into the same landing folder, drained by a resumed
    stream, repeats half of all events and brings the rest, so most of its rows
    are older than what is stored. The newest event of each user stays."""
    from threatspark.sources.tables import read_driver_table
    from threatspark.streaming.stream import stream_layer
    base = _scratch(spark, "redelivery")
    e = read_driver_table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    buckets = _user_buckets(e)
    for n, wave in enumerate((e.filter("event_id % 3 <> 0"), e.filter("event_id % 3 = 0 OR event_id % 2 = 0"))):
        wave.write.parquet(f"{base}/landing/delivery={n}")
        out = stream_layer(spark, base + "/landing", EVENT_SCHEMA, base + "/table", "user_id", base + "/checkpoint",
                           order=["ts", "event_id"], max_files_per_trigger=FILES_PER_TRIGGER, buckets=buckets)
    return _latest_events(out)


@query("nvd_pages_roundtrip")
def nvd_pages_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A3, B1, B10, H1-H4, S7 end to end: NVD-format response pages of 2,000
    items are written from part, read back with the page reader and run
    through the bronze and silver transforms."""
    from threatspark.plans.silver import silver_nvd
    from threatspark.functions.casts import CVSS_DECIMAL
    from threatspark.functions.nested import cvss_base
    from threatspark.functions.strings import cve_of
    from threatspark.sources.feeds import bronze_nvd, read_nvd_pages
    from threatspark.sources.tables import read_driver_table
    base = _scratch(spark, "nvd")
    p = read_driver_table(spark, sf, "part")
    k = F.col("p_partkey")
    score = ((F.col("p_retailprice") - 900) / 10).cast(CVSS_DECIMAL).cast("double")
    cve = F.struct(
        cve_of(k).alias("id"), F.lit("nvd@nist.gov").alias("sourceIdentifier"),
        F.when(k % 6 == 0, F.lit("junk")).when(k % 6 == 1, F.concat(F.date_format(
            F.date_add(F.to_date(F.lit("2024-01-01")), (k % 300).cast("int")), "yyyy-MM-dd"),
            F.lit("T10:00:00.000Z"))).otherwise(F.concat(F.date_format(
                F.date_add(F.to_date(F.lit("2024-01-01")), (k % 300).cast("int")), "yyyy-MM-dd"),
                F.lit("T10:00:00.000"))).alias("lastModified"),
        F.array(F.struct(F.lit("es").alias("lang"), F.col("p_type").alias("value")),
                F.struct(F.lit("en").alias("lang"), F.col("p_name").alias("value"))).alias("descriptions"),
        F.create_map(F.lit("cvssMetricV31"),
                     F.when(k % 5 == 0, F.array().cast("array<struct<cvssData:struct<baseScore:double>>>"))
                     .otherwise(F.array(F.struct(F.struct(score.alias("baseScore")).alias("cvssData"))))
                     ).alias("metrics"),
        F.array(F.struct(F.array(F.struct(F.lit("en").alias("lang"),
                                          F.concat(F.lit("CWE-"), F.col("p_size").cast("string")).alias("value")))
                         .alias("description"))).alias("weaknesses"),
        F.array(F.struct(F.concat(F.lit("https://nvd.example/"), k.cast("string")).alias("url"))).alias("references"))
    pages = p.select((k / 2000).cast("long").alias("page"), F.struct(cve.alias("cve")).alias("item")) \
        .groupBy("page").agg(F.count("*").alias("n"), F.collect_list("item").alias("items"))  # <= 2000 per page
    pages.select("page", F.to_json(F.struct(F.col("n").alias("totalResults"),
                                            F.col("items").alias("vulnerabilities"))).alias("value")) \
        .select("value").write.text(base + "/pages")
    good, _ = silver_nvd(bronze_nvd(read_nvd_pages(spark, base + "/pages", lines=True)))
    return good.select(
        "cve_id", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
        F.array_join("descriptions", "|").alias("descriptions"),
        F.array_join("weaknesses", "|").alias("weaknesses"),
        F.array_join("references", "|").alias("refs"),
        cvss_base(good.schema).cast("double").alias("cvss_v31"))


@query("upsert_bucketed_result")
def upsert_bucketed_result(spark: SparkSession, sf: str) -> DataFrame:
    """C1 on a hash-bucketed table: the target is written in key buckets,
    the incoming batch rewrites only the buckets it touches; same answer as
    the in-memory upsert."""
    from threatspark.operators.merge import buckets_for, read_bucketed, upsert_bucketed
    path = _scratch(spark, "bucketed") + "/orders"
    t = _orders_target(spark, sf).drop("created_at", "updated_at", "VRRScore")
    upsert_bucketed(spark, path, t, "o_orderkey", buckets=buckets_for(t.count()))
    upsert_bucketed(spark, path, _orders_incoming(spark, sf), "o_orderkey")
    out = read_bucketed(spark, path)
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "feed")


@query("epss_snapshots_roundtrip")
def epss_snapshots_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A2, F4, B3, F12 end to end: one gzip CSV snapshot per ship year is
    written from lineitem ('#' metadata line with score_date, header, rows;
    line 6 has an empty epss, line 7 a word). The reader gates snapshots dated
    on or before 1997-06-01, stamps rows with their file's date, and the
    bronze step turns '' into 0 and quarantines the words."""
    from threatspark.functions.strings import cve_of
    from threatspark.sources.epss import bronze_epss, read_epss
    from threatspark.sources.tables import read_driver_table
    base = _scratch(spark, "epss")
    li = read_driver_table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), "l_partkey", "l_discount", "l_tax", "l_linenumber")
    epss = (F.when(F.col("l_linenumber") == 6, F.lit(""))
            .when(F.col("l_linenumber") == 7, F.lit("n/a"))
            .otherwise((F.col("l_discount") * 9.87).cast(feeds.FEED_DECIMAL).cast("string")))
    rows = li.select("year", F.lit(2).alias("o"), F.concat_ws(",", cve_of(F.col("l_partkey")), epss,
                                                            (F.col("l_tax") * 12.3).cast(feeds.FEED_DECIMAL)
                                                            .cast("string")).alias("value"))
    heads = li.select("year").distinct()
    meta = heads.select("year", F.lit(0).alias("o"), F.concat(
        F.lit("#model_version:v2023.03.01,score_date:"), F.col("year").cast("string"),
        F.lit("-12-31T00:00:00+0000")).alias("value"))
    header = heads.select("year", F.lit(1).alias("o"), F.lit("cve,epss,percentile").alias("value"))
    # one gzip file per snapshot: a snapshot file is the unit of the format
    (meta.unionByName(header).unionByName(rows).repartition("year").sortWithinPartitions("year", "o")
     .drop("o").write.mode("overwrite").partitionBy("year").option("compression", "gzip").text(base))
    raw = read_epss(spark, base, since="1997-06-01")
    good, bad = bronze_epss(raw)
    g = good.groupBy("date").agg(F.count(F.lit(1)).alias("n_good"),
                                 F.sum("epss").cast("double").alias("epss_sum"))
    b = bad.groupBy("date").agg(F.count(F.lit(1)).alias("n_quarantined"))
    return g.join(b, "date", "full").select(
        "date", F.coalesce("n_good", F.lit(0)).alias("n_good"),
        F.coalesce("n_quarantined", F.lit(0)).alias("n_quarantined"), "epss_sum")


@query("kev_catalog_roundtrip")
def kev_catalog_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A1, F1, B6 end to end: catalogue JSON documents (1,000 entries each,
    catalogue fields on top) written from part, read back with the KEV
    reader, filtered since 2022-06-01 (strict, null dates dropped) and
    transformed to silver."""
    return _kev_roundtrip(spark, sf, lines=True)


@query("kev_catalog_in_ranges")
def kev_catalog_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A1 in byte ranges: as kev_catalog_roundtrip with a file per document, a
    row per entry from the start, wherever ranges begin."""
    return _kev_roundtrip(spark, sf, ranges=True)


def _kev_roundtrip(spark: SparkSession, sf: str, **how) -> DataFrame:
    from threatspark.functions.strings import cve_of
    from threatspark.plans.silver import silver_kev
    from threatspark.sources.feeds import bronze_kev, read_kev
    from threatspark.sources.tables import read_driver_table
    base = _scratch(spark, "kev")
    p = read_driver_table(spark, sf, "part").filter(F.col("p_size") % 7 != 0)
    k = F.col("p_partkey")
    added = F.when(k % 17 == 0, F.lit(None)).otherwise(F.concat_ws(
        "-", F.lit("2021"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lpad((k % 28 + 1).cast("string"), 2, "0")))
    entry = F.struct(cve_of(k).alias("cveID"), F.col("p_brand").alias("vendorProject"),
                     F.col("p_name").alias("product"), added.alias("dateAdded"),
                     F.when(k % 4 == 0, F.lit(None)).otherwise(
                         F.array(F.concat(F.lit("CWE-"), F.col("p_size").cast("string")))).alias("cwes"))
    docs = p.select((k / 1000).cast("long").alias("doc"), entry.alias("e")).groupBy("doc").agg(
        F.collect_list("e").alias("vulnerabilities"), F.count(F.lit(1)).alias("count"))  # <= 1000 per doc
    docs.select("doc", F.to_json(F.struct(F.lit("2024.12.01").alias("catalogVersion"),
                                          F.lit("2024-12-01T10:00:00.000Z").alias("dateReleased"),
                                          "count", "vulnerabilities")).alias("value")) \
        .write.partitionBy("doc").text(base)
    good, _ = silver_kev(bronze_kev(read_kev(spark, base, since="2021-06-15", **how)))
    return good.select("cve_id", F.date_format("date_added", "yyyy-MM-dd").alias("date_added"),
                       "vendor_project", F.array_join("cwes", "|").alias("cwes"), "title",
                       F.date_format("date_released", "yyyy-MM-dd HH:mm:ss").alias("date_released"))


@query("modules_map_roundtrip")
def modules_map_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A8, F3, B5, B9 end to end: module-map JSON documents (fullname ->
    record, 50 suppliers per file) written from supplier and lineitem, read
    with the map reader, filtered on mod_time (text, strict, null kept) and
    transformed to silver (aliases dropped, list defaults)."""
    return _modules_roundtrip(spark, sf, lines=True)


@query("modules_map_in_ranges")
def modules_map_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A8 in byte ranges: as modules_map_roundtrip, a row per module from the
    start, however the documents lie in files and ranges."""
    return _modules_roundtrip(spark, sf, ranges=True)


def _modules_roundtrip(spark: SparkSession, sf: str, **how) -> DataFrame:
    from threatspark.functions.strings import cve_of
    from threatspark.plans.silver import silver_modules
    from threatspark.sources.feeds import bronze_modules, read_modules
    from threatspark.sources.tables import read_driver_table
    base = _scratch(spark, "modules")
    li = read_driver_table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.max("l_shipdate").alias("mt"))
    s = read_driver_table(spark, sf, "supplier").join(li, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    k = F.col("s_suppkey")
    rec = F.struct(
        F.col("s_name").alias("name"), F.lit("exploit").alias("type"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(
            F.concat(F.date_format("mt", "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000"))).alias("mod_time"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(
            F.array(cve_of(k), F.concat(F.lit("URL-https://ref.example/"), k.cast("string")))).alias("references"),
        F.array(F.lit("alias")).alias("aliases"), (k % 7).cast("int").alias("rank"))
    docs = s.select((k / 50).cast("long").alias("doc"),
                    F.concat(F.lit("exploit/s"), k.cast("string")).alias("fullname"), rec.alias("r")) \
        .groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("fullname", "r"))).alias("m"))  # <= 50
    docs.select(F.to_json("m").alias("value")).write.text(base)
    good, _ = silver_modules(bronze_modules(read_modules(spark, base, since="1998-01-01 00:00:00 +0000", **how)))
    return good.select("fullname", "name", "mod_time", "rank", F.array_join("references", "|").alias("refs"),
                       F.size("author").alias("n_authors"))


@query("exploit_index_roundtrip")
def exploit_index_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A5, A6, A7, F2, B4, B8 end to end: the exploit index CSV (quoted
    multi-line descriptions, codes as 'CVE-..;OSVDB-..' text) and a page per
    even-numbered exploit (keywords meta tag, verified icon) are written from
    orders and lineitem; the index is read with the F2 incremental filter,
    joined to the page metadata (rows without a page keep their own text
    fields, Q25) and run through the bronze and silver projections."""
    from threatspark.functions.strings import cve_of
    from threatspark.plans.silver import silver_exploit
    from threatspark.sources.feeds import EXPLOIT_INDEX_COLUMNS, bronze_exploit, read_exploit_index
    from threatspark.session import materialised
    from threatspark.sources.pages import enrich_exploits, page_metadata
    from threatspark.sources.tables import read_driver_table
    base = _scratch(spark, "exploitdb")
    o = read_driver_table(spark, sf, "orders").filter(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", "o_orderdate")
    li = read_driver_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    # one index row per order (codes bounded by the order's lines); either side
    # is one row per order before the join, so that repeated keys don't multiply.
    # Stored, as both the index and the pages are written from it.
    n = feeds.line_tasks(spark, sf)
    codes = li.repartition(n, "o_orderkey").groupBy("o_orderkey").agg(
        F.array_sort(F.transform(F.collect_set("l_partkey"), cve_of)).alias("cves"))
    j = materialised(o.repartition(n, "o_orderkey").distinct().join(codes, "o_orderkey"), "exploit-orders")
    k = F.col("o_orderkey")
    pub = F.date_format("o_orderdate", "yyyy-MM-dd")
    idx = j.select(
        k.cast("string").alias("id"), F.concat(F.lit("exploits/"), k.cast("string")).alias("file"),
        F.concat(F.lit("line one\nline two of "), k.cast("string")).alias("description"),
        pub.alias("date_published"), F.lit("author").alias("author"), F.lit("remote").alias("type"),
        F.lit("linux").alias("platform"),
        F.when(k % 3 == 0, F.lit("80")).when(k % 3 == 1, F.lit("")).otherwise(F.lit("80.5")).alias("port"),
        pub.alias("date_added"),
        F.when(k % 5 == 0, F.date_format(F.date_add(F.to_date("o_orderdate"), 400), "yyyy-MM-dd")).alias("date_updated"),
        F.lit("0").alias("verified"),
        F.concat(F.array_join(F.transform("cves", lambda c: F.lower(c)), ";"), F.lit(";OSVDB-"),
                 k.cast("string")).alias("codes"),
        F.lit(None).cast("string").alias("tags"), F.lit(None).cast("string").alias("aliases"),
        F.lit(None).cast("string").alias("screenshot_url"), F.lit(None).cast("string").alias("application_url"),
        F.concat(F.lit("https://www.exploit-db.com/exploits/"), k.cast("string")).alias("source_url"))
    idx.select(*EXPLOIT_INDEX_COLUMNS).write.mode("overwrite").option("header", True) \
        .option("escape", '"').csv(base + "/index")
    html = F.concat(F.lit('<html><head><meta name="keywords" content="Linux, remote ,'),
                    F.array_join("cves", ","), F.lit('"></head><body><i class="mdi mdi-check"></i></body></html>'))
    pages = j.filter(k % 2 == 0).select(k.cast("string").alias("id"),
                                        F.concat(F.lit("https://www.exploit-db.com/exploits/"), k.cast("string"))
                                        .alias("url"), html.alias("html"))
    index = read_exploit_index(spark, base + "/index", since="1996-01-01")
    good, _ = silver_exploit(bronze_exploit(enrich_exploits(index, page_metadata(pages))))
    return good.select("id", "date_published", "port", "verified", F.array_join("codes", "|").alias("codes"),
                       F.array_join("tags", "|").alias("tags"))
