"""Gold-shaped feeds derived from the driver's tables by fixed expressions.

The driver tables hold no CVEs, so each vulnerability feed is a fixed rule
over them (documented in FIXTURES.md section 3). Every feed reads whole
tables; its size grows with them. Each feed has one membership rule that
leaves most of its rows in (some CVEs must miss a source, to exercise the left
joins); it is part of the fixture definition, not sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatspark.functions.casts import CVSS_DECIMAL
from threatspark.functions.strings import cve_of
from threatspark.operators.dedup import latest_by_key
from threatspark.sources.tables import read_driver_table

BASE_TS = "2024-01-01 00:00:00"
FEED_DECIMAL = "decimal(7,5)"  # the synthetic probabilities have five decimals by definition

_PLANS: dict[tuple, tuple[SparkSession, DataFrame]] = {}  # the session too, so that its id is no other one's


def memo_plan(fn):
    """Feeds are pure functions of the read-only driver tables, so the built
    DataFrame (a plan, not data) is reused per session and scale: building a
    plan costs thousands of driver-JVM round trips, running it none more."""
    def wrapper(spark: SparkSession, sf_dir: str, *args) -> DataFrame:
        from threatspark.plans.rules import score_rules, threat_rules
        rules = tuple(map(repr, (*threat_rules(), *score_rules())))  # a new rule means a new plan
        key = (id(spark), fn.__name__, sf_dir, args, rules)
        if key not in _PLANS:
            _PLANS[key] = spark, fn(spark, sf_dir, *args)
        return _PLANS[key][1]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def _cwe(n) -> F.Column:
    return F.concat(F.lit("CWE-"), (F.lit(100) + n).cast("string"))


@memo_plan
def feed_nvd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped NVD rows, one per part."""
    p = read_driver_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    score = F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(
        ((F.col("p_retailprice") - 900) / 10).cast(CVSS_DECIMAL))
    url1 = F.concat(F.lit("https://vendor.example/"),
                    F.lower(F.regexp_replace("p_brand", "#", "")), F.lit("/"),
                    F.col("p_partkey").cast("string"))
    url2 = F.concat(F.lit("https://advisory.example/"), F.lower("p_type"))
    weak = (F.when(F.col("p_size") % 5 == 0, F.array().cast("array<string>"))
            .when(F.col("p_size") % 3 == 0, F.array(_cwe(F.col("p_size")), F.lit("NVD-CWE-Other")))
            .otherwise(F.array(_cwe(F.col("p_size")))))
    metric = F.struct(
        F.lit("nvd@nist.gov").alias("source"), F.lit("Primary").alias("type"),
        F.struct(F.lit("3.1").alias("version"),
                 F.col("_score").cast("double").alias("baseScore")).alias("cvssData"))
    modified = F.to_timestamp(F.lit(BASE_TS)) + F.make_dt_interval(
        days=(F.col("p_partkey") % 365).cast("int"), hours=(F.col("p_partkey") % 24).cast("int"))
    return (p.withColumn("_score", score).select(
        cve_of(F.col("p_partkey")).alias("cve_id"),
        F.when(F.col("p_size") % 9 == 0, F.lit("Awaiting Analysis"))
         .otherwise(F.lit("Analyzed")).alias("vuln_status"),
        modified.alias("last_modified"),
        F.array(F.concat(F.col("p_name"), F.lit(" flaw in "), F.col("p_type"))).alias("descriptions"),
        F.when(F.col("p_size") % 4 == 0, F.array(url1, url2)).otherwise(F.array(url1)).alias("references"),
        weak.alias("weaknesses"),
        F.when(F.col("_score").isNotNull(), F.array(metric)).alias("metrics_cvssMetricV31"),
    ))


@memo_plan
def feed_kev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped KEV rows: parts whose size is not a multiple of 7."""
    p = read_driver_table(spark, sf_dir, "part").filter(F.col("p_size") % 7 != 0)
    added = F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).otherwise(
        F.date_format(F.date_add(F.to_date(F.lit("2021-11-03")),
                                 (F.col("p_partkey") % 900).cast("int")), "yyyy-MM-dd"))
    return p.select(
        cve_of(F.col("p_partkey")).alias("cve_id"),
        F.col("p_brand").alias("vendor_project"),
        F.col("p_name").alias("product"),
        F.concat(F.col("p_name"), F.lit(" vulnerability")).alias("vulnerability_name"),
        added.alias("date_added"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Apply mitigations per vendor instructions."))
         .otherwise(F.concat(F.lit("Remove "), _cwe(F.col("p_size")), F.lit(" exposure.")))
         .alias("required_action"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("Known")).otherwise(F.lit("Unknown"))
         .alias("known_ransomware_campaign_use"),
        F.when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>"))
         .otherwise(F.array(_cwe(F.col("p_size")))).alias("cwes"),
    )


ROWS_PER_TASK = 400_000  # lines that one task of a feed or lookup sorts


def line_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that work over all lines is dealt out to, so that what one sorts
    doesn't grow with the table (its rows are counted from Parquet's footers)."""
    rows = read_driver_table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


@memo_plan
def feed_epss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest EPSS row per part from lineitem (N1 on ship date, order, line)."""
    li = read_driver_table(spark, sf_dir, "lineitem").filter(F.col("l_partkey") % 13 != 0) \
        .select("l_partkey", "l_discount", "l_tax", "l_shipdate", "l_orderkey", "l_linenumber")
    # group on the numeric key with numeric payload; text is derived after.
    # (order, line) repeats in these tables, so equal ship/order/line rows are
    # further ordered by discount, then tax: a total order.
    latest = latest_by_key(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_discount", "l_tax"])
    return latest.select(
        cve_of(F.col("l_partkey")).alias("cve"),
        (F.col("l_discount") * 9.87).cast(FEED_DECIMAL).alias("epss"),
        (F.col("l_tax") * 12.3).cast(FEED_DECIMAL).alias("percentile"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"))


@memo_plan
def feed_exploit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ExploitDB rows: orders of any priority but the lowest, with all their lines."""
    o = read_driver_table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") != "5-LOW")
    li = read_driver_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    # one exploit per order; its codes are the sorted distinct CVEs of the
    # order's lines (a group bounded by the lines of one order)
    n = line_tasks(spark, sf_dir)
    j = o.repartition(n, "o_orderkey").join(li.repartition(n, "o_orderkey"), "o_orderkey").groupBy("o_orderkey", "o_custkey", "o_orderdate").agg(
        F.array_sort(F.transform(F.collect_set("l_partkey"), cve_of)).alias("codes"))
    pub = F.date_format("o_orderdate", "yyyy-MM-dd")
    ck = F.col("o_custkey")
    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("exploits/"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("file"),
        pub.alias("date_published"),
        F.when(ck % 4 == 0, F.date_format(F.date_add(F.to_date("o_orderdate"), 45), "yyyy-MM-dd"))
         .alias("date_updated"),
        F.when(ck % 3 == 0, F.lit("remote")).when(ck % 3 == 1, F.lit("local"))
         .otherwise(F.lit("webapps")).alias("type"),
        F.when(ck % 2 == 0, F.lit("linux")).otherwise(F.lit("windows")).alias("platform"),
        F.when(ck % 5 == 0, F.lit("80")).when(ck % 5 == 1, F.lit("")).when(ck % 5 == 2, F.lit("8080.5"))
         .alias("port"),
        (ck % 2 == 0).alias("verified"),
        "codes",
        F.concat(F.lit("https://exploits.example/exploits/"), F.col("o_orderkey").cast("string"))
         .alias("source_url"),
    )


def _module_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the suppliers that have a module: four in five."""
    return read_driver_table(spark, sf_dir, "lineitem").filter(F.col("l_suppkey") % 5 != 0)


@memo_plan
def feed_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metasploit module rows, one per qualifying supplier (scalar fields)."""
    sk = F.col("l_suppkey")
    g = _module_rows(spark, sf_dir).groupBy("l_suppkey").agg(F.max("l_shipdate").alias("_mt"))
    return g.select(
        F.concat(F.lit("exploit/s"), sk.cast("string")).alias("fullname"),
        F.concat(F.lit("module_s"), sk.cast("string")).alias("name"),
        F.lit("exploit").alias("type"),
        F.when(sk % 3 == 0, F.lit("linux")).when(sk % 3 == 1, F.lit("windows"))
         .otherwise(F.lit("multi")).alias("platform"),
        F.concat(F.date_format("_mt", "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000")).alias("mod_time"),
    )


@memo_plan
def feed_module_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Module references in long form (fullname, ref): distinct CVEs of the
    supplier's lines plus one URL and one lower-case cve reference each.
    Long form keeps a hot supplier from being collected into one array."""
    rows = _module_rows(spark, sf_dir)
    full = F.concat(F.lit("exploit/s"), F.col("l_suppkey").cast("string"))
    # distinct on the numeric keys; text is derived after
    pairs = rows.select("l_suppkey", "l_partkey").repartition(line_tasks(spark, sf_dir), "l_suppkey", "l_partkey")
    cves = pairs.distinct().select(full.alias("fullname"), cve_of(F.col("l_partkey")).alias("ref"))
    sup = rows.select("l_suppkey").distinct()
    extra = sup.select(full.alias("fullname"), F.explode(F.array(
        F.concat(F.lit("URL-https://ref.example/s"), F.col("l_suppkey").cast("string")),
        F.lower(cve_of(F.col("l_suppkey"))))).alias("ref"))
    return cves.unionByName(extra)


def known_span(spark: SparkSession, sf_dir: str) -> F.Column:
    """A tenth more than the largest part key: the range findings draw their
    CVE numbers from (a scalar subquery, answered from Parquet statistics)."""
    return read_driver_table(spark, sf_dir, "part").agg(F.floor(F.max("p_partkey") * 11 / 10).cast("long")).scalar()


@memo_plan
def feed_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanner findings from events, in the scanner's own column names. Each
    names two CVEs over the whole key range of ``part`` (and a few numbers
    beyond it, which no feed knows), in a multi-line cell as scanners export."""
    e = read_driver_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    span = known_span(spark, sf_dir)
    cve_text = F.concat(F.lit(" "), F.lower(cve_of(eid % span)), F.lit(",\n"), cve_of(eid * 7 % span), F.lit(",\tn/a"))
    return e.select(
        eid.alias("row_id"),
        (eid % 37).cast("string").alias("Plugin ID"),
        cve_text.alias("CVE"),
        F.col("value").cast("string").alias("CVSS"),
        F.col("event_type").alias("Risk"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("Host"),
        F.lit("tcp").alias("Protocol"),
        (F.col("user_id") % 1024).cast("string").alias("Port"),
        F.concat(F.lit("Plugin "), (eid % 37).cast("string")).alias("Name"),
        F.when(F.col("event_type") == "view", F.lit(None))
         .otherwise(F.concat(F.lit("Seen "), F.col("event_type"))).alias("Synopsis"),
        F.col("props").alias("Description"),
        F.lit("Upgrade.").alias("Solution"),
        F.lit(None).cast("string").alias("See Also"),
    )
