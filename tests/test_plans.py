"""What the plans must look like at scale."""

from pyspark.sql import functions as F

from threatspark.operators import merge
from threatspark.operators.dedup import latest_by_key
from threatspark.operators.incremental import range_filter
from threatspark.plans import findings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "timestamp_seconds(id) ts", "'x' wide").write.parquet(str(tmp_path / "t"))
    p = plan(range_filter(spark.read.parquet(str(tmp_path / "t")).select("ts"), "ts", "1970-01-01", "1970-01-02"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p and "ReadSchema: struct<ts:timestamp>" in p


def test_last_wins_combines_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id v", "cast(id as string) s")
    p = plan(latest_by_key(df, ["k"], ["v"]))
    assert p.index("partial_max") > p.index("Exchange")  # printed bottom-up: below the exchange


def test_untouched_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_bucketed(spark, path, spark.range(400).withColumnRenamed("id", "k"), "k", buckets=8)
    c = merge.current_commit(spark, path)
    files = merge._read(spark, path, c, [3]).inputFiles()
    assert files and all("_bucket=3/" in f for f in files)


def test_findings_without_cves_are_spread(spark):
    n = 4000
    f = spark.range(n).select(F.col("id").alias("row_id"), F.lit("N/A").alias("CVE"), F.lit("h").alias("Host"), F.lit("1").alias("Plugin ID"))
    fact = spark.createDataFrame([("CVE-1", 1.0, ("a",))], "cve_id string, vrr_score double, threats struct<CISA_product:string>")
    out = findings.enrich_findings(f, fact)
    assert out.count() == n and out.filter("vrr_score <> 0").count() == 0
    assert "pmod(xxhash64(" in plan(out)
