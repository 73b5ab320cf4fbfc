"""A key holding a third of all rows: results stay whole and the plans
reduce it map-side (partial aggregate below the shuffle)."""

from pyspark.sql import functions as F

from threatspark.operators.dedup import latest_by_key
from threatspark.plans import findings
from tests.test_findings import make_fact


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_key_hot_key(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"), (F.col("id") * 7 % 1000).alias("w"))
    out = latest_by_key(df.repartition(8), ["k"], ["w", "v"])
    assert out.count() == 1 + (n - n // 3)
    hot = out.filter("k = -1").first()
    want = df.filter("k = -1").orderBy(F.desc("w"), F.desc("v")).first()
    assert (hot["w"], hot["v"]) == (want["w"], want["v"])
    plan = _plan(out)
    assert "partial_max" in plan and plan.index("Exchange") < plan.rindex("partial_max")


def test_enrichment_hot_cve_set(spark):
    fact = make_fact(spark)
    n = 3000
    f = spark.range(n).select(
        F.col("id").alias("row_id"), F.lit("h").alias("Host"), F.col("id").cast("string").alias("Plugin ID"),
        F.when(F.col("id") % 3 == 0, F.lit("CVE-2013-2566,CVE-2015-2808"))
         .otherwise(F.concat(F.lit("CVE-1999-000"), (F.col("id") % 3 + 1).cast("string"))).alias("CVE"))
    rep = findings.enrich_findings(f, fact)
    rows = rep.collect()
    assert len(rows) == n                                                    # nothing dropped
    hot = [r for r in rows if r["row_id"] % 3 == 0]
    assert len(hot) == n // 3 and all(r["vulnerabilities"] == ["CVE-2013-2566", "CVE-2015-2808"] for r in hot)
    assert len({r["vrr_score"] for r in hot}) == 1
    intel = findings.finding_intel(f, fact)
    assert "partial" in _plan(intel)            # distinct CVE sets are reduced map-side
