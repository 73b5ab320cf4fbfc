from decimal import Decimal

from pyspark.sql import functions as F

from threatspark.operators.incremental import range_filter, slice_bounds
from threatspark.plans import fact, rules
from threatspark.plans.findings import drop_zero_risk
from threatspark.plans.layers import REGISTRY, SourceSpec, register_source


def test_registry_extension(spark):
    """A registered rule changes the compiled score and threats."""
    extra_t = rules.ThreatRule("EPSS", "model_date", "EPSS", "date")
    extra_s = rules.ScoreRule("EPSS", "EPSS_PCT", Decimal("1.0"), "EPSS", ("percentile",), "value")
    try:
        rules.threat_rule(extra_t)
        rules.score_rule(extra_s)
        nvd = spark.createDataFrame([("CVE-1",)], "cve_id string")
        epss = spark.createDataFrame([("CVE-1", Decimal("0.5"), Decimal("0.25"), "2024-01-01")],
                                     "cve string, epss decimal(7,5), percentile decimal(7,5), date string")
        empty_k = spark.createDataFrame([], "cve_id string")
        empty_x = spark.createDataFrame([], "code string, id string, source_url string")
        empty_m = spark.createDataFrame([], "ref string, fullname string, name string")
        r = fact.build_fact(nvd, empty_k, epss, empty_x, empty_m).first()
        assert r["vrr_score"] == 5.25 and r["threats"]["EPSS_model_date"] == "2024-01-01"
        assert fact.dim_vrr(spark).count() == 6
    finally:
        rules._registry_threats.remove(extra_t)
        rules._registry_scores.remove(extra_s)
    assert len(rules.threat_rules()) == 15 and len(rules.score_rules()) == 5


def test_register_source():
    """U4: a new source is a registry entry."""
    spec = SourceSpec("custom", lambda s, p, since: None, lambda d: d, "id", "ts", "1970-01-01",
                      lambda d: (d, d), "id")
    try:
        register_source(spec)
        assert REGISTRY["custom"] is spec
    finally:
        REGISTRY.pop("custom")


def test_range_filter_and_slices(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), ("2024-03-01",)], "d string") \
        .select(F.to_timestamp("d").alias("t"))
    assert range_filter(df, "t", "2024-01-01", "2024-02-01").count() == 2       # F5 closed
    b = spark.range(1).select(slice_bounds(F.to_timestamp(F.lit("2024-01-01")),
                                           F.to_timestamp(F.lit("2024-12-31"))).alias("s")).first()["s"]
    assert len(b) == 4 and b[0]["hi"] == b[1]["lo"] and str(b[-1]["hi"]).startswith("2024-12-31")


def test_drop_zero_risk(spark):
    df = spark.createDataFrame([(0.0,), (1.5,)], "vrr_score double")
    assert drop_zero_risk(df).count() == 2 and drop_zero_risk(df, True).count() == 1   # F15
