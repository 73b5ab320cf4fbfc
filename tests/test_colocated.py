import contextlib

from threatspark.plans import fact as fact_mod
from threatspark.plans.colocated import SIDES, _name, colocated, fact_colocated, store_colocated


@contextlib.contextmanager
def conf(spark, **values):
    old = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def tables(spark):
    nvd = spark.range(500).selectExpr("concat('CVE-2024-', id) cve_id", "array(concat('CWE-', id % 9)) weaknesses", "array(named_struct('cvssData', named_struct('baseScore', cast(id % 10 as double)))) metrics_cvssMetricV31")
    kev = spark.range(0, 700, 3).selectExpr("concat('CVE-2024-', id) cve_id", "'vendor' vendor_project", "'p' product", "'n' vulnerability_name")
    epss = spark.range(0, 500, 2).selectExpr("concat('CVE-2024-', id) cve", "cast(id / 1000 as decimal(7,5)) epss", "cast(0.5 as decimal(7,5)) percentile")
    # a third of all codes are one hot CVE; some exploits have none
    exploits = spark.range(300).selectExpr("cast(id as string) id", "concat('2024-01-', lpad(id % 28 + 1, 2, '0')) date_published",
                                           "case when id % 3 = 0 then array('CVE-2024-7') when id % 3 = 1 then array(concat('CVE-2024-', id), '') end codes",
                                           "'t' type", "'x' platform")
    modules = spark.range(50).selectExpr("concat('m', id) fullname", "cast(id as string) mod_time", "array(concat('CVE-2024-', id * 5), 'URL-x') references",
                                         "cast(id as int) rank", "concat('n', id) name")
    return nvd, kev, epss, exploits, modules


def rows(df):
    return sorted(map(repr, df.select("cve_id", "vrr_score", "threats").collect()))


def test_no_exchange_and_the_same_fact(spark, tmp_path):
    nvd, kev, epss, exploits, modules = tables(spark)
    whole = fact_mod.build_fact(nvd, kev, epss, fact_mod.exploit_lookup(exploits), fact_mod.module_lookup(modules))
    folder = store_colocated(spark, nvd, kev, epss, exploits, modules, None, str(tmp_path / "a"), buckets=6)
    got = fact_colocated(spark, folder)
    assert rows(got) == rows(whole) and got.count() == 500
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = fact_colocated(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
        plan = fact_mod.build_fact(nvd, kev, epss, fact_mod.exploit_lookup(exploits), fact_mod.module_lookup(modules))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan


def test_another_session_finds_the_tables(spark, tmp_path):
    folder = store_colocated(spark, *tables(spark), None, str(tmp_path / "b"), buckets=3)
    first = rows(fact_colocated(spark, folder))
    for side in SIDES:
        spark.sql(f"DROP TABLE {_name(folder, side)}")  # external: the files stay
    assert rows(fact_colocated(spark, folder)) == first
    files = [f for f in colocated(spark, folder)["nvd"].inputFiles()]
    assert len(files) == 3  # a file a bucket


def test_empty_sides(spark, tmp_path):
    nvd, kev, epss, exploits, modules = tables(spark)
    none = lambda df: df.filter("false")
    folder = store_colocated(spark, nvd, none(kev), none(epss), none(exploits), none(modules), None, str(tmp_path / "c"))
    assert folder.endswith("buckets-1") and fact_colocated(spark, folder).count() == 500
    folder = store_colocated(spark, none(nvd), kev, epss, exploits, modules, None, str(tmp_path / "d"))
    assert fact_colocated(spark, folder).count() == 0


def test_tasks_of_the_exploit_lookup_follow_the_lines(spark, tmp_path, monkeypatch):
    """What a task sorts doesn't grow with the table: lines are dealt out to more tasks."""
    from threatspark.plans import feeds
    monkeypatch.setattr(feeds, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(feeds, "_PLANS", {})
    spark.range(300).selectExpr("id o_orderkey", "id o_custkey", "if(id % 9 = 0, '5-LOW', '1-URGENT') o_orderpriority",
                                "timestamp_ntz'2024-01-01' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1200).selectExpr("id % 300 l_orderkey", "id % 40 l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        exploits = feeds.feed_exploit(spark, str(tmp_path))
        assert exploits.rdd.getNumPartitions() == feeds.line_tasks(spark, str(tmp_path)) == 12
        few, many = fact_mod.exploit_lookup(exploits), fact_mod.exploit_lookup(exploits, tasks=12)
        assert many.rdd.getNumPartitions() == 12
        assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, many.collect()), key=str) and many.count() == 40
