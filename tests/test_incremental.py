import datetime as dt

from pyspark.sql import functions as F

from threatspark.operators import incremental as inc


def test_since_filters(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), (None,)], "d string")
    assert inc.since_filter(df, "d", "2024-01-01", keep_null=False).count() == 1
    assert inc.since_filter(df, "d", "2024-01-01", keep_null=True).count() == 2
    assert inc.since_filter(df, "d", None, keep_null=False).count() == 3
    x = spark.createDataFrame([("", "2020-01-01"), ("2021-01-01", "2019-01-01"), (None, None)],
                              "date_updated string, date_published string")
    got = [r[0] for r in x.select(inc.exploit_change_date()).collect()]
    assert got == ["2020-01-01", "2021-01-01", None]


def test_watermark_sanity(spark):
    df = spark.createDataFrame([("2024-01-01",), ("a,b",), ("score_date:x",), (None,)], "w string")
    got = [r[0] for r in df.select(inc.sane_watermark(F.col("w"), "1970-01-01")).collect()]
    assert got == ["2024-01-01", "1970-01-01", "1970-01-01", "1970-01-01"]
    assert inc.max_key(df.filter("w like '2%'"), "w").first()["watermark"] == "2024-01-01"


def test_incremental_lookback_and_repair(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 10)),
                                (3, dt.datetime(2024, 1, 9, 12))], "k int, t timestamp")
    wm = dt.datetime(2024, 1, 10)
    assert inc.incremental(df, "t", wm).count() == 0          # Q2: strict '>'
    assert inc.incremental(df, "t", wm, dt.timedelta(days=1)).count() == 2  # R3 lookback
    assert inc.incremental(df, "t", None).count() == 3
    silver = df.filter("k = 1")
    assert sorted(r["k"] for r in inc.repair(df, silver, "k").collect()) == [2, 3]


def _brute(ts, start, end, step_days=119):
    step = dt.timedelta(days=step_days)
    slices = []
    if (end - start).days > 120:
        cur = start
        while cur < end:
            hi = min(cur + step, end)
            slices.append((cur, hi))
            cur = hi
    else:
        slices.append((start, end))
    return [(i, lo, hi, sum(1 for t in ts if lo <= t <= hi)) for i, (lo, hi) in enumerate(slices)]


def test_rows_per_slice_matches_brute_force(spark):
    base = dt.datetime(2020, 1, 1)
    ts = [base + dt.timedelta(days=d) for d in (0, 1, 119, 120, 238, 300, 357, 400)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp")
    got = [(r["slice_no"], r["lo"], r["hi"], r["n_rows"]) for r in
           inc.rows_per_slice(df, "t").orderBy("slice_no").collect()]
    assert got == _brute(ts, min(ts), max(ts))
    short = ts[:3]
    df2 = spark.createDataFrame([(t,) for t in short], "t timestamp")
    got2 = [(r["slice_no"], r["lo"], r["hi"], r["n_rows"]) for r in inc.rows_per_slice(df2, "t").collect()]
    assert got2 == _brute(short, min(short), max(short))


def test_rows_per_slice_explicit_bounds(spark):
    # rows before the start and after the end belong to no slice; a row on a
    # shared closed edge is counted in both slices
    base = dt.datetime(2020, 1, 1)
    ts = [base + dt.timedelta(days=d) for d in (-5, 0, 10, 129, 200, 248, 249, 260, 500)]
    start, end = base + dt.timedelta(days=10), base + dt.timedelta(days=249)
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp")
    got = [(r["slice_no"], r["lo"], r["hi"], r["n_rows"]) for r in
           inc.rows_per_slice(df, "t", F.lit(start), F.lit(end)).orderBy("slice_no").collect()]
    assert got == _brute(ts, start, end)


def test_slices_keep_fractions_of_a_second(spark):
    import datetime as dt
    from threatspark.operators.incremental import read_by_slices, rows_per_slice
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    edge = start + dt.timedelta(days=119)
    rows = [start, edge - dt.timedelta(milliseconds=700), edge, edge + dt.timedelta(microseconds=1), start + dt.timedelta(days=238, microseconds=5)]
    df = spark.createDataFrame([(t,) for t in rows], "ts timestamp")
    assert [r["n_rows"] for r in rows_per_slice(df, "ts").orderBy("slice_no").collect()] == [3, 2, 1]
    assert sorted(r["slice_no"] for r in read_by_slices(df, "ts").collect()) == [0, 0, 0, 1, 1, 2]


def test_join_with_any_intervals(spark):
    import random

    from threatspark.operators.incremental import join_intervals
    random.seed(3)
    t0 = dt.datetime(1969, 12, 31, 23, 59, 50)  # on both sides of zero
    at = lambda s: t0 + dt.timedelta(microseconds=s)
    points = [(i, at(random.choice([0, 5, 10, 11, 10_000_000, random.randint(0, 20_000_000), random.randint(0, 10**15)]))) for i in range(300)] + [(900, None)]
    spans = [(0, 0), (5, 10), (10, 9), (0, 20_000_000), (0, 10**15), (9_999_999, 10_000_000)]
    spans += [(a, a + random.choice([0, 1, 3, 4, 15, 16, 10**6, 10**9, 10**14])) for a in (random.randint(0, 20_000_000) for _ in range(60))]
    intervals = [(i, at(a), at(b)) for i, (a, b) in enumerate(spans)] + [(800, None, at(5)), (801, at(5), None)]
    p = spark.createDataFrame(points, "i int, t timestamp")
    v = spark.createDataFrame(intervals, "j int, lo timestamp, hi timestamp")
    out = join_intervals(p, "t", v, "lo", "hi")
    want = sorted((i, j) for i, t in points for j, a, b in intervals if None not in (t, a, b) and a <= t <= b)
    assert sorted((r["i"], r["j"]) for r in out.collect()) == want and len(want) > 1000
    assert out.columns == ["i", "t", "j", "lo", "hi"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert join_intervals(p, "t", v.limit(0), "lo", "hi").count() == 0 and join_intervals(p.limit(0), "t", v, "lo", "hi").count() == 0


def test_rows_per_interval_adds_up_before_it_joins(spark, tmp_path):
    """pairs grow with the days, not with the rows; times inside a day, repeats and nulls count as before."""
    import random

    from threatspark.plans.catalog_layers import rows_per_interval
    random.seed(4)
    parts = [(k, random.randint(0, 9)) for k in (1, 2, 2, 3, 4, 50, 343)]
    at = lambda: dt.datetime(1992, 1, 1) + dt.timedelta(hours=random.choice([0, 24, 168, 5, 335, random.randint(0, 1500)]))
    items = [(at(), random.choice([1.0, 2.5, None])) for _ in range(500)] + [(None, 3.0)]
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame(items, "l_shipdate timestamp_ntz, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    q = rows_per_interval(spark, str(tmp_path))
    want = {}
    for k, size in parts:
        lo = dt.datetime(1992, 1, 1) + dt.timedelta(days=k * 7 % 2400)
        hi = lo + dt.timedelta(days=size * 40 if k % 50 == 0 else size)
        for t, x in items:
            if t is not None and lo <= t <= hi:
                n, s = want.get(k, (0, None))
                want[k] = (n + 1, s if x is None else (s or 0) + int(x))
    assert {r["p_partkey"]: (r["n_rows"], r["quantity"]) for r in q.collect()} == want and len(want) > 3
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Join"):]
