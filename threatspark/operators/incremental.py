"""Incremental reads and watermarks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
NVD_DEFAULT_START = "1999-01-01T00:00:00.000"
OTHER_DEFAULT_START = "1970-01-01"
SLICE_DAYS = 119
MAX_RANGE_DAYS = 120


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def since_filter(df: DataFrame, col, since, keep_null: bool) -> DataFrame:
    """keep rows strictly after ``since``; rows without a value are
    dropped (KEV) or kept (ExploitDB, Metasploit). No filter without ``since``."""
    if since is None:
        return df
    c = _c(col)
    cond = c > F.lit(since)
    return df.filter(c.isNull() | cond) if keep_null else df.filter(cond)


def exploit_change_date(updated="date_updated", published="date_published") -> Column:
    """the updated date, else the published one; empty text counts as missing."""
    return F.coalesce(F.nullif(_c(updated), F.lit("")), F.nullif(_c(published), F.lit("")))


def max_key(df: DataFrame, col) -> DataFrame:
    """G1: one-row frame holding the greatest value (nulls never win)."""
    return df.agg(F.max(_c(col)).alias("watermark"))


def sane_watermark(wm: Column, default: str) -> Column:
    """Text watermarks holding ',' or 'score_date' are corrupt -> full
    refresh; a missing watermark starts from the default."""
    bad = wm.contains(",") | wm.contains("score_date")
    return F.coalesce(F.when(~bad, wm), F.lit(default))


def incremental(df: DataFrame, col, watermark, lookback: _dt.timedelta | None = None) -> DataFrame:
    """F6 (+R3 lookback): rows with ``col`` > watermark; none filtered when
    there is no watermark. A lookback re-reads a margin before the watermark
    so back-dated rows are not lost (duplicates are absorbed by the upsert)."""
    if watermark is None:
        return df
    lo = F.lit(watermark)
    if lookback is not None:
        lo = lo - F.make_dt_interval(secs=F.lit(lookback.total_seconds()))
    return df.filter(_c(col) > lo)


def repair(bronze: DataFrame, silver: DataFrame, key: str) -> DataFrame:
    """Bronze rows whose key never reached silver."""
    return bronze.join(silver.select(key), key, "left_anti")


def range_filter(df: DataFrame, col, lo, hi) -> DataFrame:
    """closed range [lo, hi], pushed to the Parquet scan as two bounds."""
    c = _c(col)
    return df.filter((c >= F.lit(lo)) & (c <= F.lit(hi)))


def snapshot_gate(meta: DataFrame, since: str | None, date_col: str = "score_date") -> DataFrame:
    """drop whole snapshots dated on or before ``since``; snapshots
    without a date always pass."""
    if since is None:
        return meta
    d = F.col(date_col)
    return meta.filter(d.isNull() | (d > F.lit(since)))


def slice_bounds(start: Column, end: Column) -> Column:
    """The time slices of [start, end] as an array of (lo, hi) structs:
    119-day steps whose closed ends overlap, the last one ending at ``end``;
    one slice when the range is at most 120 whole days."""
    step = F.make_dt_interval(days=F.lit(SLICE_DAYS))
    days = F.floor((F.unix_micros(end) - F.unix_micros(start)) / 86_400_000_000)
    los = F.when(days > MAX_RANGE_DAYS,
                 F.sequence(start, end - F.make_dt_interval(secs=F.lit(0.000001)), step)) \
        .otherwise(F.array(start))
    return F.transform(los, lambda lo, i: F.struct(
        i.alias("slice_no"), lo.alias("lo"),
        F.when(days > MAX_RANGE_DAYS, F.least(lo + step, end)).otherwise(end).alias("hi")))


def read_by_slices(df: DataFrame, ts_col: str) -> DataFrame:
    """A4: the rows as a backfill by slices delivers them, with ``slice_no``;
    a row on an edge is in both slices. Like rows_per_slice, a row works out
    its slices from its offset to the start; there is no join."""
    ts = F.col(ts_col).cast("timestamp")
    bounds = df.agg(F.min(ts).alias("s"), F.max(ts).alias("e"))
    b = bounds.select(F.struct("s", F.size(slice_bounds(F.col("s"), F.col("e"))).alias("n")).alias("b")).scalar()
    step = SLICE_DAYS * 86_400_000_000
    off = F.unix_micros(ts) - F.unix_micros(b["s"])
    k = F.when(b["n"] == 1, F.lit(0)).otherwise((off - off % step) / step).cast("int")
    placed = df.withColumn("_c0", F.when(k < b["n"], k)).withColumn("_c1", F.when((b["n"] > 1) & (off % step == 0) & (k > 0), k - 1))
    return placed.withColumn("slice_no", F.explode(F.array("_c0", "_c1"))).filter(F.col("slice_no").isNotNull()).drop("_c0", "_c1")


def join_intervals(points: DataFrame, ts: str, intervals: DataFrame, lo: str, hi: str) -> DataFrame:
    """J12 for any intervals: the pairs of a point and an interval [lo, hi]
    (closed) that holds it, as an equi-join. An interval is cut into bins of
    the least power of four (in microseconds) above its length, so it meets
    two bins at most, long ones coarser bins than short ones. A point asks one
    bin of each width that some interval has (33 widths at most reach the
    driver); the exact test follows. Rows with a null or reversed interval or
    a null time join nothing; a pair comes once. Columns of both sides must
    have different names."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    length = micros(hi) - micros(lo)
    even = F.length(F.bin(length)) + F.length(F.bin(length)) % 2      # 4 ** (even / 2) > length
    shifted = lambda x, by: F.call_function("shiftright", x, by)
    held = intervals.filter(length >= 0).withColumn("_level", even.cast("int"))
    first, last = shifted(micros(lo), F.col("_level")), shifted(micros(hi), F.col("_level"))
    cut = held.withColumn("_bin", F.explode(F.when(first == last, F.array(first)).otherwise(F.array(first, last))))
    levels = sorted(r[0] for r in held.select("_level").distinct().collect())
    asked = F.array(*[F.struct(F.lit(n).alias("l"), shifted(micros(ts), F.lit(n)).alias("b")) for n in levels]) if levels else \
        F.array().cast("array<struct<l:int,b:bigint>>")
    probe = points.filter(F.col(ts).isNotNull()).withColumn("_asked", F.explode(asked)).withColumns({"_l": F.col("_asked.l"), "_b": F.col("_asked.b")}).drop("_asked")
    on = (F.col("_l") == F.col("_level")) & (F.col("_b") == F.col("_bin"))
    within = (micros(ts) >= micros(lo)) & (micros(ts) <= micros(hi))
    return probe.join(cut, on & within).drop("_l", "_b", "_level", "_bin")


def day_or_within(ts) -> Column:
    """A time that meets the same intervals between whole days (midnights) as
    ``ts``: midnight itself, or noon for any other time of that day. Points
    are added up by it before ``join_intervals``, which then pairs two points
    a day at most, however many rows there are."""
    t = _c(ts).cast("timestamp")
    day = F.date_trunc("day", t)
    return F.when(t == day, day).otherwise(day + F.make_dt_interval(hours=F.lit(12)))


def rows_per_slice(df: DataFrame, ts_col: str, start: Column | None = None,
                   end: Column | None = None) -> DataFrame:
    """J12 without a nested-loop join: each row computes the one or two slices
    that contain it (closed, overlapping ends) from its offset to the start,
    and the counts are a partial-aggregated group-by on the slice number.

    ``start``/``end`` default to the data's own min/max (one global aggregate,
    used as a scalar subquery)."""
    ts = F.col(ts_col).cast("timestamp")
    bounds = df.agg(F.min(ts).alias("_s"), F.max(ts).alias("_e")) if start is None else \
        df.sparkSession.range(1).select(start.alias("_s"), end.alias("_e"))
    slices = bounds.select(F.explode(slice_bounds(F.col("_s"), F.col("_e"))).alias("x"), "_s", "_e") \
        .select("x.*", "_s", "_e")
    # one scalar subquery (start, end, number of slices), evaluated once and
    # inlined into the row scan: no join at all
    b = slices.agg(F.struct(F.first("_s").alias("s"), F.first("_e").alias("e"),
                            F.count(F.lit(1)).alias("n")).alias("b")).scalar()
    step = SLICE_DAYS * 86_400_000_000
    rows = df.select(ts.alias("_ts"))
    off = F.unix_micros("_ts") - F.unix_micros(b["s"])
    k = F.when(b["n"] == 1, F.lit(0)).otherwise((off - off % step) / step).cast("int")
    on_edge = (b["n"] > 1) & (off % step == 0) & (k > 0)
    inside = (F.col("_ts") >= b["s"]) & (F.col("_ts") <= b["e"])
    # the two candidates are plain columns first: a subquery may not sit
    # inside a higher-order function or a generator
    cand = rows.filter(inside).select(F.when(k < b["n"], k).alias("_c0"),
                                      F.when(on_edge, k - 1).alias("_c1"))
    hits = cand.select(F.explode(F.array("_c0", "_c1")).alias("slice_no")) \
        .filter(F.col("slice_no").isNotNull())
    counts = hits.groupBy("slice_no").agg(F.count("*").alias("n_rows"))
    return slices.select("slice_no", "lo", "hi").join(counts, "slice_no", "left") \
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
