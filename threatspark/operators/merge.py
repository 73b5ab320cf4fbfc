"""Keyed merges without a table format.

``upsert`` never shuffles the whole target just to touch a few keys: the
target is split into rows whose key is in the incoming batch (semi join) and
the rest (anti join). AQE broadcasts the incoming keys when the batch is small
and falls back to sort-merge joins when it is not. Only touched rows go
through the merge expressions; untouched rows are carried over unchanged.

Tables are data folders plus numbered commit files that name the folders in
use (``commit_table`` / ``upsert_bucketed`` / ``read_current``): a reader never
sees a half-written table, a write never touches the folder it reads from, and
nothing but the absence of all commits counts as "no table yet".

A bucketed table grows by linear hashing: the commit holds a level and a split
pointer, and a load that takes the table over ``per_bucket`` rows a bucket
splits the next buckets in turn, by one more bit of the key's hash. Only those
and the buckets with incoming keys are rewritten. Each commit also names the
keys it changed, so that a later layer can ask for what has changed since the
version it last saw (``changed_keys``).

Bucket files are sorted by the key, in narrow row groups with Bloom filters of
it, so that a few keys are read from a few pages of a few files (``rows_of``).
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatspark.operators.dedup import latest_by_key

NEW = "__new_"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def upsert(target: DataFrame | None, incoming: DataFrame, key: str | Sequence[str], *,
           order: Sequence[str | Column] | None = None, nulls: str = "overwrite",
           audit: tuple[str, str] | None = None, run_ts: _dt.datetime | Column | None = None,
           drop_columns: Sequence[str] = (), keep_newer: bool = False) -> DataFrame:
    """Merge ``incoming`` into ``target`` on ``key``.

    nulls="overwrite" (C1): columns present in the incoming schema replace the
    old values, nulls included; columns the incoming schema lacks keep their
    old values. nulls="keep" (C6): a null incoming value keeps the old one.
    ``order``: last-record-wins order for duplicate keys in one batch (N1).
    ``keep_newer``: the order also holds between batches; a stored row that is
    greater by ``order`` (column names) than the incoming one stays as it is.
    ``audit`` = (created_col, updated_col) (C2): updated is ``run_ts`` for
    touched keys, created is kept, or ``run_ts`` for new keys.
    ``drop_columns``: legacy columns unset on touched rows (B20); rows the
    batch does not touch keep them, as a per-document unset would.
    """
    keys = _keys(key)
    if order is not None:
        incoming = latest_by_key(incoming, keys, order)
    if isinstance(run_ts, Column):
        ts = run_ts.cast("timestamp")
    else:
        ts = F.lit(run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    if audit:
        incoming = incoming.drop(*[c for c in audit if c in incoming.columns])
    if target is None:
        out = incoming
        if audit:
            out = out.withColumn(audit[0], ts).withColumn(audit[1], ts)
        return out.drop(*[c for c in drop_columns if c in out.columns])

    drop = [c for c in drop_columns if c in target.columns]
    incoming = incoming.drop(*drop)
    in_cols = [c for c in incoming.columns if c not in keys]
    t_cols = [c for c in target.columns if c not in keys]
    inc_keys = incoming.select(*keys)
    untouched = target.join(inc_keys, keys, "left_anti")
    touched = target.join(inc_keys, keys, "left_semi")

    renamed = incoming.select(*keys, *[F.col(c).alias(NEW + c) for c in in_cols],
                              F.lit(True).alias("__in"))
    old = touched.withColumn("__old", F.lit(True))
    j = renamed.join(old, keys, "left")

    all_cols = t_cols + [c for c in in_cols if c not in t_cols]
    exprs = []
    for c in all_cols:
        if audit and c == audit[0]:
            exprs.append(F.coalesce(F.col(c), ts).alias(c))
        elif audit and c == audit[1]:
            exprs.append(ts.alias(c))
        elif c in drop:
            exprs.append(F.lit(None).cast(target.schema[c].dataType).alias(c))
        elif c in in_cols and c in t_cols:
            new = F.col(NEW + c)
            exprs.append((F.coalesce(new, F.col(c)) if nulls == "keep" else new).alias(c))
        elif c in in_cols:
            exprs.append(F.col(NEW + c).alias(c))
        else:
            exprs.append(F.col(c))
    if audit:
        for c in audit:
            if c not in all_cols:
                exprs.append(ts.alias(c))
                all_cols.append(c)
    if keep_newer:
        names = list(order)
        have = [n for n in names if n in t_cols]
        stored_wins = F.lit(False) if not have else F.coalesce(F.col("__old"), F.lit(False)) & (
            F.struct(*[F.col(n) for n in have]) > F.struct(*[F.col(NEW + n) for n in have]))
        j = j.withColumn("__keep", stored_wins)
        exprs = [e if c not in t_cols else F.when(F.col("__keep"), F.col(c)).otherwise(e).alias(c) for c, e in zip(all_cols, exprs)]
    merged = j.select(*keys, *exprs)
    for c in all_cols:
        if c not in untouched.columns:
            untouched = untouched.withColumn(c, F.lit(None).cast(merged.schema[c].dataType))
    return untouched.select(*keys, *all_cols).unionByName(merged.select(*keys, *all_cols))


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add incoming rows whose key is new; existing keys are left alone."""
    keys = _keys(key)
    fresh = incoming.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def merge_stats(target: DataFrame, incoming: DataFrame, key: str | Sequence[str],
                compare: Sequence[str] | None = None) -> DataFrame:
    """Processed / inserted / matched / modified counts of one upsert.
    'modified' = matched keys where any compared column differs (null-safe)."""
    keys = _keys(key)
    cols = list(compare) if compare is not None else \
        [c for c in incoming.columns if c not in keys and c in target.columns]
    t = target.select(*keys, *[F.col(c).alias("__t_" + c) for c in cols], F.lit(True).alias("__hit"))
    j = incoming.join(t, keys, "left")
    diff = F.lit(False)
    for c in cols:
        diff = diff | ~F.col(c).eqNullSafe(F.col("__t_" + c))
    agg = j.agg(F.count("*").alias("processed"),
                F.count_if(F.col("__hit").isNull()).alias("inserted"),
                F.count_if(F.col("__hit")).alias("matched"),
                F.count_if(F.col("__hit") & diff).alias("modified"))
    return agg.unpivot([], ["processed", "inserted", "matched", "modified"], "status", "n")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    keys = _keys(key)
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Fail when a key repeats."""
    dup = duplicate_keys(df, key).limit(5).collect()  # at most five rows reach the driver
    if dup:
        raise ValueError(f"duplicate keys: {[tuple(r) for r in dup]}")


# ------------------------------------------------------------ tables

BUCKET = "_bucket"
PER_BUCKET = 1_000_000      # rows of a bucket on average, at most
KEEP_CHANGES = 100          # commits whose changed keys are kept; a reader behind them takes the whole table
RETENTION_S = 86_400        # seconds that a superseded version stays readable
GROUP_BYTES = 16 << 20      # of a row group in a bucket file
LOOKUP_KEYS = 1_000         # keys that are looked up by filters on the files; more by a join
_PUSHED = 10                # values of an IN that Spark's Parquet filters take one by one


@dataclass(frozen=True)
class Commit:
    """What a table consists of: ``parts`` maps each bucket ("" if the table
    has none) to the data folder that holds it, ``rows`` to its row count.
    ``base`` buckets have been doubled ``level`` times, and the first
    ``split`` of them once more. ``changes``: by version, the folder with the
    keys that it changed. ``seen``: what the writer had read to make it;
    ``incoming``: the rows that the load brought."""

    version: int
    schema: str
    buckets: int
    key: list[str]
    parts: dict[str, str]
    base: int = 0
    level: int = 0
    split: int = 0
    rows: dict[str, int] = field(default_factory=dict)
    changes: dict[str, str] = field(default_factory=dict)
    seen: dict[str, str] = field(default_factory=dict)
    incoming: int = 0


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commit_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, f"{path}/_commits")
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))


def _load(spark: SparkSession, path: str, name: str) -> Commit:
    text = "\n".join(r[0] for r in spark.read.text(f"{path}/_commits/{name}").collect())  # a line per table
    return Commit(**json.loads(text))


def current_commit(spark: SparkSession, path: str) -> Commit | None:
    """None only where no commit exists; a commit that can't be read raises."""
    names = _commit_names(spark, path)
    return _load(spark, path, names[-1]) if names else None


def current_version(spark: SparkSession, path: str) -> int | None:
    c = current_commit(spark, path)
    return c and c.version


def _write_commit(spark: SparkSession, path: str, c: Commit) -> None:
    """The commit file appears whole, by a rename; one writer at a time."""
    final, part = f"{path}/_commits/{c.version:012d}.json", f"{path}/_commits/.{uuid.uuid4().hex}"
    fs, p = _folder(spark, part)
    out = fs.create(p, False)
    out.write(bytearray(json.dumps(c.__dict__).encode()))
    out.close()
    fs, to = _folder(spark, final)
    if fs.exists(to) or not fs.rename(p, to):
        raise RuntimeError(f"{path}: version {c.version} was committed by another writer")


def vacuum(spark: SparkSession, path: str, older_than_s: float = RETENTION_S) -> int:
    """Removes versions that were superseded over ``older_than_s`` seconds ago,
    with the folders that only they refer to; returns how many. A reader has
    so long to finish with a version. Called by its own, not by a write."""
    names = _commit_names(spark, path)
    fs, p = _folder(spark, f"{path}/_commits")
    if len(names) < 2:
        return 0
    written = {f.getPath().getName(): f.getModificationTime() / 1000 for f in fs.listStatus(p)}
    old = [n for n, after in zip(names, names[1:]) if time.time() - written[after] >= older_than_s]
    keep = [_load(spark, path, n) for n in names if n not in old]
    used = {x for c in keep for x in c.parts.items()}
    used_changes = {x for c in keep for x in c.changes.values()}
    for name in old:
        c = _load(spark, path, name)
        gone = [_part(path, b, g) for b, g in c.parts.items() if (b, g) not in used]
        gone += [f"{path}/changes/{x}" for x in c.changes.values() if x not in used_changes]
        for folder in gone + [f"{path}/_commits/{name}"]:
            fs, p = _folder(spark, folder)
            fs.delete(p, True)
    return len(old)


def _part(path: str, bucket: str, folder: str) -> str:
    return f"{path}/data/{folder}" + (f"/{BUCKET}={bucket}" if bucket else "")


def _read(spark: SparkSession, path: str, c: Commit, buckets: Sequence[int] | None = None) -> DataFrame | None:
    schema = T.StructType.fromJson(json.loads(c.schema))
    folders = [_part(path, b, g) for b, g in c.parts.items() if buckets is None or b == "" or int(b) in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else None


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as last committed; None where there is none. Rows written
    before a column was added have null in it."""
    c = current_commit(spark, path)
    return None if c is None else _read(spark, path, c)


read_bucketed = read_current


def commit_table(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Replace the contents. The new data go to a folder of their own
    and count once the commit file is there, so readers are never disturbed."""
    folder = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{folder}")
    v = (current_version(spark, path) or 0) + 1
    _write_commit(spark, path, Commit(v, df.schema.json(), 0, [], {"": folder}))
    return v


def upsert_table(spark: SparkSession, path: str, incoming: DataFrame, key, **kw) -> DataFrame:
    """Read the current version, merge, commit a new version; returns it."""
    merged = upsert(read_current(spark, path), incoming, key, **kw)
    commit_table(spark, merged, path)
    return read_current(spark, path)


def _write_buckets(placed: DataFrame, key: Sequence[str], folder: str) -> None:
    """One file a bucket, sorted by the key, with Bloom filters of its columns."""
    writer = placed.repartition(BUCKET).sortWithinPartitions(BUCKET, *key).write.partitionBy(BUCKET)
    writer = writer.option("parquet.block.size", GROUP_BYTES).option("parquet.bloom.filter.adaptive.enabled", "true")
    for k in key:
        if isinstance(placed.schema[k].dataType, (T.StringType, T.IntegerType, T.LongType)):  # Bloom filters know no other types of ours
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.parquet(folder)


def rows_of(spark: SparkSession, path: str, keys: DataFrame, most: int = LOOKUP_KEYS) -> DataFrame | None:
    """The rows of a bucketed table with one key column whose key is in
    ``keys`` (its first column; nulls and repeats don't matter). Up to ``most``
    keys (so many reach the driver) select the buckets to open and are pushed
    to their files as equalities, which sorted pages and Bloom filters answer
    without reading the rest; more keys take part in a semi join, after which
    the planner has both sides' sizes. None where there is no table."""
    c = current_commit(spark, path)
    if c is None:
        return None
    if not c.buckets or len(c.key) != 1:
        raise ValueError(f"{path} has no buckets by one column")
    key = c.key[0]
    kind = T.StructType.fromJson(json.loads(c.schema))[key].dataType
    wanted = keys.select(F.col(keys.columns[0]).cast(kind).alias(key)).filter(F.col(key).isNotNull()).distinct()
    few = with_bucket(wanted.limit(most + 1), key, c.base, c.level, c.split).collect()
    if len(few) > most:
        return _read(spark, path, c).join(wanted, key, "left_semi")
    rows = _read(spark, path, c, {r[BUCKET] for r in few}) if few else None
    if rows is None:
        return _read(spark, path, c).filter("false") if c.parts else spark.createDataFrame([], T.StructType.fromJson(json.loads(c.schema)))
    values = sorted(r[key] for r in few)
    tests = [F.col(key).isin(values[i:i + _PUSHED]) for i in range(0, len(values), _PUSHED)]
    while len(tests) > 1:  # in pairs, so that the condition isn't deep
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2:]
    return rows.filter(tests[0])


def buckets_for(rows: int, per_bucket: int = PER_BUCKET) -> int:
    """Bucket count for a table expected to reach ``rows``."""
    return max(4, -(-rows // per_bucket))


def grown(base: int, buckets: int) -> tuple[int, int]:
    """(level, split) of a table of ``base`` buckets that has grown to ``buckets``."""
    level = 0
    while base << (level + 1) <= buckets:
        level += 1
    return level, buckets - (base << level)


def with_bucket(df: DataFrame, key: str | Sequence[str], base: int, level: int = 0, split: int = 0) -> DataFrame:
    """Adds the bucket: the hash modulo the buckets of the level, or of the
    next one for buckets before the split pointer."""
    h = F.xxhash64(*[F.col(k) for k in _keys(key)])
    low = F.pmod(h, F.lit(base << level))
    return df.withColumn(BUCKET, F.when(low < split, F.pmod(h, F.lit(base << (level + 1)))).otherwise(low).cast("int"))


def split_buckets(base: int, old: int, new: int) -> set[int]:
    """The buckets that lose rows when a table grows from ``old`` to ``new`` buckets."""
    out = set()
    for b in range(old, new):
        level, _ = grown(base, b)
        source = b - (base << level)
        out.add(source if source < old else next(x for x in _ancestors(base, source) if x < old))
    return out


def _ancestors(base: int, bucket: int):
    while bucket >= base:
        level, _ = grown(base, bucket)
        bucket -= base << level
        yield bucket


def _only_scanned(df: DataFrame) -> bool:
    """Whether to work ``df`` out again is but a scan of the columns asked for:
    deterministic projections and filters of stored Parquet rows."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.child()
    return plan.nodeName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" \
        and plan.relation().fileFormat().toString() == "Parquet"


def upsert_bucketed(spark: SparkSession, path: str, incoming: DataFrame, key: str | Sequence[str],
                    buckets: int | None = None, per_bucket: int = PER_BUCKET, seen: dict[str, str] | None = None, **kw) -> int:
    """Upsert into a table split by a hash bucket of the key, rewriting only
    the buckets that the batch touches: O(touched buckets), not O(table). The
    touched buckets' row counts (an integer each, all that reaches the driver)
    select the folders to read; each merged bucket is written once, as one
    file, and the commit points to it.

    ``buckets`` is the count that a new table starts with (4 if None); another
    one than the table started with raises. While rows stored and incoming
    exceed ``per_bucket`` a bucket, further buckets are split off, so that a
    bucket's size is bounded however the table grows. ``seen``: notes of the
    writer, kept in the commit. ``incoming`` is worked out once and kept until
    the load ends; rows that are only to be read from Parquet are read again
    instead. Returns the number of buckets rewritten."""
    c = current_commit(spark, path)
    if c is not None and not c.buckets:
        raise ValueError(f"{path} has no buckets")
    base = (c.base or c.buckets) if c is not None else buckets or 4
    if c is not None and (buckets not in (None, base) or _keys(key) != c.key):
        raise ValueError(f"{path} started with {base} buckets by {c.key}, not {buckets} by {_keys(key)}")
    have = c.buckets if c is not None else base
    kept = not _only_scanned(incoming)
    inc = incoming.persist(StorageLevel.MEMORY_AND_DISK) if kept else incoming
    try:
        counts = {r[0]: r[1] for r in with_bucket(inc, key, base, *grown(base, have)).groupBy(BUCKET).count().collect()}
        if not counts and c is not None:
            return 0
        rows = sum(counts.values()) + (sum(c.rows.values()) if c is not None else 0)
        want = max(have, -(-rows // per_bucket))
        level, split = grown(base, want)
        old_ids = sorted(set(counts) | split_buckets(base, have, want))
        target = None if c is None else _read(spark, path, c, old_ids)
        if target is None and c is not None:  # none of these buckets has rows yet
            target = spark.createDataFrame([], T.StructType.fromJson(json.loads(c.schema)))
        merged = upsert(target, inc, key, **kw)
        old = [] if c is None else T.StructType.fromJson(json.loads(c.schema)).fields
        known = {f.name for f in merged.schema.fields}
        schema = T.StructType(merged.schema.fields + [f for f in old if f.name not in known])
        folder, version = uuid.uuid4().hex, 1 if c is None else c.version + 1
        placed = with_bucket(merged, key, base, level, split)
        _write_buckets(placed, _keys(key), f"{path}/data/{folder}")
        written = _bucket_rows(spark, f"{path}/data/{folder}")
        inc.select(*_keys(key)).distinct().write.parquet(f"{path}/changes/{folder}")
        gone = {str(b) for b in old_ids}
        parts = {} if c is None else {b: g for b, g in c.parts.items() if b not in gone}
        sizes = {} if c is None else {b: n for b, n in c.rows.items() if b not in gone}
        changes = {} if c is None else dict(c.changes)
        changes[str(version)] = folder
        _write_commit(spark, path, Commit(
            version, schema.json(), want, _keys(key), parts | {b: folder for b in written}, base, level, split, sizes | written,
            dict(list(changes.items())[-KEEP_CHANGES:]), ({} if c is None else c.seen) | (seen or {}), sum(counts.values())))
        return len(written)
    finally:
        if kept:
            inc.unpersist()


def replace_bucketed(spark: SparkSession, df: DataFrame, path: str, key: str | Sequence[str], rows: int | None = None,
                     per_bucket: int = PER_BUCKET, seen: dict[str, str] | None = None) -> int:
    """C4 for a bucketed table: new contents, in buckets for ``rows`` rows
    (counted if None, for which ``df`` is worked out once and kept until it is
    written). Its readers' changed keys start anew. Returns the version."""
    own = rows is None and df.storageLevel == StorageLevel.NONE
    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if own else df
    try:
        base = buckets_for(kept.count() if rows is None else rows, per_bucket)
        folder, version = uuid.uuid4().hex, (current_version(spark, path) or 0) + 1
        _write_buckets(with_bucket(kept, key, base), _keys(key), f"{path}/data/{folder}")
    finally:
        if own:
            kept.unpersist()
    written = _bucket_rows(spark, f"{path}/data/{folder}")
    _write_commit(spark, path, Commit(version, df.schema.json(), base, _keys(key), {b: folder for b in written}, base, 0, 0, written, {}, seen or {}))
    return version


def _bucket_rows(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows of each bucket folder, from the files' footers."""
    fs, p = _folder(spark, folder)
    if not any(f.getPath().getName().startswith(f"{BUCKET}=") for f in fs.listStatus(p)):
        return {}  # no rows
    counts = spark.read.parquet(folder).groupBy(BUCKET).count().collect()  # a row per bucket written
    return {str(r[0]): r[1] for r in counts}


def changed_keys(spark: SparkSession, path: str, since: int) -> DataFrame | None:
    """The keys that commits after version ``since`` changed, each once; None
    where that is no longer known (older than the kept changes, or a commit
    that replaced the contents), so that all rows count as changed."""
    c = current_commit(spark, path)
    if c is None:
        return None
    wanted = [str(v) for v in range(since + 1, c.version + 1)]
    if since > c.version or any(v not in c.changes for v in wanted):
        return None
    if not wanted:
        return _read(spark, path, c).select(*c.key).limit(0)
    return spark.read.parquet(*[f"{path}/changes/{c.changes[v]}" for v in wanted]).distinct()


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows to a plain folder of Parquet files that only ever grows (quarantine)."""
    df.write.mode("append").parquet(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def read_appended(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.option("mergeSchema", "true").parquet(path) if folder_exists(spark, path) else None
