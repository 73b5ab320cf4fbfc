"""Operator 10: URL filters with a Bloom filter cascade.

A list of blocked hosts is encoded over the corpus's complete universe of host
names (every host and all its parent domains). Level 1 is a Bloom filter of
the listed names, level 2 one of the unlisted names that pass level 1, level 3
one of the listed names that pass level 2, and so on until none is left. For
any name of the universe, the first level that rejects it tells which set it
is in, so the lookup over all pages is exact and needs no join. The list is
joined only to the distinct names, once, when the cascade is built.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from threatspark.llm import arrays
from threatspark.llm.shared import new_folder, stored
from threatspark.llm.text import mix

SHARD_WORDS = 1 << 20  # 64-bit words of one file of a level (8 MB)

# Fixed values: (verdict, host and path) rules of the query.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

# Hosts on the block list of the query; their subdomains count too.
BLOCKED_HOSTS = [
    "adult-x.example.com", "adult-x.example.net", "adult-x.example.org",
    "casino-win.example.com", "casino-win.example.net", "casino-win.example.org",
    "cheap-pills.example.com", "cheap-pills.example.net", "cheap-pills.example.org",
    "free-bets.example.com", "free-bets.example.net", "free-bets.example.org",
    "spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org",
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end. Both empty
    for a null url or one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):  # a longer one, later, overrides
        h, _, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_names(host: Column) -> Column:
    """A host and its parent domains, longest first: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


@dataclass(frozen=True)
class Cascade:
    """Folder and, by level, number of bits and of hash functions."""

    folder: str
    levels: tuple[tuple[int, int], ...]


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    """Bit positions, one row per hash function."""
    a = mix(h1 + np.uint64(level))
    b = mix(h2 ^ np.uint64(level)) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) % np.uint64(bits) for i in range(k)])


def _passes(folder: str, level: int, bits: int, k: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h1), bool)
    for row in _positions(h1, h2, level, bits, k):
        word = (row >> np.uint64(6)).astype(np.int64)
        for shard in np.unique(word // SHARD_WORDS).tolist():
            own = word // SHARD_WORDS == shard
            filled = arrays.load(f"{folder}/{level}-{shard}.npy")
            ok[own] &= (filled[word[own] % SHARD_WORDS] >> (row[own] & np.uint64(63))) & np.uint64(1) == 1
    return ok


def _hashes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2")]


def _write_level(keys: DataFrame, folder: str, level: int, bits: int, k: int) -> None:
    """Sets the bits of all keys: bits are combined by word in each task and
    over tasks; every shard of words becomes one file."""
    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _positions(*_hashes(batch), level, bits, k).ravel()
            word = (p >> np.uint64(6)).astype(np.int64)
            bit = np.uint64(1) << (p & np.uint64(63))
            order = np.argsort(word, kind="stable")
            at, first = np.unique(word[order], return_index=True)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(np.bitwise_or.reduceat(bit[order], first).view(np.int64))], ["word", "bits"])

    def write(key, rows):
        shard = key[0].as_py()
        out = np.zeros(min(SHARD_WORDS, (bits + 63) // 64 - shard * SHARD_WORDS), np.uint64)
        at = rows.column("word").to_numpy() % SHARD_WORDS
        out[at] = rows.column("bits").to_numpy().view(np.uint64)
        arrays.save(f"{folder}/{level}-{shard}.npy", out)
        return pa.table({"shard": pa.array([shard], pa.int64())})

    spark = keys.sparkSession
    words = keys.mapInArrow(set_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    n_shards = ((bits + 63) // 64 + SHARD_WORDS - 1) // SHARD_WORDS
    every = spark.range(n_shards).select((F.col("id") * SHARD_WORDS).alias("word"), F.lit(0).cast("long").alias("bits"))
    words = words.unionAll(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))  # a shard without a bit still gets its file
    words.groupBy((F.col("word") / SHARD_WORDS).cast("long").alias("shard")).applyInArrow(write, "shard long").count()


def _filtered(keys: DataFrame, folder: str, level: int, bits: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_passes(folder, level, bits, k, *_hashes(batch))))

    return keys.mapInArrow(run, keys.schema)


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """``universe``: column key, every name a lookup may ask for. ``listed``:
    column key, the names that a lookup must find. Nulls and repeats in either
    don't matter; a listed name outside the universe needs no encoding."""
    spark = universe.sparkSession
    names = universe.select("key").filter("key IS NOT NULL").distinct()
    marked = names.join(listed.select("key").distinct().withColumn("listed", F.lit(True)), "key", "left")
    h = stored(marked.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                             F.coalesce("listed", F.lit(False)).alias("listed")), "url-universe")
    inside, outside = h.filter("listed").select("h1", "h2"), h.filter("NOT listed").select("h1", "h2")
    folder, levels = new_folder(spark, "cascade"), []
    n, others = inside.count(), outside.count()
    while n:
        # The first filter is as fine as the ratio of the two sets asks for, the later ones let half pass.
        p = min(0.5, n * math.sqrt(0.5) / max(others, 1)) if not levels else 0.5
        k = max(1, round(-math.log2(p)))
        bits = max(64, math.ceil(n * k / math.log(2)))
        level = len(levels)
        _write_level(inside, folder, level, bits, k)
        levels.append((bits, k))
        wrong = stored(_filtered(outside, folder, level, bits, k), f"url-level-{level}")
        inside, outside = wrong, inside
        n, others = wrong.count(), n
    return Cascade(folder, tuple(levels))


def _listed(cascade: Cascade, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h1), bool)
    left = np.arange(len(h1))
    for level, (bits, k) in enumerate(cascade.levels):
        ok = _passes(cascade.folder, level, bits, k, h1[left], h2[left])
        out[left[~ok]] = level % 2 == 1
        left = left[ok]
    out[left] = len(cascade.levels) % 2 == 1
    return out


def block_listed(pages: DataFrame, cascade: Cascade, names: str, flag: str = "listed") -> DataFrame:
    """Adds ``flag``: whether one of the names in the array column ``names`` is
    listed. Exact for names of the cascade's universe; false for null or empty
    arrays. All columns stay."""
    columns = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [batch.column(c) for c in ("__h1", "__h2")]
            sizes = pairs[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            flat = np.stack([p.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for p in pairs])
            _, first, back = np.unique(flat[0], return_index=True, return_inverse=True)
            same = (flat[1][first][back] == flat[1]).all()
            hit = _listed(cascade, *flat[:, first])[back] if same else _listed(cascade, *flat)
            found = np.bincount(row, weights=hit, minlength=batch.num_rows) > 0
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(found)], [*columns, flag])

    hashed = pages.withColumn("__h1", F.transform(names, lambda x: F.xxhash64(x))).withColumn(
        "__h2", F.transform(names, lambda x: F.xxhash64(F.lit(1), x)))
    return hashed.mapInArrow(run, StructType(list(pages.schema.fields)).add(flag, "boolean"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id,
    url). The longest fitting rule decides; else a page is blocked if its host
    or a parent domain of it is in ``listed`` (column key), else allowed. Null
    urls have an empty host and path, are on no list and so allowed. Rows with
    null or repeated page_id each give a row; other columns are not read."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    names = host_names(F.col("host"))
    cascade = build_cascade(parsed.select("host").distinct().select(F.explode(names).alias("key")), listed)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = block_listed(parsed.withColumn("names", names), cascade, "names")
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
