"""Operator 7: quality by importance resampling.

Two generative bag models over hashed words and word pairs, one of the target
texts (labelled good) and one of all raw texts; a document's log importance
weight is the sum of their log ratios over its n-grams. Adding Gumbel noise
and taking the k largest draws k documents without replacement in proportion
to their weights. The k-th largest value is found by counting its bits in
four passes over the narrow table of scores, without sorting it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.llm import text as T
from threatspark.llm.shared import stored

BUCKETS = 1 << 16
MAX_TARGET = 50_000  # labelled rows the target model is fitted on, the first by a hash of doc_id
SEED = 17


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = T.spans(data, offsets)
    h = T.Segments(data, lower=True).hashes(start, end)
    pairs, at = T.grams(h, doc, 2)
    return (np.concatenate([h, pairs]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([doc, doc[at]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = batch.column("good").to_numpy(zero_copy_only=False)
        for i, _, data, offsets in T.pieces(batch.column("text")):
            bucket, doc = _buckets(data, offsets)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[i + doc]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["b", "raw", "target"])


def log_ratios(docs: DataFrame, good_ids: DataFrame, max_target: int = MAX_TARGET) -> np.ndarray:
    """log(p_target / p_raw) by bucket. The raw counts run over all documents,
    the target counts over at most ``max_target`` of the good ones, so their
    ids can be broadcast; what reaches the driver is one row per bucket."""
    good = (good_ids.select("doc_id").dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target)
            .withColumn("good", F.lit(True)))
    marked = docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    t = (marked.mapInArrow(_count, "b long, raw long, target long").groupBy("b")
         .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[t.column("b").to_numpy()] += t.column("raw").to_numpy()
    target[t.column("b").to_numpy()] += t.column("target").to_numpy()
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def importance(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, draw (log weight plus Gumbel noise) and draw_rank, a
    whole number that orders as draw does. The noise follows doc_id, so rows
    with the same id share it; a null or empty text has weight 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            weight = np.zeros(batch.num_rows)
            for i, j, data, offsets in T.pieces(batch.column("text")):
                bucket, doc = _buckets(data, offsets)
                weight[i:j] = np.bincount(doc, weights=ratios[bucket], minlength=j - i)
            keys = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            u = ((T.mix(T.mix(keys + np.uint64(seed)) + np.uint64(seed)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
            draw = weight - np.log(-np.log(u)) + 0.0
            bits = draw.view(np.int64)
            rank = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
            yield pa.RecordBatch.from_arrays([ids, pa.array(weight), pa.array(draw), pa.array(rank)], ["doc_id", "log_weight", "draw", "draw_rank"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, log_weight double, draw double, draw_rank long")


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """Exact k-th largest long value; null if there are fewer than k rows."""
    lo = None
    for shift in (48, 32, 16, 0):
        high = F.shiftright(column, shift)
        own = df if lo is None else df.filter(F.shiftright(column, shift + 16) == lo)
        counts = own.groupBy(high.alias("v")).count().collect()  # at most 65536 rows
        for v, n in sorted(((r["v"], r["count"]) for r in counts), reverse=True):
            if n >= k:
                lo = v
                break
            k -= n
        else:
            return None
    return lo


def resample(docs: DataFrame, labels: DataFrame, keep_share: float | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, draw, selected for every row of ``docs``.

    ``labels``: doc_id, quality (1: a target text). The k selected are the
    rows with the largest draws; k is ``keep_share`` of all rows, by default
    the share of quality 1 among the labelled rows (all rows without labels).
    Rows that tie with the k-th are all selected.
    """
    known = labels.select("doc_id", "quality").dropna()
    ratios = log_ratios(docs, known.filter(F.col("quality") == 1))
    scores = stored(importance(docs, ratios, seed), "importance")
    if keep_share is None:
        n, good = known.agg(F.count("*"), F.count_if(F.col("quality") == 1)).first()
        keep_share = good / n if n else 1.0
    k = round(scores.count() * keep_share)
    at = kth_largest(scores, "draw_rank", k) if k else None
    chosen = F.lit(k > 0) if at is None else F.col("draw_rank") >= at
    return scores.select("doc_id", "log_weight", "draw", chosen.alias("selected"))
