"""Operator 12: ranked lexical search, reversed.

The items are the index and the documents are the stream. An inverted index
from the items' terms to the items is built in tasks, in blocks of bounded
size; where all blocks together are small they are broadcast, and beyond that
workers map them from the shared folder. Every task streams its documents'
term counts through the index and keeps a heap of the best documents of each
item; the heaps, at most ``top`` rows of an item and task, are merged at last.
The documents' texts never move. Two passes over them: one for the counts that
weights need, one for the scores.

A term is a run of ASCII letters and digits and of other characters, A-Z
lower-cased, known by 128 bits of hash. Rows with one item id (null is an id
too) are one item with the terms of all of them. Every document row is ranked
by itself, rows with equal ids too; null ids come last among equal scores.
Items or documents that are null, empty or without a term give no rows, as
empty tables do. Columns other than the ids and texts aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatspark.llm import arrays
from threatspark.llm import text as T
from threatspark.llm.shared import new_folder, stored

TOP = 10
BLOCK_ROWS = 1 << 20        # (term, item) rows of a block of the index, unless one item has more terms
BROADCAST_ROWS = 1 << 21    # rows of all blocks up to which the index is broadcast: 64 MB at most
PASS_ITEMS = 200_000        # items whose heaps a task holds at once
CELLS = 4 << 20             # scores that a task holds at once
_SIEVE = 20                 # bits of the table that drops words no item has


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, hash, second hash, row within) of runs of texts."""
    for first, last, data, offsets in T.pieces(column):
        start, end, doc = T.spans(data, offsets, T.MARKS)
        yield first, last - first, T.Segments(data, lower=True).hashes(start, end), T.Segments(data, lower=True, family=1).hashes(start, end), doc


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        number = batch.column("item").to_numpy()
        for first, _, h1, h2, doc in _terms(batch.column("text")):
            rows = np.unique(np.stack([number[first + doc].astype(np.uint64), h1, h2]), axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["item", "h1", "h2"])


# ------------------------------------------------------------ index

@dataclass
class _Block:
    """Terms in order of their first hash; the items of term k are items[start[k]:start[k + 1]]."""
    h1: np.ndarray
    h2: np.ndarray
    start: np.ndarray
    items: np.ndarray       # places in ``numbers``
    numbers: np.ndarray     # of the items
    weights: np.ndarray | None = None

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the known words, their terms); equal first hashes stand side by side."""
        sieve = np.zeros(1 << _SIEVE, bool)
        shift = np.uint64(64 - _SIEVE)
        sieve[self.h1 >> shift] = True
        where = np.flatnonzero(sieve[h1 >> shift])
        at = np.searchsorted(self.h1, h1[where])
        term = np.full(len(where), -1)
        open_ = at < len(self.h1)
        while open_.any():
            k = np.flatnonzero(open_)
            same = self.h1[at[k]] == h1[where[k]]
            hit = same & (self.h2[at[k]] == h2[where[k]])
            term[k[hit]] = at[k[hit]]
            open_[k[~same | hit]] = False
            at[k] += 1
            open_ &= at < len(self.h1)
        known = term >= 0
        return where[known], term[known]


_ARRAYS = ("h1", "h2", "start", "items", "numbers")


def _write_block(folder: str):
    def run(key, rows):
        item, h1, h2 = (rows.column(n).to_numpy() for n in ("item", "h1", "h2"))
        h1, h2 = h1.astype(np.uint64), h2.astype(np.uint64)
        numbers, place = np.unique(item, return_inverse=True)
        order = np.lexsort((place, h2, h1))
        h1, h2, place = h1[order], h2[order], place[order]
        new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        start = np.append(np.flatnonzero(new), len(h1))
        for name, x in zip(_ARRAYS, (h1[new], h2[new], start, place.astype(np.int32), numbers)):
            arrays.save(f"{folder}/{key[0].as_py()}-{name}.npy", x)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "items": pa.array([len(numbers)], pa.int64())})

    return run


@dataclass(frozen=True)
class Index:
    folder: str
    blocks: tuple[int, ...]
    items: DataFrame            # item number and item_id
    small: bool                 # few enough rows to broadcast

    def load(self, weights: bool) -> dict[int, list[np.ndarray]]:
        names = [*_ARRAYS, *(["weights"] if weights else [])]
        return {k: [arrays.load(f"{self.folder}/{k}-{n}.npy") for n in names] for k in self.blocks}


def build(items: DataFrame, block_rows: int = BLOCK_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> list[Index]:
    """The inverted index of ``items`` (item_id, text), in one part per PASS_ITEMS items."""
    spark = items.sparkSession
    ids = stored(items.select("item_id").distinct().select(F.monotonically_increasing_id().alias("item"), "item_id"), "search-items")
    texts = items.alias("t").join(ids.alias("i"), F.col("t.item_id").eqNullSafe(F.col("i.item_id"))).select("i.item", "t.text")
    rows = stored(texts.mapInArrow(_item_terms, "item long, h1 long, h2 long").distinct(), "search-terms")
    folder, total = new_folder(spark, "search-index"), rows.count()
    blocks = max(1, -(-total // block_rows))
    made = (rows.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"))
            .applyInArrow(_write_block(folder), "block long, items long").collect())  # a row per block
    parts, held = [[]], 0
    for r in sorted(made):
        if held and held + r["items"] > PASS_ITEMS:
            parts.append([])
            held = 0
        parts[-1].append(r["block"])
        held += r["items"]
    return [Index(folder, tuple(p), ids, total <= broadcast_rows) for p in parts if p]


def _source(spark, index: Index, weights: bool) -> Any:
    """How tasks get the blocks: broadcast if they are few and small, else mapped from the folder."""
    if index.small:
        shared = spark.sparkContext.broadcast({k: [np.asarray(x) for x in b] for k, b in index.load(weights).items()})  # plain arrays
        return lambda: {k: _Block(*b) for k, b in shared.value.items()}
    folder, blocks = index.folder, index.blocks
    return lambda: {k: _Block(*b) for k, b in Index(folder, blocks, None, False).load(weights).items()}


# ------------------------------------------------------------ counts

_TOTALS = -1     # the block number of the row that counts documents and terms


def _term_counts(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences), in order of documents."""
    key, n = np.unique(doc.astype(np.uint64) << np.uint64(32) | term.astype(np.uint64), return_counts=True)
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64), n


def _document_counts(source):
    """In how many of the task's documents each term is; documents with terms, and all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = source()
        df = {k: np.zeros(len(b.h1), np.int64) for k, b in blocks.items()}
        docs = terms = 0
        for batch in batches:
            for _, rows, h1, h2, doc in _terms(batch.column("text")):
                docs += int((np.bincount(doc, minlength=rows) > 0).sum())
                terms += len(doc)
                for k, b in blocks.items():
                    where, term = b.find(h1, h2)
                    df[k] += np.bincount(_term_counts(doc[where], term)[1], minlength=len(b.h1))
        for k, n in [*df.items(), (_TOTALS, np.array([docs, terms]))]:
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at), pa.array(n[at])], ["block", "term", "n"])

    return run


def _write_weights(folder: str, docs: int, sizes: dict[int, int]):
    def run(key, rows):
        k = key[0].as_py()
        out = np.zeros(sizes[k], np.int64)
        for term, n in zip(rows.column("term").to_pylist(), rows.column("n").to_pylist()):
            out[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1)))
        arrays.save(f"{folder}/{k}-weights.npy", out)
        return pa.table({"block": pa.array([k], pa.int64())})

    return run


def _weigh(docs: DataFrame, index: Index) -> tuple[int, int]:
    """Writes the terms' weights; returns the numbers of documents and of their terms."""
    spark, folder = docs.sparkSession, index.folder
    counts = stored(docs.select("text").mapInArrow(_document_counts(_source(spark, index, False)), "block long, term long, n long")
                    .groupBy("block", "term").agg(F.sum("n").alias("n")), "search-counts")
    totals = dict(counts.filter(F.col("block") == _TOTALS).select("term", "n").collect())  # two numbers
    n_docs, n_terms = totals.get(0, 0), totals.get(1, 0)
    sizes = {k: len(b[0]) for k, b in index.load(False).items()}
    done = (counts.filter(F.col("block") >= 0).groupBy("block").applyInArrow(_write_weights(folder, n_docs, sizes), "block long").collect())
    for k in set(sizes) - {r["block"] for r in done}:  # no document has any of its terms
        arrays.save(f"{folder}/{k}-weights.npy", np.zeros(sizes[k], np.int64))
    return n_docs, n_terms


# ------------------------------------------------------------ scores

class _Heaps:
    """The best documents of a block's items so far: rows (item, score, null id, id)."""

    def __init__(self, items: int, top: int):
        self.top, self.rows = top, np.zeros((4, 0), np.int64)
        self.least = np.ones(items, np.int64)  # a score below that can't enter

    def add(self, scores: np.ndarray, no_id: np.ndarray, doc_id: np.ndarray) -> None:
        """``scores``: a row per document, a column per item."""
        least = self.least
        if len(scores) > self.top:
            least = np.maximum(least, np.partition(scores, len(scores) - self.top, axis=0)[len(scores) - self.top])
        doc, item = np.nonzero(scores >= least)
        if not len(doc):
            return
        rows = np.concatenate([self.rows, np.stack([item, scores[doc, item], no_id[doc], doc_id[doc]])], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        self.rows = rows[:, place < self.top]
        full = place == self.top - 1
        self.least[rows[0, full]] = rows[1, full]


def _best(source, docs: int, terms: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = source()
        heaps = {k: _Heaps(len(b.numbers), top) for k, b in blocks.items()}
        for batch in batches:
            ids = batch.column("doc_id")
            no_id, doc_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy()
            for first, rows, h1, h2, doc in _terms(batch.column("text")):
                length = np.bincount(doc, minlength=rows)
                # in Python's integers: 90 * n * N may pass 64 bits
                norm = np.array([10 + 90 * n * docs // terms for n in length.tolist()], np.int64) if terms else length
                for k, b in blocks.items():
                    where, term = b.find(h1, h2)
                    at, term, tf = _term_counts(doc[where], term)
                    gain = b.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[at]))
                    many = (b.start[1:] - b.start[:-1])[term]
                    for a, z in _ranges(at, many, len(b.numbers)):
                        low, high = at[a], at[z - 1] + 1
                        to = np.repeat(b.start[:-1][term[a:z]] - np.cumsum(many[a:z]) + many[a:z], many[a:z]) + np.arange(many[a:z].sum())
                        scores = np.zeros((high - low) * len(b.numbers), np.int64)
                        np.add.at(scores, np.repeat(at[a:z] - low, many[a:z]) * len(b.numbers) + b.items[to], np.repeat(gain[a:z], many[a:z]))
                        own = slice(first + low, first + high)
                        heaps[k].add(scores.reshape(high - low, -1), no_id[own], doc_id[own])
        for k, h in heaps.items():
            item, score, null, own = h.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[k].numbers[item]), pa.array(score), pa.array(own, pa.int64(), mask=null > 0)], ["item", "score", "doc_id"])

    return run


def _ranges(at: np.ndarray, many: np.ndarray, items: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of whole documents with a bounded number of scores and of additions."""
    if not len(at):
        return
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    edge, work = np.append(first, len(at)), np.append(0, np.cumsum(many))[np.append(first, len(at))]
    doc = np.append(at[first], at[-1] + 1)
    k = 0
    while k < len(first):
        z = min(int(np.searchsorted(work, work[k] + CELLS, "right")), int(np.searchsorted(doc, doc[k] + max(1, CELLS // items), "right"))) - 1
        z = min(max(z, k + 1), len(first))
        yield edge[k], edge[z]
        k = z


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_rows: int = BLOCK_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Each item's ``top`` documents: item_id, rank (from 1), doc_id, score.
    ``docs``: doc_id (an integer) and text. Equal scores rank by doc_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for index in build(items, block_rows, broadcast_rows):
        n_docs, n_terms = _weigh(docs, index)
        heaps = docs.mapInArrow(_best(_source(spark, index, True), n_docs, n_terms, top), "item long, score long, doc_id long")
        best = heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        out = out.unionByName(best.join(index.items, "item").select("item_id", "rank", "doc_id", "score"))
    return out
