"""Operator 8: substring dedup by prefix-partitioned suffix trees.

Wanted: all windows of 35 words whose words also start elsewhere. Of the
suffixes (one starts at every word) only those at anchors are needed: in each
window, the 12 words with the least hash. Equal windows have their anchor at
the same place, so each window is an anchor's suffix together with the words
just before it, and about one suffix in twelve remains.

The anchor's 12 words are the prefix that partitions the suffixes. Prefixes
that occur once are discarded; their suffixes can't repeat. The others' texts
(at most 58 words) are collapsed to distinct ones, so a passage that a third
of all documents share is a handful of suffixes. In each group the suffixes
are sorted and their longest common prefixes taken, which is the suffix tree:
the nodes deeper than 35 - o words, split by the o words to the left, hold the
repeats whose anchor is o words into the window. A prefix with too many
different suffixes for one task is lengthened to the whole window.

Repeated prefixes and the trees' verdicts are written to the shared folder as
sorted arrays, which workers map into memory while they read the texts again;
no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from threatspark.llm import arrays
from threatspark.llm import text as T
from threatspark.llm.shared import new_folder, stored

WINDOW = 35
PREFIX = 12
REACH = WINDOW - PREFIX          # an anchor is at most so many words into its window
GROUP = 20_000                   # distinct suffixes of one tree
HELD = 1_000_000                 # prefixes that a task reduces at once
SLICE = 4 << 20

_STEP = 0x9E3779B97F4A7C15 | 1


class _Anchors:
    """The anchors of a run of documents; each stands for the windows that
    begin ``low`` to ``high`` words before it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.start, self.end, self.doc = T.spans(data, offsets)
        self.hash = T.Segments(data).hashes(self.start, self.end)
        n, width = len(self.hash), REACH + 1
        g = np.full(n, ~np.uint64(0))
        grams, at = T.grams(self.hash, self.doc, PREFIX)
        g[at] = grams
        least, size = np.arange(n, dtype=np.int64), 1  # place of the least prefix hash among the next `size`, the first of equals
        have = {1: least}
        while 2 * size <= width:
            other = have[size][size:]
            have[2 * size] = np.where(g[have[size][:len(other)]] <= g[other], have[size][:len(other)], other)
            size *= 2
        out, done = have[size], size
        for part in sorted(have, reverse=True):
            if done + part <= width:
                other = have[part][done:]
                out = np.where(g[out[:len(other)]] <= g[other], out[:len(other)], other)
                done += part
        windows = np.flatnonzero(self.doc[:n - WINDOW + 1] == self.doc[WINDOW - 1:]) if n >= WINDOW else np.zeros(0, np.int64)
        owner = out[windows] if len(windows) else np.zeros(0, np.int64)
        # Windows of one anchor follow each other.
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(owner)) - 1 if len(first) else first
        self.at = owner[first]
        self.high, self.low = self.at - windows[first], self.at - windows[last]
        self.prefix = g[self.at]

    def only(self, keep: np.ndarray) -> None:
        self.at, self.high, self.low, self.prefix = self.at[keep], self.high[keep], self.low[keep], self.prefix[keep]

    def texts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last word of every anchor's text, and its 128-bit name."""
        a, b = self.at - self.high, self.at + WINDOW - self.low
        names = []
        for h in (self.hash, T.mix(self.hash + np.uint64(5))):
            power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(h), _STEP, np.uint64)]))
            back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(h), pow(_STEP, -1, 1 << 64), np.uint64)]))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1], dtype=np.uint64)])
            names.append(T.mix((sums[b] - sums[a]) * back[a] + (self.high * 64 + self.low).astype(np.uint64)))
        return a, b, *names


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _prefix_blocks(bits: int):
    """Per task and shard: its distinct prefixes, those seen once first."""
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, count = np.unique(np.concatenate(held), return_counts=True)
        at = np.searchsorted(_shard(keys, bits), np.arange((1 << bits) + 1))
        rows = []
        for s, (a, b) in enumerate(zip(at[:-1], at[1:])):
            if b > a:
                one, more = keys[a:b][count[a:b] == 1], keys[a:b][count[a:b] > 1]
                planes = [np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(len(x), 8).T.tobytes() for x in (one, more)]
                rows.append((s, len(one), len(more), zstandard.ZstdCompressor(level=1).compress(b"".join(planes))))
        s, one, more, blob = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(one, pa.int64()), pa.array(more, pa.int64()), pa.array(blob, pa.binary())],
                                          ["shard", "one", "more", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, data, offsets in T.pieces(batch.column("text"), SLICE):
                held.append(_Anchors(data, offsets).prefix)
                n += len(held[-1])
                if n >= HELD:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)
    return run


def _write_prefixes(folder: str):
    def run(key, rows):
        shard, parts = key[0].as_py(), []
        for one, more, blob in zip(*(rows.column(c).to_pylist() for c in ("one", "more", "block"))):
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
            for n, part, times in ((one, raw[:8 * one], 1), (more, raw[8 * one:], 2)):
                parts += [np.cumsum(np.ascontiguousarray(part.reshape(8, n).T).view("<u8").ravel(), dtype=np.uint64)] * times
        keys, count = np.unique(np.concatenate(parts), return_counts=True)
        arrays.save(f"{folder}/prefix-{shard}.npy", keys[count > 1])
        return pa.table({"n": pa.array([int((count > 1).sum())], pa.int64())})
    return run


def _array(path: str) -> np.ndarray | None:
    try:
        return arrays.load(path)
    except FileNotFoundError:
        return None  # a shard that got no key


def _place(folder: str, name: str, bits: int, keys: np.ndarray) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
    """By shard: which of ``keys`` are in its array ``name``, its path, and where they stand."""
    order = np.argsort(keys)
    shard = _shard(keys[order], bits)
    shards, first = np.unique(shard, return_index=True)
    for s, a, b in zip(shards.tolist(), first, [*first[1:], len(keys)]):
        held = _array(f"{folder}/{name}-{s}.npy")
        if held is not None:
            at, hit = arrays.find(held, keys[order[a:b]])
            yield order[a:b][hit], f"{folder}/{{}}-{s}.npy", at[hit]


def _live(folder: str, bits: int, data: np.ndarray, offsets: np.ndarray) -> _Anchors:
    anchors = _Anchors(data, offsets)
    keep = np.zeros(len(anchors.at), bool)
    for own, _, _ in _place(folder, "prefix", bits, anchors.prefix):
        keep[own] = True
    anchors.only(keep)
    return anchors


_SUFFIX = "prefix long, c1 long, c2 long, low int, high int, times long, words binary"


def _suffixes(folder: str, bits: int):
    """Distinct texts around anchors whose prefix repeats, with how often each occurs in the slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in T.pieces(batch.column("text"), SLICE):
                x = _live(folder, bits, data, offsets)
                if not len(x.at):
                    continue
                a, b, c1, c2 = x.texts()
                _, first, times = np.unique(c1, return_index=True, return_counts=True)
                raw = data.tobytes()
                words = [raw[s:e] for s, e in zip(x.start[a[first]].tolist(), x.end[b[first] - 1].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(v[first].view(np.int64)) for v in (x.prefix, c1, c2)], pa.array(x.low[first].astype(np.int32)),
                     pa.array(x.high[first].astype(np.int32)), pa.array(times), pa.array(words, pa.binary())],
                    ["prefix", "c1", "c2", "low", "high", "times", "words"])
    return run


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of every suffix from its anchor on, and of the words before
    it going left (0 beyond its text), with low and high."""
    low, high = (rows.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
    data, offsets = T.buffers(rows.column("words").combine_chunks())
    start, end, doc = T.spans(data, offsets)
    h = T.Segments(data).hashes(start, end)
    first = np.searchsorted(doc, np.arange(len(low)))
    anchor = first + high
    h = np.append(h, np.uint64(0))
    right, left = np.zeros((len(low), WINDOW), np.uint64), np.zeros((len(low), REACH), np.uint64)
    for j in range(WINDOW):
        right[:, j] = np.where(j < WINDOW - low, h[np.minimum(anchor + j, len(h) - 1)], 0)
    for j in range(REACH):
        left[:, j] = np.where(j < high, h[np.maximum(anchor - 1 - j, 0)], 0)
    return right, left, low, high


def _tree(rows: pa.Table) -> np.ndarray:
    """For every suffix, a bit for each offset o (words from a window's start
    to the anchor) whose window occurs more than once."""
    right, left, low, high = _matrix(rows)
    prefix, times = rows.column("prefix").to_numpy(), rows.column("times").to_numpy()
    order = np.lexsort([right[:, j] for j in range(WINDOW - 1, -1, -1)] + [prefix])
    right, left, low, high, prefix, times = right[order], left[order], low[order], high[order], prefix[order], times[order]
    same = np.zeros(right.shape, bool)  # equal words of neighbours in suffix order
    same[1:] = (right[1:] == right[:-1]) & (prefix[1:] == prefix[:-1])[:, None]
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    bits, before = np.zeros(len(low), np.int64), np.zeros(len(low), np.uint64)
    for o in range(REACH + 1):
        if o:
            before = T.mix(before + left[:, o - 1])
        node = np.cumsum(common < WINDOW - o)  # nodes at least that deep
        own = np.flatnonzero((low <= o) & (o <= high))
        again = T.repeated(T.mix(node[own].astype(np.uint64)) ^ before[own]) | (times[own] > 1)
        bits[own[again]] |= 1 << o
    out = np.empty(len(low), np.int64)
    out[order] = bits
    return out


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by prefix; several whole groups make one sort."""
    def verdicts(rows: pa.Table) -> pa.RecordBatch:
        bits = _tree(rows)
        keep = pa.array(bits != 0)
        return pa.RecordBatch.from_arrays([rows.column("c1").combine_chunks().filter(keep), rows.column("c2").combine_chunks().filter(keep),
                                           pa.array(bits[bits != 0])], ["c1", "c2", "bits"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP // 2):
            part = batch.slice(at, GROUP // 2)
            prefix = part.column("prefix").to_numpy()
            whole = int(np.searchsorted(prefix, prefix[-1]))  # before the last group, which may go on
            rows = sum(x.num_rows for x in held)
            if held and held[-1].column("prefix")[-1].as_py() != prefix[0]:
                whole = max(whole, 0)
            if rows + whole and (whole or held[-1].column("prefix")[-1].as_py() != prefix[0]):
                yield verdicts(pa.Table.from_batches([*held, part.slice(0, whole)]))
                held = []
            held.append(part.slice(whole))
    if held:
        yield verdicts(pa.Table.from_batches(held))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each suffix by all its whole windows, for prefixes with too many suffixes."""
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP):
            rows = pa.Table.from_batches([batch.slice(at, GROUP)])
            right, left, low, high = _matrix(rows)
            before = np.zeros(len(low), np.uint64)
            after = [np.zeros(len(low), np.uint64)]
            for j in range(WINDOW):
                after.append(T.mix(after[-1] + right[:, j]))
            for o in range(REACH + 1):
                if o:
                    before = T.mix(before + left[:, o - 1])
                own = np.flatnonzero((low <= o) & (o <= high))
                w = [T.mix(before[own] + np.uint64(o * k)) ^ T.mix(after[WINDOW - o][own] + np.uint64(k)) for k in (1, 2)]
                own = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x.view(np.int64)) for x in w], *[rows.column(c).combine_chunks().take(own) for c in ("c1", "c2", "times")],
                     pa.array(np.full(len(own), 1 << o, np.int64))], ["w1", "w2", "c1", "c2", "times", "bit"])


def _write_verdicts(folder: str):
    def run(key, rows):
        c1, c2, bits = (rows.column(c).to_numpy() for c in ("c1", "c2", "bits"))
        order = np.argsort(c1.view(np.uint64))
        for name, values in (("c1", c1.view(np.uint64)), ("c2", c2.view(np.uint64)), ("bits", bits)):
            arrays.save(f"{folder}/{name}-{key[0].as_py()}.npy", values[order])
        return pa.table({"n": pa.array([len(c1)], pa.int64())})
    return run


def find_repeats(docs: DataFrame) -> tuple[str, int]:
    """Finds all repeated windows of ``docs``; returns the folder with the
    verdicts and the number of bits of a shard's number."""
    spark = docs.sparkSession
    bits = max(0, math.ceil(math.log2(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    folder = new_folder(spark, "repeats")
    texts = docs.select("text")
    (texts.mapInArrow(_prefix_blocks(bits), "shard int, one long, more long, block binary")
     .groupBy("shard").applyInArrow(_write_prefixes(folder), "n long").agg(F.sum("n")).collect())
    suffixes = stored(texts.mapInArrow(_suffixes(folder, bits), _SUFFIX).groupBy("c1", "c2").agg(
        F.first("prefix").alias("prefix"), F.first("low").alias("low"), F.first("high").alias("high"),
        F.sum("times").alias("times"), F.first("words").alias("words")), "suffixes")
    big = stored(suffixes.groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("prefix"), "large-prefixes")
    usual, large = suffixes.join(big, "prefix", "left_anti"), suffixes.join(big, "prefix", "left_semi")
    if big.isEmpty():
        usual, large = suffixes, suffixes.limit(0)
    verdicts = usual.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_trees, "c1 long, c2 long, bits long")
    by_window = large.mapInArrow(_windows, "w1 long, w2 long, c1 long, c2 long, times long, bit long")
    again = by_window.groupBy("w1", "w2").agg(F.sum("times").alias("all")).filter(F.col("all") > 1).select("w1", "w2")
    late = by_window.join(again, ["w1", "w2"]).groupBy("c1", "c2").agg(F.bit_or("bit").alias("bits"))
    shard = F.shiftrightunsigned("c1", 64 - bits) if bits else F.lit(0).cast("long")
    (verdicts.unionByName(late).groupBy(shard.alias("shard")).applyInArrow(_write_verdicts(folder), "n long").agg(F.sum("n")).collect())
    return folder, bits


def _removed(folder: str, bits: int, data: np.ndarray, offsets: np.ndarray) -> tuple[_Anchors, np.ndarray]:
    """The words, and which of them a repeated window covers."""
    x = _live(folder, bits, data, offsets)
    cover = np.zeros(len(x.hash) + 1, np.int64)
    if len(x.at):
        _, _, c1, c2 = x.texts()
        offsets_of = np.zeros(len(x.at), np.int64)
        for own, path, at in _place(folder, "c1", bits, c1):
            same = _array(path.format("c2"))[at] == c2[own]
            offsets_of[own[same]] = _array(path.format("bits"))[at[same]]
        for o in range(REACH + 1):
            start = x.at[(offsets_of >> o) & 1 == 1] - o
            cover[start] += 1
            cover[start + WINDOW] -= 1
    return x, np.cumsum(cover[:-1]) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with text replaced by the words that no
    repeated window covers, joined by one blank, and two more columns:
    n_words, n_removed.

    A window is 35 consecutive words (runs of bytes other than blank and
    0x09-0x0D, unchanged) of one row; it is repeated if the same words also
    start anywhere else, the same row included. All windows are judged on the
    input. Null or empty texts have no words and become empty; rows with null
    or repeated doc_id count like any others, so equal long rows remove each
    other.
    """
    folder, bits = find_repeats(docs)
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    docs = docs.select(*columns)
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.pieces(batch.column("text"), SLICE):
                x, gone = _removed(folder, bits, data, offsets)
                n = np.bincount(x.doc, minlength=j - i)
                lost = np.bincount(x.doc[gone], minlength=j - i)
                ends = np.cumsum(n)
                raw, kept = data.tobytes(), []
                start, end = x.start.tolist(), x.end.tolist()
                for k, last in enumerate(ends.tolist()):
                    own = range(last - int(n[k]), last)
                    kept.append(b" ".join([raw[start[w]:end[w]] for w in own if not gone[w]] if lost[k] else [raw[start[w]:end[w]] for w in own]))
                cols = [c.slice(i, j - i) for c in batch.columns]
                cols[at] = pa.array(kept, pa.binary()).cast(batch.column(at).type)
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n), pa.array(lost)], [*columns, "n_words", "n_removed"])

    out = StructType(list(docs.schema.fields)).add("n_words", "long").add("n_removed", "long")
    return docs.mapInArrow(run, out)
