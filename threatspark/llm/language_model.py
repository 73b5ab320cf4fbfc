"""Operator 3: interpolated modified Kneser-Ney n-gram scores.

Counting: every task reduces its documents' n-grams of the highest order to
distinct ones and sends one compressed block per shard, with a dictionary of
the block's words; only these and the plain word counts leave the texts. A
shard's blocks are merged in one task, which writes the order's sorted arrays.
The next lower order is counted from those arrays, once what was shuffled for
them is gone: an n-gram without its first word occurs after as many words as it
has distinct n-grams there. Each order so derives from the one above it, down
to single words. A shard holds whole contexts (the words before the last one),
so that a context's totals are local; it is the context's hash that chooses it,
so a frequent word's longer contexts are spread, and what is sent on for it is
summed beforehand. The number of shards follows the bytes of text.

Scoring: workers map the arrays into memory and look a batch's distinct n-grams
up by binary search; no token is shuffled and no worker holds the model. A word
is known by its 64-bit hash, an n-gram by its words' places in its shard's
dictionary, the nearest word of the context first, so that contexts that begin
alike share that word.

Null and empty texts are one end token. Null and repeated ids keep their rows;
other columns are not read. Long texts are counted and scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatspark.llm import arrays
from threatspark.llm import text as T
from threatspark.llm.shared import new_folder

ORDER = 3
HELD_OUT = (7, 2)            # modulus and remainder of crc32(doc_id)
COUNT_TOKENS = 3_000_000     # tokens that a task reduces at once
MERGE_ROWS = 4_000_000       # rows of blocks that a shard adds up at once
SHARD_BYTES = 32 << 20       # text for which there is a shard
STEP = 64                    # nodes whose starts are stored as distances from the first one's
MANY = 255                   # the largest byte, for counts of so many or more
LONG = 64                    # n-grams from which on a context's totals are stored, not added up when asked for
SCORE_BYTES = 8 << 20        # text that a task scores at once

_BEGIN = np.uint64(0xB0B0B0B0B0B0B0B1)
_END = np.uint64(0xE0E0E0E0E0E0E0E1)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RAW = 0                     # the kind of plain token counts; kinds 1..n are the orders


@dataclass(frozen=True)
class LanguageModel:
    folder: str
    order: int
    shard_bits: int                               # of the highest order, see _bits
    tokens: int                                   # training tokens
    vocabulary: int                               # distinct ones
    discounts: tuple[tuple[float, float, float], ...]  # D1, D2, D3+ by order
    unigrams: tuple[int, int, int, int]           # sum of order-1 counts; how many are 1, 2, more


def _bits(kind: int, bits: int) -> int:
    """Of the shards of an order, whose rows decrease with it: a lookup's cost
    grows with the shards. Up to eight shards all have as many, for as many tasks."""
    return min(bits, max(3, bits - (2 if kind <= 1 else kind == 2)))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 7, is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))


def _tokens(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents' tokens in one row, each document as order - 1 begin
    marks (at least one), its words and an end; where the tokens that count
    (words and ends) stand; and their documents."""
    pad, docs = max(order - 1, 1), len(offsets) - 1
    start, end, doc = T.spans(data, offsets)
    h = T.Segments(data, lower=True).hashes(start, end)
    words = np.bincount(doc, minlength=docs)
    seq = np.full(len(h) + docs * (pad + 1), _BEGIN, np.uint64)
    at = np.arange(len(h)) + doc * (pad + 1) + pad
    ends = np.cumsum(words) + np.arange(docs) * (pad + 1) + pad
    seq[at] = h
    seq[ends] = _END
    where = np.sort(np.concatenate([at, ends]))
    return seq, where, np.repeat(np.arange(docs), words + 1)


def _context(tokens: list[np.ndarray]) -> np.ndarray:
    """Hash of the tokens before each token, the nearest first."""
    out = np.zeros(len(tokens[0]), np.uint64)
    for t in tokens:
        out = T.mix(out + t)
    return out


@dataclass
class _Grams:
    """Rows of tokens (the word, then the tokens before it, nearest first) as
    places in a sorted dictionary, and their counts."""
    words: np.ndarray
    places: list[np.ndarray]
    counts: np.ndarray

    def tokens(self, column: int) -> np.ndarray:
        return self.words[self.places[column]]

    def shards(self, bits: int) -> np.ndarray:
        """By context, or by the word where there is none."""
        if not bits:
            return np.zeros(len(self.counts), np.uint16)
        h = _context([self.tokens(i) for i in range(1, len(self.places))]) if len(self.places) > 1 else self.tokens(0)
        return (h >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)

    def rows(self, which) -> _Grams:
        return _Grams(self.words, [p[which] for p in self.places], self.counts[which])


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's place among them. They
    meet in a hash table, so only the distinct ones are sorted."""
    coded = pa.array(values).dictionary_encode()
    own = coded.dictionary.to_numpy()
    order = np.argsort(own)
    place = np.empty(len(own), np.int32)
    place[order] = np.arange(len(own), dtype=np.int32)
    return own[order], place[coded.indices.to_numpy()]


def _grams(columns: list[np.ndarray]) -> _Grams:
    words, places = _numbered(np.concatenate(columns))
    return _distinct(_Grams(words, np.split(places, len(columns)), np.ones(len(columns[0]), np.int64)))


def _order(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of numbers below ``size``, and where in it a row differs from the one before."""
    bits = max(size - 1, 1).bit_length()
    if bits * len(columns) <= 64:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = key << np.uint64(bits) | c.astype(np.uint64)
        order = np.argsort(key)
        key = key[order]
        return order, np.append(True, key[1:] != key[:-1])
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    return order, new


def _sorted(columns: list[np.ndarray], counts: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of numbers below ``size`` in order, their counts, and where a row
    differs from the one before. Where a row and its count fit into 64 bits
    the numbers themselves are sorted, with nothing to fetch afterwards."""
    bits, low = max(size - 1, 1).bit_length(), int(counts.max() - 1).bit_length()
    if bits * len(columns) + low > 64:
        order, new = _order(columns, size)
        return [c[order] for c in columns], counts[order], new
    key = np.zeros(len(counts), np.uint64)
    for c in columns:
        key = key << np.uint64(bits) | c.astype(np.uint64)
    if low:
        key = key << np.uint64(low) | (counts - 1).astype(np.uint64)
    key.sort()
    counts = (key & np.uint64((1 << low) - 1)).astype(np.int32 if low < 31 else np.int64) + 1
    if low:
        key >>= np.uint64(low)
    mask = np.uint64((1 << bits) - 1)
    out = [(key >> np.uint64(bits * i) & mask).astype(np.int32 if bits < 32 else np.int64) for i in reversed(range(len(columns)))]
    return out, counts, np.append(True, key[1:] != key[:-1])


def _context_first(columns: list[np.ndarray]) -> list[np.ndarray]:
    return [*columns[1:], columns[0]]


def _word_first(columns: list[np.ndarray]) -> list[np.ndarray]:
    return [columns[-1], *columns[:-1]]


def _distinct(g: _Grams) -> _Grams:
    """Each row once, ordered by context and word, with the sum of its counts."""
    if not len(g.counts):
        return g
    columns, counts, new = _sorted(_context_first(g.places), g.counts, len(g.words))
    first = np.flatnonzero(new)
    return _Grams(g.words, [c[first] for c in _word_first(columns)], np.add.reduceat(counts, first, dtype=np.int64))


def _added(parts: list[_Grams]) -> _Grams:
    words = np.sort(np.concatenate([g.words for g in parts]))
    words = words[np.append(True, words[1:] != words[:-1])]
    at = [np.searchsorted(words, g.words).astype(np.int32) for g in parts]
    return _distinct(_Grams(words, [np.concatenate([a[g.places[i]] for a, g in zip(at, parts)]) for i in range(len(parts[0].places))],
                            np.concatenate([g.counts for g in parts])))


def _lower(g: _Grams) -> _Grams:
    """The n-grams without their first token, counted by how many there are."""
    return _distinct(_Grams(g.words, g.places[:-1], np.ones(len(g.counts), np.int32)))


def _used(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers below ``size``, where each one stands among them, and how often they occur."""
    if size > 8 * len(places):
        return np.unique(places, return_inverse=True, return_counts=True)
    n = np.bincount(places, minlength=size)
    return np.flatnonzero(n), (np.cumsum(n > 0) - 1)[places], n[n > 0]


def _planes(column: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that the empty high ones vanish."""
    top = int(column.max()) if len(column) else 0
    return b"".join((column >> 8 * i).astype(np.uint8).tobytes() if top >> 8 * i else bytes(len(column)) for i in range(column.itemsize))


def _lead(columns: int) -> int:
    """The column that a block's rows are sorted by."""
    return min(1, columns - 1)


def _pack(g: _Grams) -> bytes:
    """The words in use, the more frequent before by powers of two so that
    places are small, and in order else; then places and counts, by the first
    word of the context (the word, where there is none). What is in order is
    sent as steps."""
    used, back, n = _used(np.concatenate(g.places), len(g.words))
    order = np.argsort((64 - np.frexp(n.astype(float))[1]).astype(np.uint8), kind="stable")
    rank = np.empty(len(used), np.int32)
    rank[order] = np.arange(len(used), dtype=np.int32)
    ranks = np.split(rank[back], len(g.places))
    ranks, counts, _ = _sorted(_context_first(ranks), g.counts, len(used))
    ranks, lead = _word_first(ranks), _lead(len(ranks))
    ranks[lead] = np.diff(ranks[lead], prepend=0)
    parts = [np.array([len(g.places), len(g.counts), len(used)], "<u8").tobytes(), _planes(np.diff(g.words[used[order]], prepend=np.uint64(0)).astype("<u8"))]
    parts += [_planes(r.astype("<u4")) for r in ranks] + [_planes(counts.astype("<u8"))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob: bytes) -> _Grams:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    columns, n, words = raw[:24].view("<u8").tolist()
    at = 24

    def take(rows: int, kind: str) -> np.ndarray:
        nonlocal at
        size = np.dtype(kind).itemsize
        out = np.ascontiguousarray(raw[at:at + rows * size].reshape(size, rows).T).view(kind).ravel()
        at += rows * size
        return out

    listed = np.cumsum(take(words, "<u8"), dtype=np.uint64)
    order = np.argsort(listed)
    place = np.empty(words, np.int32)
    place[order] = np.arange(words, dtype=np.int32)
    ranks = [take(n, "<u4") for _ in range(columns)]
    ranks[_lead(columns)] = np.cumsum(ranks[_lead(columns)], dtype=np.int64)
    return _Grams(listed[order], [place[r] for r in ranks], take(n, "<u8").astype(np.int64))


_STATS = ["n", "total", "n1", "n2", "n3", "n4", "more"]
_SENT = "kind int, shard int, block binary"
_COUNTED = "kind int, " + ", ".join(f"{x} long" for x in _STATS)


def _sent(kind: int, g: _Grams, bits: int) -> list[tuple]:
    """A block for each shard of the kind."""
    bits = _bits(kind, bits)
    shard = g.shards(bits)
    order = np.argsort(shard, kind="stable")
    edge = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
    return [(kind, s, _pack(g.rows(order[edge[s]:edge[s + 1]]))) for s in np.flatnonzero(np.diff(edge)).tolist()]


def _batches(rows: list[tuple]) -> list[pa.RecordBatch]:
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "shard", "block"]).to_batches()


def _blocks(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            first = np.cumsum([0, *[len(seq) for seq, _ in held[:-1]]])
            where = np.concatenate([w + f for (_, w), f in zip(held, first)])
            words, at = _numbered(np.concatenate([seq for seq, _ in held]))
            held.clear()
            for kind, columns in (_RAW, 1), (order, order):
                yield from _batches(_sent(kind, _distinct(_Grams(words, [at[where - j] for j in range(columns)], np.ones(len(where), np.int32))), bits))

        for batch in batches:
            for _, _, data, offsets in T.pieces(batch.column("text")):
                seq, where, _ = _tokens(data, offsets, order)
                held.append((seq, where))
                n += len(where)
                if n >= COUNT_TOKENS:
                    yield from flush()
                    n = 0
        if n:
            yield from flush()

    return run


def _merge(folder: str):
    """One shard of one order (or of the plain counts): adds its blocks up and writes the arrays."""
    def run(key, rows):
        kind, shard = (x.as_py() for x in key)
        parts, n = [], 0
        for blob in rows.column("block"):
            parts.append(_unpack(blob.as_py()))
            n += len(parts[-1].counts)
            if n >= MERGE_ROWS and len(parts) > 1:
                parts = [_added(parts)]
                n = len(parts[0].counts) // 2  # it shrinks no more if most of it is distinct
        g = _added(parts)
        _write(f"{folder}/{kind}-{shard}", g)
        have = [int((g.counts == c).sum()) for c in (1, 2, 3, 4)]
        return pa.table({"kind": pa.array([kind], pa.int32())} | {
            x: pa.array([v], pa.int64()) for x, v in zip(_STATS, (len(g.counts), int(g.counts.sum()), *have, int((g.counts > 2).sum())))})

    return run


def _lowered(folder: str, level: int, bits: int):
    """What the next lower order counts, from the arrays of this one's shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                have = _stored(f"{folder}/{level}-{shard}")
                if have is not None:
                    yield from _batches(_sent(level - 1, _lower(_read(have, level)), bits))

    return run


def _split_places(name: str, places: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Numbers below ``size`` in three bytes, or four."""
    if size > 1 << 24:
        return {f"{name}-low": places.astype(np.uint32)}
    return {f"{name}-low": places.astype(np.uint16), f"{name}-high": (places >> 16).astype(np.uint8)}


def _places(have: dict[str, np.ndarray], name: str, which) -> np.ndarray:
    low = have[f"{name}-low"][which]
    if low.dtype == np.uint32:
        return low.astype(np.int64)
    return low | have[f"{name}-high"][which].astype(np.int32) << 16


def _write(at: str, g: _Grams) -> None:
    """The file of one shard, whose rows are distinct and ordered by context and
    word: the dictionary and the counts; of longer n-grams the words, and
    their contexts as a tree. A node at depth d is the d words before, known by
    the last of them; where its own nodes (at the end, its words) start is
    stored as distances from every STEPth node's start. The nodes at depth 1
    are four bytes each, as they are searched as they lie. Contexts of many words
    have their totals stored. Counts are a byte each; those of MANY and more
    are listed besides."""
    counts, size = g.counts, len(g.words)
    if len(g.places) == 1:
        out = {"keys": g.tokens(0)}
    else:
        out = {"keys": g.words} | _split_places("words", g.places[0], size)
        new, first = np.zeros(len(counts), bool), []
        new[0] = True
        for d, p in enumerate(g.places[1:], 1):
            new[1:] |= p[1:] != p[:-1]
            first.append(np.flatnonzero(new))
            out |= _split_places(f"{d}", p[first[-1]], size) if d > 1 else {"1-low": p[first[0]].astype(np.uint32)}
        for d, own in enumerate(first):
            start = np.append(own, len(counts)) if d + 1 == len(first) else np.append(np.searchsorted(first[d + 1], own), len(first[d + 1]))
            base = start[::STEP]
            start = start - np.repeat(base, STEP)[:len(start)]
            out |= {f"{d + 1}-base": base, f"{d + 1}-start": start.astype(np.min_scalar_type(int(start.max())))}
        long = np.flatnonzero(np.diff(np.append(first[-1], len(counts))) > LONG)
        out |= {"long": long, "totals": np.stack([np.add.reduceat(x, first[-1])[long] for x in _kinds_of(counts)], axis=1)}
    many = np.flatnonzero(counts >= MANY)
    arrays.save_all(f"{at}.npy", out | {"many": np.stack([many, counts[many]]), "counts": np.minimum(counts, MANY).astype(np.uint8)})


def _read(have: dict[str, np.ndarray], order: int) -> _Grams:
    """The n-grams (of two words or more) that _write stored; counts aside."""
    places = [_places(have, "words", slice(None))]
    node = np.arange(len(places[0]))
    for d in range(order - 1, 0, -1):
        known = _places(have, f"{d}", slice(None))
        start = _start(have, d, np.arange(len(known) + 1))
        node = np.repeat(np.arange(len(known)), np.diff(start))[node]
        places.insert(1, known[node])
    return _Grams(np.asarray(have["keys"]), places, np.ones(len(places[0]), np.int64))


def _kinds_of(counts: np.ndarray) -> list[np.ndarray]:
    counts = counts.astype(np.int64)
    return [counts, *[x.astype(np.int64) for x in (counts == 1, counts == 2, counts > 2)]]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The published estimates; where too few counts exist, half of 1 is taken off."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0
    return tuple(min(max(x, 0.05), top) for x, top in zip(d, (1.0, 2.0, 3.0)))


def train(docs: DataFrame, order: int = ORDER) -> LanguageModel:
    """Counts the texts of ``docs`` (null: empty, which is one end token), with
    a shard for every SHARD_BYTES of them. An empty table gives a model that
    knows nothing. What an order shuffled goes before the next one is counted."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / SHARD_BYTES))))
    folder = new_folder(spark, "ngrams")
    by_kind = {}
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        rows = docs.select("text").mapInArrow(_blocks(order, bits), _SENT)
        for level in range(order, 0, -1):
            counted = rows.groupBy("kind", "shard").applyInArrow(_merge(folder), _COUNTED)
            by_kind |= {r["kind"]: r for r in counted.groupBy("kind").agg(*[F.sum(x).alias(x) for x in _STATS]).collect()}  # a row per order
            shards = 1 << _bits(level, bits)
            rows = spark.range(0, shards, 1, shards).mapInArrow(_lowered(folder, level, bits), _SENT)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    raw, one = by_kind.get(_RAW), by_kind.get(1)
    discounts = tuple(_discounts(*(by_kind[k][x] for x in ("n1", "n2", "n3", "n4"))) if k in by_kind else (0.5, 0.5, 0.5)
                      for k in range(1, order + 1))
    return LanguageModel(folder, order, bits, raw["total"] if raw else 0, raw["n"] if raw else 0, discounts,
                         tuple(one[x] for x in ("total", "n1", "n2", "more")) if one else (0, 0, 0, 0))


def _stored(path: str) -> dict[str, np.ndarray] | None:
    try:
        return arrays.load_all(f"{path}.npy")
    except FileNotFoundError:
        return None  # a shard that got no key


def _by_shard(model: LanguageModel, kind: int, keys: np.ndarray) -> Iterator[tuple[slice, dict[str, np.ndarray]]]:
    """Ranges of sorted keys and the arrays of the shard that may hold them."""
    bits = _bits(kind, model.shard_bits)
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    shards, first = np.unique(shard, return_index=True)
    for s, a, b in zip(shards.tolist(), first, [*first[1:], len(keys)]):
        have = _stored(f"{model.folder}/{kind}-{s}")
        if have is not None:
            yield slice(a, b), have


def _beyond(have: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Counts that are listed, as they are MANY or more."""
    place, counts = have["many"]
    return counts[np.searchsorted(place, at)]


def _counts(have: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    out = have["counts"][at].astype(np.int64)
    more = np.flatnonzero(out == MANY)
    if len(more):
        out[more] = _beyond(have, at[more])
    return out


def _start(have: dict[str, np.ndarray], depth: int, rank: np.ndarray) -> np.ndarray:
    """Where the nodes, or words, below the nodes of these ranks start."""
    return have[f"{depth}-base"][rank // STEP] + have[f"{depth}-start"][rank].astype(np.int64)


def _unigrams(model: LanguageModel, kind: int, words: np.ndarray) -> np.ndarray:
    """Counts of sorted distinct words; 0 where there is none."""
    out = np.zeros(len(words), np.int64)
    for own, have in _by_shard(model, kind, words):
        at, hit = arrays.find(have["keys"], words[own])
        out[own][hit] = _counts(have, at[hit])
    return out


def _search(have: dict[str, np.ndarray], name: str, first: np.ndarray, last: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search for all of them at once: where each stands among the
    places from first up to last, and whether it is there. They go by the
    number of their steps, so that those with steps left lie side by side."""
    n = last - first
    steps = np.frexp(np.maximum(n, 1) - 1)[1].astype(np.uint8)
    order = np.argsort(steps, kind="stable")
    low, size, want = np.where(n > 0, first, 0)[order], n[order], wanted[order]
    edge = len(order) - np.cumsum(np.bincount(steps)[::-1])[::-1]
    for e in edge[:0:-1].tolist():
        half = size[e:] >> 1
        low[e:] += half * (_places(have, name, low[e:] + half) <= want[e:])
        size[e:] -= half
    at, hit = np.empty_like(low), np.empty(len(n), bool)
    at[order] = low
    hit[order] = (_places(have, name, low) == want) & (size > 0)
    return at, hit


def _ngrams(model: LanguageModel, kind: int, words: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of distinct n-grams, their contexts' totals, and each one's
    context. They are given as places in ``words`` (the word, then the ones
    before it, nearest first), ordered by context and word."""
    n, bits = len(columns[0]), _bits(kind, model.shard_bits)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns[1:]:
        new[1:] |= c[1:] != c[:-1]
    back, contexts = np.cumsum(new, dtype=np.int32) - 1, [c[new] for c in columns[1:]]
    count, totals = np.zeros(n, np.int64), np.zeros((len(contexts[0]), 4), np.int64)
    shard = np.zeros(len(totals), np.uint16)
    if bits:
        shard = (_context([words[c] for c in contexts]) >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)
    rows, heads = shard[back], np.argsort(shard, kind="stable")
    by_shard = np.argsort(rows, kind="stable")
    shards, edge = np.unique(rows[by_shard], return_index=True)
    tops = np.searchsorted(shard[heads], shards)
    place, used = np.empty(len(words), np.int32), np.zeros(len(words), bool)
    for s, a, b, top, end in zip(shards.tolist(), edge, [*edge[1:], n], tops, [*tops[1:], len(heads)]):
        have, own, head = _stored(f"{model.folder}/{kind}-{s}"), by_shard[a:b], heads[top:end]
        if have is None:
            continue
        word, before, to = columns[0][own], [c[head] for c in contexts], np.cumsum(new[own]) - 1
        used[:] = False
        for c in (word, *before):
            used[c] = True
        known = np.flatnonzero(used)
        at, hit = arrays.find(have["keys"], words[known])
        place[known] = np.where(hit, at, -1)
        node, there = arrays.find(have["1-low"], place[before[0]].astype(np.uint32))
        for d in range(1, kind):
            if d > 1:
                node, hit = _search(have, f"{d}", first, last, place[before[d - 1]])
                there &= hit
            node[~there] = 0
            first, last = _start(have, d, node), _start(have, d, node + 1)
            last[~there] = first[~there]
        totals[head[there]] = _totals(have, node[there], first[there], last[there])
        at, hit = _search(have, "words", first[to], last[to], place[word])
        count[own[hit]] = _counts(have, at[hit])
    return count, totals, back


#: By a count's byte: the count, and whether it is 1, 2 or more, side by side (each takes what LONG counts add up to).
_PACKED = np.array([b | (b == 1) << 20 | (b == 2) << 34 | (b > 2) << 48 for b in range(256)], np.int64)


def _totals(have: dict[str, np.ndarray], rank: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum and numbers of ones, twos and more of some contexts: added up, or stored for long ones."""
    out = np.zeros((len(rank), 4), np.int64)
    n = last - first
    short = np.flatnonzero(n <= LONG)
    if len(short):
        n, edge = n[short], np.cumsum(n[short]) - n[short]
        at = np.repeat(first[short] - edge, n) + np.arange(n.sum())
        stored = have["counts"][at]
        sums = np.add.reduceat(_PACKED[stored], edge)
        for i, (shift, bits) in enumerate(((0, 20), (20, 14), (34, 14), (48, 14))):
            out[short, i] = sums >> shift & (1 << bits) - 1
        more = np.flatnonzero(stored == MANY)
        if len(more):
            np.add.at(out[:, 0], short[np.searchsorted(edge, more, "right") - 1], _beyond(have, at[more]) - MANY)
    long = np.flatnonzero(last - first > LONG)
    if len(long):
        out[long] = have["totals"][np.searchsorted(have["long"], rank[long])]
    return out


def _score(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    docs = len(offsets) - 1
    seq, where, doc = _tokens(data, offsets, model.order)
    words, at = _numbered(seq)
    del seq
    back = at[where]
    raw = _unigrams(model, _RAW, words)
    base = np.log10((raw + 1) / (model.tokens + model.vocabulary + 1))
    known = raw > 0

    def part(count, discount):
        return np.maximum(count - np.array([0.0, *discount])[np.minimum(count, 3)], 0.0)

    total, n1, n2, more = model.unigrams
    d = model.discounts[0]
    p = np.full(len(words), 1 / (model.vocabulary + 1))
    if total:
        c = _unigrams(model, 1, words)
        p = (part(c, d) + (d[0] * n1 + d[1] * n2 + d[2] * more) * p) / total
    p = p[back]
    for k in range(2, model.order + 1):
        d = model.discounts[k - 1]
        columns = [at[where - j] for j in range(k)]
        order, new = _order(_context_first(columns), len(words))
        to = np.empty(len(order), np.int32)
        to[order] = np.cumsum(new, dtype=np.int32) - 1
        first = order[new]
        columns = [x[first] for x in columns]
        del order, new, first
        c, t, context = _ngrams(model, k, words, columns)
        size = np.maximum(t[:, 0], 1)
        rest = np.where(t[:, 0] > 0, (t[:, 1:] @ np.array(d)) / size, 1.0)
        p = (part(c, d) / size[context])[to] + rest[context[to]] * p
    return [np.bincount(doc, minlength=docs), np.bincount(doc, weights=known[back], minlength=docs).astype(np.int64),
            np.bincount(doc, weights=base[back], minlength=docs), np.bincount(doc, weights=np.log10(p), minlength=docs)]


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity
    for every row. Scores are log10 probabilities of the whole text, its end
    included. A null or empty text is its end alone; null or repeated ids keep
    their rows; other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.pieces(batch.column("text"), SCORE_BYTES):
                n, known, base, full = _score(model, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n), pa.array(known),
                     pa.array(np.full(j - i, model.tokens, np.int64)), pa.array(base), pa.array(full), pa.array(10 ** np.minimum(-full / n, 300))],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def score_held_out(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Trains on the rows that are not held out, scores all, adds held_out."""
    d = docs.select("doc_id", "text")
    model = train(d.filter(~held_out(F.col("doc_id"))), order)
    return score(d, model).withColumn("held_out", held_out(F.col("doc_id")))
