"""Operator 4: benchmark decontamination by CGK embedding and bit sampling.

A text's words are embedded by a random walk: at step j the walk writes the
word under it and then moves on or stays, as bit j of that word's hash says.
Two word sequences at a small edit distance fall into step again after an
edit with fair probability, so their walks write the same word at most steps:
edit distance becomes Hamming distance. A repeat samples a few steps; windows
of the texts whose sampled words equal those of a benchmark passage are its
candidates. Several independent repeats, half of them walking backwards, reach
the target recall. Each candidate is then settled by its exact edit distance.

Passages are whole items, or all 16-word stretches (every fourth word) of a
longer item. Items of fewer than MIN_WORDS words are looked for exactly, as a
sequence of ASCII words and single other characters: in a script without
blanks an item is one or two words, inside a longer run of such characters.
The benchmark is handled in parts of bounded size, one pass over
the texts for each, so what a task holds does not grow with the benchmark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.llm import text as T

PASSAGE_WORDS = 16
STRIDE = 4
MIN_WORDS = 5         # shorter items are looked for without edits,
MIN_CHARS = 16        # if they have as many letters and digits
EDIT_SHARE = 0.2      # word edits allowed, as a share of a passage's words
REPEATS = 8           # in each direction
STEPS = 14            # steps of a walk that are sampled from
SAMPLES = 5           # steps sampled by a repeat
PART_BYTES = 1 << 20  # benchmark text handled in one pass
ANCHOR = 4            # tokens of a short item that are looked up at once
_TABLE = 16           # bits of the tables that pre-filter sampled words


@dataclass(frozen=True)
class _Repeat:
    salt: int
    shift: int                   # this repeat's walk uses the bits from here on
    steps: tuple[int, ...]       # sampled steps
    backward: bool
    filters: list[np.ndarray]    # by sample: which hash prefixes some passage has
    hashes: np.ndarray           # sorted hashes of all samples
    passages: np.ndarray         # and the passages they belong to


@dataclass(frozen=True)
class _Short:
    """Items of few words; their tokens are those of _fine()."""
    item: np.ndarray      # item number
    words: np.ndarray
    start: np.ndarray     # first token in ``tokens``
    size: np.ndarray
    tokens: np.ndarray
    anchors: list[tuple[int, np.ndarray, np.ndarray]]  # tokens of an anchor, sorted hashes, places in ``item``


@dataclass(frozen=True)
class _Index:
    items: pa.Array
    item: np.ndarray      # item number by passage
    size: np.ndarray      # words by passage
    words: np.ndarray     # hashes, one row per passage, padded with 0
    repeats: list[_Repeat]
    short: _Short


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bare words (letters and digits, A-Z lower-cased), and their documents."""
    start, end, doc = T.spans(data, offsets, T.MARKS)
    return T.Segments(data, lower=True).hashes(start, end), doc


def _fine(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ASCII letters and digits and of all single other
    characters, their documents, first bytes and lengths in characters."""
    start, end, _ = T.spans(data, offsets, T.MARKS | (np.arange(256) >= 128))
    other = np.flatnonzero(data >= 0xC0)
    stops = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    ends = np.concatenate([end, stops[np.searchsorted(stops, other, "right")]])
    size = np.concatenate([end - start, np.ones(len(other), np.int64)])
    start = np.concatenate([start, other])
    order = np.argsort(start)
    start, ends, size = start[order], ends[order], size[order]
    return T.Segments(data, lower=True).hashes(start, ends), np.searchsorted(offsets, start, "right") - 1, start, size


def _short_items(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> _Short:
    """The items of few words that are long enough; words: how many each has."""
    h, doc, _, size = _fine(data, offsets)
    tokens, chars = np.bincount(doc, minlength=len(words)), np.bincount(doc, weights=size, minlength=len(words))
    item = np.flatnonzero((words < MIN_WORDS) & (chars >= MIN_CHARS))
    start, size = (np.cumsum(tokens) - tokens)[item], tokens[item]
    anchors = []
    for n in np.unique(np.minimum(size, ANCHOR)).tolist():
        own = np.flatnonzero(np.minimum(size, ANCHOR) == n)
        key, at = T.grams(h, doc, n)
        key = key[np.searchsorted(at, start[own])]
        order = np.argsort(key, kind="stable")
        anchors.append((n, key[order], own[order]))
    return _Short(item, words[item], start, size, h, anchors)


def _exact(short: _Short, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of a short item in ``short`` and the byte where a document holds it, for every occurrence."""
    h, doc, start, _ = _fine(data, offsets)
    ends = np.searchsorted(doc, np.arange(len(offsets)))
    items, places = [], []
    for n, hashes, own in short.anchors:
        key, at = T.grams(h, doc, n)
        lo, hi = np.searchsorted(hashes, key, "left"), np.searchsorted(hashes, key, "right")
        hit = np.flatnonzero(hi > lo)
        lo, count = lo[hit], (hi - lo)[hit]
        at = np.repeat(at[hit], count)
        item = own[np.repeat(lo - np.cumsum(count) + count, count) + np.arange(len(at))]
        inside = at + short.size[item] <= ends[doc[at] + 1]
        at, item = at[inside], item[inside]
        k = 0
        while len(item) and k < short.size[item].max():
            last = short.size[item] - 1
            same = h[at + np.minimum(k, last)] == short.tokens[short.start[item] + np.minimum(k, last)]
            at, item, k = at[same], item[same], k + 1
        items.append(item), places.append(start[at])
    return np.concatenate(items), np.concatenate(places)


def _walk(bits: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """Takes steps ``first`` to ``last`` (bits of each word's hash) from the places ``at``."""
    for j in range(first, last):
        at = at + ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(at.dtype)
    return at


def _prefix(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - _TABLE)).astype(np.int32)


def _build(items: pa.Table, repeats: int) -> _Index:
    """Index of a bounded part of the benchmark."""
    data, offsets = T.buffers(items.column("text"))
    h, doc = _words(data, offsets)
    ends = np.searchsorted(doc, np.arange(len(offsets)))
    starts, sizes, owner = [], [], []
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        n = int(b - a)
        if n < MIN_WORDS:
            continue
        size = min(n, PASSAGE_WORDS)
        for at in sorted({*range(0, n - size + 1, STRIDE), n - size}):
            starts.append(a + at), sizes.append(size), owner.append(i)
    starts, size = np.array(starts, np.int64), np.array(sizes, np.int64)
    words = np.zeros((len(starts), PASSAGE_WORDS), np.uint64)
    for j in range(PASSAGE_WORDS):
        own = size > j
        words[own, j] = h[starts[own] + j]
    out = []
    rng = np.random.default_rng(4)
    for r in range(2 * repeats):
        backward = r >= repeats
        if r % repeats % (64 // STEPS) == 0:  # one hash serves several walks
            salt = int(rng.integers(1 << 62))
        shift = r % repeats % (64 // STEPS) * STEPS
        for group in np.unique(np.minimum(size, STEPS)).tolist():  # short items have a walk of their own length
            own = np.flatnonzero(np.minimum(size, STEPS) == group)
            n = min(SAMPLES, group)  # one step from each of n equal stretches of the walk
            steps = tuple(int(rng.integers(i * group // n, (i + 1) * group // n)) for i in range(n))
            # A passage's walk never passes its end: it has as many words as the walk has steps.
            seq = words[own]
            if backward:
                seq = np.stack([np.where(size[own] > j, words[own, np.maximum(size[own] - 1 - j, 0)], 0) for j in range(PASSAGE_WORDS)], axis=1)
            flat = np.concatenate([seq.ravel(), np.zeros(1, np.uint64)])
            bits, at, key, done, filters = T.mix(flat + np.uint64(salt)), np.arange(len(own)) * PASSAGE_WORDS, np.zeros(len(own), np.uint64), 0, []
            for step in steps:
                at, done = _walk(bits, at, shift + done, shift + step), step
                key = T.mix(key + flat[at])
                table = np.zeros(1 << _TABLE, bool)
                table[_prefix(key)] = True
                filters.append(table)
            order = np.argsort(key, kind="stable")
            out.append(_Repeat(salt, shift, steps, backward, filters, key[order], own[order]))
    return _Index(items.column("item_id").combine_chunks(), np.array(owner, np.int64), size, words, out, _short_items(data, offsets, np.diff(ends)))


def _candidates(index: _Index, w: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (passage, first word) that some repeat finds; head: the first
    word of every word's document. A window is in the document of the word
    that its walk starts from, so a backward one may have to be cut there: the
    document's passage can be shorter than the item's."""
    found = []
    salt = None
    sides = {}
    for side, seq in ((False, w), (True, w[::-1])):
        seq = np.concatenate([seq, np.zeros(STEPS + 1, np.uint64)])
        first = T.mix(seq)
        sides[side] = seq, first, _prefix(first)
    every = np.arange(len(w), dtype=np.int32)
    for r in index.repeats:
        seq, first, prefix = sides[r.backward]
        if salt != (r.salt, r.backward):
            salt, bits = (r.salt, r.backward), T.mix(seq + np.uint64(r.salt))
        at, done = _walk(bits, every, r.shift, r.shift + r.steps[0]), r.steps[0]
        start = np.flatnonzero(r.filters[0][prefix][at]).astype(np.int32)
        at = at[start]
        key = first[at]
        for step, table in zip(r.steps[1:], r.filters[1:]):
            at, done = _walk(bits, at, r.shift + done, r.shift + step), step
            key = T.mix(key + seq[at])
            hit = table[_prefix(key)]
            start, at, key = start[hit], at[hit], key[hit]
        lo, hi = np.searchsorted(r.hashes, key, "left"), np.searchsorted(r.hashes, key, "right")
        count = hi - lo
        own = np.repeat(np.arange(len(key)), count)
        passage = r.passages[np.repeat(lo, count) + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)]
        begin = start[own].astype(np.int64)
        if r.backward:
            last = len(w) - 1 - begin
            begin = np.maximum(last + 1 - index.size[passage], head[last])
        found.append(passage * len(w) + begin)
    both = np.unique(np.concatenate(found))
    return both // len(w), both % len(w)


def _distances(index: _Index, w: np.ndarray, first: np.ndarray, last: np.ndarray, passage: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Smallest word edit distance of each passage to a stretch near its
    window; first and last: bounds of the window's document."""
    out = np.empty(len(passage), np.int64)
    reach = int(EDIT_SHARE * PASSAGE_WORDS) + 1
    width = PASSAGE_WORDS + 4 * reach
    for i in range(0, len(passage), 20_000):
        p, lo = passage[i:i + 20_000], begin[i:i + 20_000] - 2 * reach
        cols = lo[:, None] + np.arange(width)
        inside = (cols >= first[i:i + 20_000, None]) & (cols < last[i:i + 20_000, None])
        text = np.where(inside, w[np.clip(cols, 0, len(w) - 1)], np.uint64(0))
        row, best = np.zeros((len(p), width + 1), np.int32), np.zeros(len(p), np.int32)
        step = np.arange(width + 1, dtype=np.int32)
        for k in range(PASSAGE_WORDS):
            new = row + 1
            new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (text != index.words[p, k][:, None]))
            new = np.minimum.accumulate(new - step, axis=1) + step
            row = new
            at_end = index.size[p] == k + 1
            best[at_end] = new[at_end].min(axis=1)
        out[i:i + 20_000] = best
    return out


def _matches(index: _Index, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, item, distance, passage words and first word of the best match of every (document, item)."""
    w, doc = _words(data, offsets)
    ends = np.searchsorted(doc, np.arange(len(offsets)))
    found = [tuple(np.zeros(0, np.int64) for _ in range(4))]
    if len(w) and len(index.item):
        passage, begin = _candidates(index, w, ends[doc])
        own = doc[begin]
        distance = _distances(index, w, ends[own], ends[own + 1], passage, begin)
        close = distance <= np.floor(EDIT_SHARE * index.size[passage])
        found.append((begin[close], index.item[passage[close]], distance[close], index.size[passage[close]]))
    if len(w) and len(index.short.item):
        short, place = _exact(index.short, data, offsets)
        begin = np.searchsorted(T.spans(data, offsets, T.MARKS)[0], place, "right") - 1 if len(place) else place
        found.append((begin, index.short.item[short], np.zeros(len(short), np.int64), index.short.words[short]))
    begin, item, distance, words = (np.concatenate(x) for x in zip(*found))
    own = doc[begin]
    order = np.lexsort((begin, distance, item, own))
    begin, item, distance, words, own = (x[order] for x in (begin, item, distance, words, own))
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (item[1:] != item[:-1])
    return own[new], item[new], distance[new], words[new], (begin - ends[own])[new]


def _parts(benchmark: DataFrame, repeats: int) -> Iterator[_Index]:
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = math.ceil(size / PART_BYTES)
    for part in range(n):
        own = benchmark.select("item_id", "text").filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part)
        yield _build(own.orderBy("item_id", "text").toArrow(), repeats)  # about PART_BYTES of text


def leaks(docs: DataFrame, benchmark: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id,
    distance (word edits of the best passage), passage_words, start_word (0 =
    the document's first bare word).

    ``benchmark``: item_id, text. Words are runs of letters and digits, A-Z
    lower-cased. Null or empty texts have no words. Items of fewer than
    MIN_WORDS words are found where all of their words stand unchanged
    (letters other than A-Z also inside a longer run, as scripts without blanks
    have them); of these, items of fewer than MIN_CHARS letters and digits are
    not looked for. Rows with equal or null ids each give
    their own matches; repeated items with different ids are all reported.
    """
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, passage_words int, start_word long"

    def run_of(index: _Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, _, data, offsets in T.pieces(batch.column("text")):
                    own, item, distance, words, start = _matches(index, data, offsets)
                    if len(own):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("doc_id").take(pa.array(i + own)), index.items.take(pa.array(item)), pa.array(distance.astype(np.int32)),
                             pa.array(words.astype(np.int32)), pa.array(start)], ["doc_id", "item_id", "distance", "passage_words", "start_word"])
        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for index in _parts(benchmark, repeats):
        out = out.unionAll(docs.select("doc_id", "text").mapInArrow(run_of(index), schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; columns as they were."""
    def run_of(index: _Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for i, _, data, offsets in T.pieces(batch.column("text")):
                    clean[i + _matches(index, data, offsets)[0]] = False
                yield batch.filter(pa.array(clean))
        return run

    for index in _parts(benchmark, repeats):
        docs = docs.mapInArrow(run_of(index), docs.schema)
    return docs
