"""Operator 5: line dedup by range-partitioned hashes.

Every long enough line becomes (128-bit key hash, document, position). The
rows are range-partitioned by hash *and* document, sorted by hash, document
(largest first) and position, and streamed: a run of one hash is decided after
its third document, so no run is ever held in memory. Because the document is
part of the range, a line that a third of all documents hold spreads over many
tasks; the runs at the edges of a partition, which may go on in the next one,
are settled by a count that is combined map-side. What comes back is one
compressed keep bitmap per document with a dropped line, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from threatspark.llm import text as T
from threatspark.llm.shared import stored

MIN_CHARS = 20
MIN_DOCS = 3
_NO_ID = -(1 << 63)  # stands for a null doc_id: one document, below all others

_LINE = "d long, row long, h1 long, h2 long, line int, n_lines int"


def _line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "row"))
            for i, _, data, offsets in T.pieces(batch.column("text")):
                start, end, _ = T.spans(data, offsets)
                a, b, doc = T.line_spans(data, offsets)
                first, last = np.searchsorted(start, a), np.searchsorted(start, b)
                line = np.arange(len(a)) - np.searchsorted(doc, doc)
                n_lines = np.bincount(doc, minlength=len(offsets) - 1)
                full = np.flatnonzero(last > first)
                a, b = start[first[full]], end[last[full] - 1]  # the line without the blanks at its ends
                chars = T.characters(data)
                long = chars[b] - chars[a] >= min_chars
                full, a, b = full[long], a[long], b[long]
                h = [T.Segments(data, lower=True, family=k).hashes(a, b).view(np.int64) for k in (0, 1)]
                at = doc[full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (d[i + at], row[i + at], *h, line[full].astype(np.int32), n_lines[at].astype(np.int32))],
                    ["d", "row", "h1", "h2", "line", "n_lines"])

    return docs.mapInArrow(run, _LINE)


_COLS = ["d", "row", "h1", "h2", "line", "n_lines"]
DROP, OPEN, SUMMARY = 1, 2, 3


def _scan(min_docs: int):
    """Streams one sorted partition. A run of equal hashes begins with its
    largest document; once it has ``min_docs`` documents, all its rows of
    other documents are DROP. The first run may have begun in an earlier
    partition and the last may go on in the next, so the rows that this
    leaves undecided are OPEN, and one SUMMARY row per such run (its largest
    document in ``d``, its documents in ``line``) lets them be settled. Rows
    that stay are not returned. Held at a time: one batch and the rows of
    fewer than ``min_docs`` documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None      # all rows so far of the run at the end, while undecided
        going = None     # [key, largest document, documents, last document] of the run at the end, if its rows are out
        first = True     # that run is the partition's first

        def emit(cols, state):
            take = state > 0
            arrays = [pa.array(c[take]) for c in cols] + [pa.array(state[take])]
            return pa.RecordBatch.from_arrays(arrays, [*_COLS, "state"])

        def summary(key, lead, n_docs):
            values = [[lead], [0], [key[0]], [key[1]], [min(n_docs, 1 << 30)], [0]]
            cols = [np.array(v, k) for v, k in zip(values, ["i8", "i8", "i8", "i8", "i4", "i4"])]
            return emit(cols, np.array([SUMMARY], np.int8))

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in _COLS]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
                held = None
            d, h1, h2 = cols[0], cols[2], cols[3]
            state = np.zeros(len(d), np.int8)
            starts = np.concatenate([[0], np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1])
            if going is not None:
                stop = starts[1] if len(starts) > 1 else len(d)
                if (h1[0], h2[0]) == going[0]:
                    mine = d[:stop]
                    going[2] += int((mine[1:] != mine[:-1]).sum()) + int(mine[0] != going[3])
                    going[3] = mine[-1]
                    state[:stop] = OPEN if first else np.where(mine != going[1], DROP, 0)
                    starts = starts[1:]
                if len(starts):  # another run follows
                    if first:
                        yield summary(*going[:3])
                    going, first = None, False
            if len(starts):
                at = starts[0]
                lengths = np.diff(np.append(starts, len(d)))
                no = np.repeat(np.arange(len(starts)), lengths)
                new_doc = np.ones(len(d) - at, bool)
                new_doc[1:] = (d[at + 1:] != d[at:-1]) | (no[1:] != no[:-1])
                n_docs = np.bincount(no, weights=new_doc).astype(np.int64)
                lead = d[starts]
                state[at:] = np.where((n_docs[no] >= min_docs) & (d[at:] != lead[no]), DROP, 0)
                last = starts[-1]
                run = [(h1[-1], h2[-1]), lead[-1], int(n_docs[-1]), d[-1]]
                if first:  # the partition's first run is settled later
                    state[at:at + lengths[0]] = OPEN
                    if len(starts) == 1:
                        going = run
                    else:
                        yield summary((h1[at], h2[at]), lead[0], int(n_docs[0]))
                        first = False
                if going is None:
                    if n_docs[-1] >= min_docs:
                        going = run
                    else:
                        held = [c[last:] for c in cols]
                        state[last:] = 0
            yield emit(cols, state)
        if held is not None:
            yield emit(held, np.full(len(held[0]), OPEN, np.int8))
            d = held[0]
            yield summary((held[2][0], held[3][0]), d[0], 1 + int((d[1:] != d[:-1]).sum()))
        elif going is not None:
            yield summary(*going[:3])

    return run


def _bitmap(lines: np.ndarray, n_lines: int) -> bytes:
    keep = np.ones(n_lines, bool)
    keep[lines] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def _unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, n = batch.column("lines").to_pylist(), batch.column("n_lines").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("d"), batch.column("row"), batch.column("n_lines"),
             pa.array([len(set(x)) for x in lines], pa.int32()),
             pa.array([_bitmap(np.array(x), k) for x, k in zip(lines, n)], pa.binary())],
            ["d", "row", "n_lines", "n_dropped", "keep"])


def _with_id(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("d"),
                       F.xxhash64("text").alias("row"), "text")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document that loses lines: d (doc_id; null as the smallest
    long), row (xxhash64 of the text), n_lines, n_dropped, keep (zlib of the
    packed keep bits, first line first).

    A line's key is the line without blanks at its ends, A-Z lower-cased. A
    key of at least ``min_chars`` code points in at least ``min_docs``
    documents stays only in the largest doc_id that holds it. Documents count
    by doc_id: rows with the same doc_id are one document, null ids another.
    A null or empty text is one empty line and loses nothing. Only doc_id and
    text are read.
    """
    lines = stored(_line_keys(_with_id(docs), min_chars), "line-keys")
    order = [F.col("h1"), F.col("h2"), F.col("d").desc()]
    decided = stored(
        lines.repartitionByRange(*order).sortWithinPartitions(*order, "row", "line")
        .mapInArrow(_scan(min_docs), _LINE + ", state byte"), "line-runs")
    edge = (decided.filter(F.col("state") == SUMMARY).groupBy("h1", "h2")
            .agg(F.sum(F.col("line").cast("long")).alias("n_docs"), F.max("d").alias("lead"))
            .filter(F.col("n_docs") >= min_docs))
    late = (decided.filter(F.col("state") == OPEN)
            .join(F.broadcast(edge), ["h1", "h2"])  # at most two rows per partition of the sort
            .filter(F.col("d") != F.col("lead")))
    drops = decided.filter(F.col("state") == DROP).select("d", "row", "line", "n_lines").unionAll(
        late.select("d", "row", "line", "n_lines"))
    return (drops.groupBy("d", "row").agg(F.max("n_lines").alias("n_lines"), F.collect_set("line").alias("lines"))
            .mapInArrow(_bitmaps, "d long, row long, n_lines int, n_dropped int, keep binary"))


def _rewrite(text: str | None, bitmap: bytes | None, n_lines: int | None) -> str | None:
    if bitmap is None:
        return text
    keep = _unpack(bitmap, n_lines)
    return "\n".join(x for x, k in zip(text.split("\n"), keep) if k)


_OWN = "__line_dedup_"


def _joined(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    side = bitmaps.select(*[F.col(c).alias(_OWN + c) for c in ("d", "row", "n_lines", "n_dropped", "keep")])
    same = (F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID)) == side[_OWN + "d"]) & (
        F.xxhash64(docs["text"]) == side[_OWN + "row"])
    return docs.join(side, same, "left").drop(_OWN + "d", _OWN + "row")


def _rewritten(joined: DataFrame) -> DataFrame:
    """The text without its dropped lines; the last three columns, the bitmap's, go."""
    fields = joined.schema.fields[:-3]
    names = [f.name for f in fields]
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *cols, n, _, bits = batch.columns
            changed = np.flatnonzero(bits.is_valid().to_numpy(zero_copy_only=False))
            if len(changed):
                texts = cols[at].to_pylist()
                counts = cols[chars].to_pylist() if chars is not None else None
                for k in changed.tolist():
                    texts[k] = _rewrite(texts[k], bits[k].as_py(), n[k].as_py())
                    if counts is not None:
                        counts[k] = len(texts[k])
                cols[at] = pa.array(texts, cols[at].type)
                if counts is not None:
                    cols[chars] = pa.array(counts, cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, t.StructType(fields))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with the dropped lines taken out of text and,
    where there is such a column, n_chars counted anew for changed texts.
    Documents without a bitmap stay as they are, nulls included."""
    return _rewritten(_joined(docs, bitmaps))


def line_digest(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines (before), n_dropped, kept_sha256 (a null text counts as empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    j = _joined(docs.select("doc_id", "text"), bitmaps)
    j = j.select("doc_id", "text", n_lines.cast("long").alias("n_lines"),
                 F.coalesce(F.col(_OWN + "n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                 *[_OWN + c for c in ("n_lines", "n_dropped", "keep")])
    return _rewritten(j).select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))
