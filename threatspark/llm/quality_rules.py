"""Operator 9: quality rules by repetition coverage.

For several n-gram lengths, the share of a text's word characters that lie in
an n-gram found twice or more in the same text, and the share in repeated
lines. One pass over the text, no shuffle; rolling word hashes in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.llm import text as T

# Largest allowed share, in percent, of characters inside
# duplicated n-grams by n-gram length (the published web-text rules), and of
# characters and lines that repeat an earlier line.
MAX_NGRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
MAX_LINE_CHAR_PERCENT = 20
MAX_LINE_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
BASE_N = 5

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    docs = len(offsets) - 1
    start, end, doc = T.spans(data, offsets)
    chars = T.characters(data)
    seg = T.Segments(data)
    h, size = seg.hashes(start, end), chars[end] - chars[start]
    salt = T.mix(np.arange(docs, dtype=np.uint64))
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data])])
    out = {
        "n_words": T.per_doc(doc, None, docs),
        "word_chars": T.per_doc(doc, size, docs),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
    }
    for n in sorted({BASE_N, *lengths}):
        g, at = T.grams(h, doc, n)
        inside = T.covered(at[T.repeated(g ^ salt[doc[at]])], n, len(h))
        out[f"dup_{n}gram_chars"] = T.per_doc(doc[inside], size[inside], docs)
        if n == BASE_N:
            out["n_repeat_words"] = T.per_doc(doc[inside], None, docs)
    a, b, line_doc = T.line_spans(data, offsets)
    has_word = np.searchsorted(start, b) > np.searchsorted(start, a)
    a, b, line_doc = a[has_word], b[has_word], line_doc[has_word]
    key = seg.hashes(a, b) ^ salt[line_doc]
    _, first = np.unique(key, return_index=True)  # index of the earliest of equal lines
    again = np.ones(len(key), bool)
    again[first] = False
    word_sum = np.concatenate([[0], np.cumsum(size)])
    line_chars = word_sum[np.searchsorted(start, b)] - word_sum[np.searchsorted(start, a)]
    out["n_word_lines"] = T.per_doc(line_doc, None, docs)
    out["n_dup_lines"] = T.per_doc(line_doc[again], None, docs)
    out["dup_line_chars"] = T.per_doc(line_doc[again], line_chars[again], docs)
    return out


def repetition(docs: DataFrame, lengths: tuple[int, ...] = tuple(MAX_NGRAM_PERCENT)) -> DataFrame:
    """doc_id and the raw measures of every row (long each): n_words,
    word_chars, n_symbols, n_repeat_words, n_word_lines, n_dup_lines,
    dup_line_chars and dup_{n}gram_chars for each length.

    A null or empty text has zero everywhere; rows with null or repeated
    doc_id each give their own row; other columns are not read. Memory follows
    the longest single text. Equality of n-grams and lines within one text is
    by 64-bit hash.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_repeat_words", "n_word_lines", "n_dup_lines",
             "dup_line_chars", *[f"dup_{n}gram_chars" for n in sorted({BASE_N, *lengths})]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.pieces(batch.column("text")):
                m = _measure(data, offsets, lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i)] + [pa.array(m[n].astype(np.int64)) for n in names],
                    ["doc_id", *names])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def judge(measures: DataFrame, limits: dict[int, int] = MAX_NGRAM_PERCENT) -> DataFrame:
    """Adds base_failed and kept; all comparisons in whole numbers."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    bad = (100 * F.col("dup_line_chars") > MAX_LINE_CHAR_PERCENT * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > MAX_LINE_PERCENT * F.col("n_word_lines"))
    for n, percent in limits.items():
        bad = bad | (100 * F.col(f"dup_{n}gram_chars") > percent * F.col("word_chars"))
    return measures.withColumn("base_failed", base).withColumn("kept", ~base & ~bad)
