"""Operator 6: severity grades by cumulative-link ordinal regression.

P(grade <= k) = logistic(theta_k - w.x): one weight vector shared by ordered
thresholds. x: which sparse features a text holds, namely its bare words and
their 4- to 6-byte pieces (marked where they begin or end a word), hashed to
64 bits. Features are counted by grade over the labelled rows in Spark; the
few that tell the grades apart are kept, so the model is small and bounded and
travels with the scoring function. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from threatspark.llm import text as T

MAX_LABELLED = 20000  # labelled rows used for fitting, the first by a hash of doc_id
MAX_FEATURES = 4096
GRADES = 3
PIECES = (4, 5, 6)
REJECT_AT = 0.5       # rejected if P(grade >= 1) is at least this


@dataclass(frozen=True)
class OrdinalModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades


def _pieces(seg: T.Segments, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of words and the index of the word each belongs to."""
    word = [np.arange(len(start))]
    out = [T.mix(seg.hashes(start, end) + np.uint64(99))]
    for n in PIECES:
        count = np.maximum(end - start - n + 1, 0)
        at = np.repeat(np.arange(len(start)), count)
        a = start[at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        kind = (a == start[at]) + 2 * (a + n == end[at])
        out.append(T.mix(seg.hashes(a, a + n) + kind.astype(np.uint64)))
        word.append(at)
    return np.concatenate(out), np.concatenate(word)


def _features(data: np.ndarray, offsets: np.ndarray, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs: document numbers, and features or,
    with ``only`` (sorted), indexes into it. Pieces are made per distinct word."""
    start, end, doc = T.spans(data, offsets, T.MARKS)
    seg = T.Segments(data, lower=True)
    _, first, back = np.unique(seg.hashes(start, end), return_index=True, return_inverse=True)
    f, word = _pieces(seg, start[first], end[first])
    if only is not None:
        if not len(only):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(only, f)
        at[at == len(only)] = 0
        hit = only[at] == f
        f, word = at[hit], word[hit]
    order = np.argsort(word, kind="stable")
    f, word = f[order], word[order]
    count = np.bincount(word, minlength=len(first))
    begin = np.cumsum(count) - count
    times = count[back]
    row = np.repeat(doc, times)
    col = f[np.repeat(begin[back], times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)]
    if only is not None:
        pair = np.unique(row * len(only) + col)
        return pair // len(only), pair % len(only)
    order = np.lexsort((col, row))
    row, col = row[order], col[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1])
    return row[new], col[new]


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grade = batch.column("grade").to_numpy(zero_copy_only=False)
        for i, _, data, offsets in T.pieces(batch.column("text")):
            row, f = _features(data, offsets)
            names, at = np.unique(f, return_inverse=True)
            bad = grade[i + row] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(np.bincount(at)), pa.array(np.bincount(at, weights=bad).astype(np.int64))],
                ["f", "docs", "bad"])


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, n_features: int,
                grades: int = GRADES, l2: float = 1e-4, steps: int = 2500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch Adam on the mean log-likelihood."""
    n = max(len(grade), 1)
    above = np.array([(np.sum(grade > k) + 0.5) / (n + 1) for k in range(grades - 1)])
    theta0 = np.log((1 - above) / above)
    gaps = np.log(np.expm1(np.maximum(np.diff(theta0), 0.05)))
    x = np.concatenate([np.zeros(n_features), theta0[:1], gaps])
    if not len(grade):
        return x[:n_features], theta0
    m, v = np.zeros_like(x), np.zeros_like(x)

    def thresholds(x):
        return np.concatenate([x[n_features:n_features + 1], np.logaddexp(0, x[n_features + 1:])]).cumsum()

    def logistic(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        w, theta = x[:n_features], thresholds(x)
        eta = np.bincount(rows, weights=w[cols], minlength=len(grade))
        upper = np.append(theta, np.inf)[grade]
        lower = np.append(-np.inf, theta)[grade]
        a = np.where(np.isinf(upper), 1.0, logistic(np.where(np.isinf(upper), 0, upper) - eta))
        b = np.where(np.isinf(lower), 0.0, logistic(np.where(np.isinf(lower), 0, lower) - eta))
        p = np.maximum(a - b, 1e-12)
        g_eta = a + b - 1
        g_theta = np.zeros(grades - 1)
        top, low = grade < grades - 1, grade > 0
        np.add.at(g_theta, grade[top], (a * (1 - a) / p)[top])
        np.add.at(g_theta, grade[low] - 1, -(b * (1 - b) / p)[low])
        back = g_theta[::-1].cumsum()[::-1]  # a threshold moves all above it
        g = np.concatenate([
            np.bincount(cols, weights=g_eta[rows], minlength=n_features) / n - l2 * w,
            back[:1] / n, back[1:] * logistic(x[n_features + 1:]) / n])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return x[:n_features], thresholds(x)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, min_z: float = 4.0) -> OrdinalModel:
    """``labels``: doc_id and an integer grade from 0. Rows with a null id or
    grade are left out; of several grades of one id the highest counts. Fits
    on at most ``max_labelled`` labelled documents. Where the labels only tell
    0 from 1, the graded rows with more of the chosen features than their
    median are grade 2. Without labels, or without a grade above 0, no text is
    rejected."""
    known = (labels.select("doc_id", "grade").dropna().groupBy("doc_id").agg(F.max("grade").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("grade", "text")
    count = known.agg(F.count("*").alias("n"), F.count_if(F.col("grade") > 0).alias("bad")).first()
    share = count["bad"] / max(count["n"], 1)
    counted = rows.mapInArrow(_count_features, "f long, docs long, bad long").groupBy("f").agg(
        F.sum("docs").alias("docs"), F.sum("bad").alias("bad"))
    expected = F.col("docs") * F.lit(share)
    z = (F.col("bad") - expected) / F.sqrt(expected * F.lit(1 - share))
    best = (counted.filter((F.col("bad") >= 3) & (2 * F.col("bad") >= F.col("docs")) & (z >= min_z)).orderBy(z.desc(), "f").limit(MAX_FEATURES)
            .select("f").toArrow().column("f").to_numpy() if 0 < share < 1 else np.zeros(0, np.int64))
    features = np.sort(best.view(np.uint64))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grade = batch.column("grade").to_numpy(zero_copy_only=False)
            for i, j, data, offsets in T.pieces(batch.column("text")):
                row, col = _features(data, offsets, features)
                ends = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grade[i:j].astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(col.astype(np.int32)))],
                    ["grade", "cols"])

    data = rows.mapInArrow(encode, "grade int, cols array<int>").toArrow()  # at most max_labelled rows of MAX_FEATURES numbers
    cols = data.column("cols").combine_chunks()
    size = cols.value_lengths().to_numpy() if len(cols) else np.zeros(0, np.int64)
    grade = np.minimum(data.column("grade").to_numpy(), GRADES - 1).astype(np.int64)
    if len(grade) and grade.max() == 1:  # severity by how many marked words and pieces a text holds
        grade[(grade == 1) & (size > np.median(size[grade == 1]))] = 2
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(size)), size), cols.flatten().to_numpy().astype(np.int64), grade, len(features))
    return OrdinalModel(features, weights, thresholds)


def score(docs: DataFrame, model: OrdinalModel, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and: severity (the expected grade), p_toxic
    (P(grade >= 1)), grade (the likeliest), each with ``prefix`` before its
    name. A null or empty text has no features and gets the thresholds' values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            eta = np.zeros(batch.num_rows)
            for i, j, data, offsets in T.pieces(batch.column("text")):
                row, col = _features(data, offsets, model.features)
                eta[i:j] = np.bincount(row, weights=model.weights[col], minlength=j - i)
            above = 1 / (1 + np.exp(np.clip(model.thresholds[None, :] - eta[:, None], -40, 40)))
            p = -np.diff(np.concatenate([np.ones((len(eta), 1)), above, np.zeros((len(eta), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(p.argmax(axis=1).astype(np.int32))],
                [f.name for f in out.fields])

    out = StructType(list(docs.schema.fields))  # add() changes its object
    for name, kind in (("severity", "double"), ("p_toxic", "double"), ("grade", "integer")):
        out.add(prefix + name, kind)
    return docs.mapInArrow(run, out)


def graded(labels: DataFrame) -> DataFrame:
    """The table's label toxic (0 or 1) as grades; train() splits grade 1 by severity."""
    return labels.select("doc_id", F.col("toxic").alias("grade"))


def reject_toxic(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """``docs`` without the rows whose P(grade >= 1) reaches ``reject_at``; columns as they were."""
    own = "__toxicity_"
    return score(docs, train(docs, graded(labels)), own).filter(F.col(own + "p_toxic") < reject_at).select(*docs.columns)
