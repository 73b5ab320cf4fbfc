import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.brute import lower
from threatspark.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, top=10):
    """docs, items: lists of (id, text)."""
    counts = [(d, Counter(TERM.findall(lower(t or "")))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms = defaultdict(set)
    for i, t in items:
        terms[i] |= set(TERM.findall(lower(t or "")))
    out = set()
    for i, own in terms.items():
        ranked = []
        for d, c in counts:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                ranked.append((-score, d is None, d or 0))
        out |= {(i, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(ranked)[:top])}
    return out


def tables():
    random.seed(6)
    words = "the of and Alpha beta GAMMA x1 2024 ünï 東京 Ärger naïve don rare".split() + [f"w{i}" for i in range(40)]
    text = lambda n: "".join(random.choice(words) + random.choice([" ", ", ", "\n", "-", "_"]) for _ in range(n))
    docs = [None, "", " .,- ", "the " * 30_000] + [text(random.randint(1, 80)) for _ in range(90)] + [text(20_000)]
    docs += ["alpha beta rare"] * 25  # ties
    items = [(0, "rare alpha"), (1, "alpha"), (2, None), (3, "!!"), (4, "nowhere"), (5, "the"), (None, "beta GAMMA"), (5, "Rare rare")]
    return docs, items + [(i, text(random.randint(1, 30))) for i in range(10, 30)]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("block_rows, broadcast_rows, pass_items, cells", [(L.BLOCK_ROWS, L.BROADCAST_ROWS, L.PASS_ITEMS, L.CELLS), (20, 0, L.PASS_ITEMS, 50), (40, 10_000, 7, 300)])
def test_equals_brute_force(frame, spark, monkeypatch, block_rows, broadcast_rows, pass_items, cells):
    monkeypatch.setattr(L, "PASS_ITEMS", pass_items)
    monkeypatch.setattr(L, "CELLS", cells)
    docs, items = tables()
    got = rows(L.search(frame(docs), spark.createDataFrame(items, "item_id long, text string").repartition(3), 10, block_rows, broadcast_rows))
    assert len(got) == len(set(got)) and set(got) == brute(list(enumerate(docs)), items)


def test_repeated_and_null_ids(frame, spark):
    docs = ["alpha one", "alpha one", "alpha two", "alpha", "beta"]
    ids = [4, 4, None, 1, 2]
    items = [(1, "alpha")]
    got = rows(L.search(frame(docs, ids=ids), spark.createDataFrame(items, "item_id long, text string")))
    assert set(got) == brute(list(zip(ids, docs)), items) and sorted(r[1] for r in got) == [1, 2, 3, 4]


def test_empty_tables(frame, spark):
    items = spark.createDataFrame([("a", "alpha")], "item_id string, text string")
    docs = frame(["alpha"])
    assert set(rows(L.search(docs, items))) == brute([(0, "alpha")], [("a", "alpha")])
    assert rows(L.search(docs.limit(0), items)) == [] and rows(L.search(docs, items.limit(0))) == []


def test_words_whose_first_hashes_are_equal_stay_apart():
    import numpy as np
    b = L._Block(np.array([5, 5, 5, 9], np.uint64), np.array([1, 2, 3, 1], np.uint64), np.arange(5), np.arange(4), np.arange(4))
    where, term = b.find(np.array([5, 9, 5, 5, 7, 9], np.uint64), np.array([3, 1, 4, 1, 1, 2], np.uint64))
    assert where.tolist() == [0, 1, 3] and term.tolist() == [2, 3, 0]
