import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from threatspark.llm import fingerprints as P

PARAGRAPH = re.compile(r"[^\n]{80}[^\n.!?]*[.!?\n]*|[^\n]+\n*|\n+")


def key(p):
    return int(hashlib.md5(p.encode()).hexdigest()[:15], 16)


def check(k):
    return ((k % 2147483629) * 1000003 + (k >> 31) * 7368787) % 2147483647


def sketch(keys):
    cells = [[0, 0, 0] for _ in range(12)]
    for k in keys:
        for t in range(3):
            c = cells[4 * t + (k >> 20 * t) % 4]
            c[0], c[1], c[2] = c[0] + 1, c[1] ^ k, c[2] ^ check(k)
    return " ".join("%x:%x:%x" % tuple(c) for c in cells)


def brute(docs):
    """docs: (id, text) in the order of succession."""
    out, texts = [], [t or "" for _, t in docs]
    for i, t in enumerate(texts):
        u, n = texts[(i + 1) % len(texts)], len(t)
        e = t[:n - n // 2] + u[:n // 2]
        a, b, c = ({key(p) for p in PARAGRAPH.findall(x)} for x in (t, e, u))
        near = lambda x, y: 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0
        out.append((docs[i][0], n, hashlib.sha256(e.encode()).hexdigest(), sketch(a), sketch(b), near(a, b), near(a, c),
                    len(a - b), len(b - a), len(a - c), len(c - a)))
    return out


def texts():
    random.seed(8)
    words = "the of ünï 東京 \U0001f600 and. word! what? line\n more".split(" ")
    text = lambda n: " ".join(random.choice(words) + str(random.randint(0, 99)) for _ in range(n))
    long = text(30_000)
    out = [None, "", "\n\n\n", "x", "no mark at all " * 4000, long, long, long[:-3000] + text(200)]
    out += [text(random.randint(1, 400)) for _ in range(40)]
    return out + out[20:23] * 3 + ["A copy.\n" * 50] * 4


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("in_range, tries", [(P.RANGE_ROWS, P.TRIES), (1, 2)])
def test_equals_brute_force(frame, monkeypatch, in_range, tries):
    monkeypatch.setattr(P, "RANGE_ROWS", in_range)
    monkeypatch.setattr(P, "TRIES", tries)
    docs = list(enumerate(texts()))
    got, want = rows(P.compare(frame([t for _, t in docs]))), brute(docs[::-1])
    assert len(got) == len(want) and set(got) == set(want)
    assert "".join(PARAGRAPH.findall(docs[5][1])) == docs[5][1]
    assert any(w[5] == 1 for w in want) and any(0 < w[5] < 0.6 for w in want) and any(w[7] > 500 for w in want)


def test_ids_that_repeat_or_are_null_or_far_apart(frame, monkeypatch):
    monkeypatch.setattr(P, "RANGE_ROWS", 2)
    ids = [None, 7, 7, -3, 10**15, 0, None, 12, 13, 14]
    out = rows(P.compare(frame([f"Text {i}. " * 20 for i in range(10)], ids=ids)))
    assert sorted(str(r[0]) for r in out) == sorted(map(str, ids))
    texts_ = {i: f"Text {i}. " * 20 for i in range(10)}
    edit = lambda a, b: hashlib.sha256((texts_[a][:80] + texts_[b][:80]).encode()).hexdigest()
    by_id = {r[0]: r[2] for r in out}
    assert by_id[10**15] == edit(4, 9) and by_id[12] in (edit(7, 1), edit(7, 2)) and by_id[0] == edit(5, 3)
    assert {r[2] for r in out if r[0] == 7} in ({edit(1, 2), edit(2, 5)}, {edit(2, 1), edit(1, 5)})
    assert by_id[-3] in (edit(3, 0), edit(3, 6)) and {r[2] for r in out if r[0] is None} in ({edit(0, 6), edit(6, 4)}, {edit(6, 0), edit(0, 4)})


def test_one_row_and_none(frame, monkeypatch):
    monkeypatch.setattr(P, "RANGE_ROWS", 1)
    assert [r[5:7] for r in rows(P.compare(frame(["Same.\n", "Same.\n"], ids=[None] * 2)))] == [(0.0, 1.0)] * 2
    one = rows(P.compare(frame(["Only this."])))
    assert one == brute([(0, "Only this.")]) and P.compare(frame(["x"]).limit(0)).count() == 0


def test_stuck_sketches_grow_until_all_digests_are_found(spark):
    random.seed(2)
    sets = [(random.sample(range(1 << 59), n), random.sample(range(1 << 59), m)) for n, m in ((0, 1), (1, 0), (5, 5), (40, 0), (3000, 10), (0, 0))]
    shared = random.sample(range(1 << 59), 500)
    pairs = spark.createDataFrame([(i, shared + a, b + shared) for i, (a, b) in enumerate(sets)], "pair long, a array<long>, b array<long>")
    got = {r["pair"]: (r["left"], r["right"]) for r in P.differences(pairs).collect()}
    assert got == {i: (len(a), len(b)) for i, (a, b) in enumerate(sets)}


def test_no_python_in_the_plan(frame):
    docs = frame(["One. Two."] * 3)
    pairs = docs.select(F.col("doc_id").alias("pair"), P.digests(F.col("text")).alias("a"), F.array().cast("array<long>").alias("b"))
    frames = [P.compare(docs), P.with_next(docs), P._next_size(P._split(P._tried(pairs, 0), 1), 1)]
    assert not re.search("Python|Arrow|Pandas|MapPartitions", "".join(f._jdf.queryExecution().toString() for f in frames))
