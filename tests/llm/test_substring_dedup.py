import random

import pyarrow as pa

from tests.llm import brute
from threatspark.llm import substring_dedup as S


def texts(seed=5):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)] + ["ö", "the", "of"]
    passages = [random.choices(vocabulary, k=k) for k in (34, 35, 36, 50, 120)]
    out = [None, "", "a b c", "same " * 34, "again " * 36, "loop " * 200, "x y " * 60, " ".join(random.choices(vocabulary, k=20_000))]
    for _ in range(60):
        w = random.choices(vocabulary, k=random.randint(0, 150))
        for _ in range(random.randint(0, 2)):
            p = list(random.choice(passages))
            if random.random() < 0.3:
                p[random.randrange(len(p))] = "changed"
            at = random.randint(0, len(w))
            w[at:at] = p
        out.append(random.choice([" ", "\n", " \t"]).join(w))
    hot = random.choices(vocabulary, k=14)  # a short phrase in many different surroundings
    out += [" ".join(random.choices(vocabulary, k=40) + hot + random.choices(vocabulary, k=40)) for _ in range(30)]
    return out + out[10:14]


def check(frame, rows):
    docs = frame(rows)
    got = S.remove_repeats(docs)
    assert set(got.columns) == {*docs.columns, "n_words", "n_removed"}
    want = brute.without_repeats(list(enumerate(rows)))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in got.collect()} == want
    assert sum(n for _, n, _ in want.values()) > 1000


def test_equals_brute_force(frame):
    check(frame, texts())


def test_lengthened_prefixes(frame, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 6)  # hot prefixes go by whole windows
    check(frame, texts(7))


def test_small_blocks(frame, monkeypatch):
    monkeypatch.setattr(S, "HELD", 10)
    monkeypatch.setattr(S, "SLICE", 500)
    check(frame, texts(9))


def test_trees_take_groups_whole(monkeypatch):
    """However batches cut the sorted rows, each prefix's group stays together."""
    words = " ".join(f"q{i}" for i in range(35)).encode()
    rows = [{"prefix": p, "c1": 10 * p + k, "c2": 0, "low": 0, "high": 0, "times": 1, "words": words if k < 2 else words[:-1] + b"z"}
            for p in range(6) for k in range(p)]
    kinds = pa.schema([("prefix", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
                       ("times", pa.int64()), ("words", pa.binary())])
    want = {10 * p + k for p in range(6) for k in range(p) if (k < 2 and p >= 2) or (k >= 2 and p >= 4)}
    for group in (2, 4, 8, 100):
        monkeypatch.setattr(S, "GROUP", group)
        for size in (1, 2, 3, 5, 100):
            batches = (pa.RecordBatch.from_pylist(rows[i:i + size], kinds) for i in range(0, len(rows), size))
            assert {c for b in S._trees(batches) for c in b.column("c1").to_pylist()} == want, (group, size)


def test_null_and_repeated_ids_and_empty(frame):
    long = " ".join(f"v{i}" for i in range(40))
    docs = frame([long, long, "short", None], ids=[None, None, 3, 3])
    assert sorted(r["n_removed"] for r in S.remove_repeats(docs).collect()) == [0, 0, 40, 40]
    assert S.remove_repeats(docs.limit(0)).count() == 0
