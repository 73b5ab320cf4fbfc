import random

from tests.llm import brute
from threatspark.llm import near_dedup as N
from threatspark.llm.graph import components


def family_texts(seed=4):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "One", "two words", "two  Words", "three small words", "x " * 20_000]
    for _ in range(25):
        base = random.choices(vocabulary, k=random.choice([30, 80, 200]))
        for _ in range(random.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [texts[-1]] * 5
    base = random.choices(vocabulary, k=120)  # a large family with strays
    for _ in range(120):
        copy = list(base)
        for _ in range(random.randint(0, 12)):
            copy[random.randrange(len(copy))] = random.choice(vocabulary)
        texts.append(" ".join(copy))
    return texts


def check(frame, texts, words, percent):
    rows = N.near_groups(frame(texts), words, percent).collect()
    docs = list(enumerate(texts))
    want = brute.near_components(docs, words, percent)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == want[r["doc_id"]]) for r in rows)
    assert all(r["n_shingles"] == len(brute.shingles(texts[r["doc_id"]], words)) for r in rows)
    return want


def test_components_equal_brute_force(frame):
    want = check(frame, family_texts(), 3, 85)
    assert 20 < len(set(want.values())) < len(want) - 60


def test_five_words_and_small_blocks(frame, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 2000)  # large components get blocks of their own
    check(frame, family_texts(9), 5, 80)


def test_enough_chunks():
    assert N.chunks_for(85) < N.chunks_for(80) < N.chunks_for(70)


def test_null_and_repeated_ids_and_empty(frame):
    docs = frame(["a b c d e f", "a b c d e f", "a b c d e f", None], ids=[None, 4, 2, None])
    rows = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in N.near_groups(docs).collect())
    assert rows == [("2", "2", True), ("4", "2", False), ("None", "None", True), ("None", "None", True)]
    assert N.near_groups(docs.limit(0)).count() == 0
    kept = N.without_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 3
    again = frame(["a b c d e f", "a b c d e f", "q r s t u"], ids=[1, 1, 1])
    assert N.near_groups(again).count() == 3


def test_repeated_ids_tie_no_texts(frame):
    word = lambda x, n=30: " ".join(f"{x}{i}" for i in range(n))
    near = lambda x: word(x, 29) + " other"
    texts = [word("a"), near("a"), word("b"), word("c"), near("c"), word("d"), near("d"), word("e"), word("e"), None]
    ids = [0, 7, 7, 7, 9, 7, 3, 7, 7, 7]
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_groups(frame(texts, ids=ids)).collect()}
    n = 26
    assert rows == {(0, n, 0, True), (7, n, 0, False), (7, n, 7, True), (9, n, 7, False), (7, n, 3, False), (3, n, 3, True), (7, 0, 7, True)}
    kept = sorted((r["doc_id"], r["text"] or "") for r in N.without_copies(frame(texts, ids=ids)).collect())
    assert kept == sorted([(0, texts[0]), (7, texts[2]), (7, texts[3]), (3, texts[6]), (7, texts[7]), (7, texts[8]), (7, "")])


def test_one_id_for_all(frame):
    texts = family_texts(5)
    got = N.near_groups(frame(texts, ids=[4] * len(texts))).collect()
    assert len(got) == len(texts) and all(r["component_id"] == 4 and r["kept"] for r in got)
    assert N.without_copies(frame(texts, ids=[-4 if i % 2 else 4 for i in range(len(texts))])).filter("doc_id = -4").count() == len(texts) // 2


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    rows = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    assert rows == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200, 202: 200}
