import random

from tests.llm import brute
from threatspark.llm import decontamination as D

random.seed(11)
VOCABULARY = [f"t{i}" for i in range(500)] + ["the", "of", "and"] * 40
ITEMS = [" ".join(random.choices(VOCABULARY, k=k)) for k in (6, 9, 14, 16, 17, 30, 59)]


def edited(words, k):
    words = list(words)
    for _ in range(k):
        i = random.randrange(len(words))
        what = random.choice(["change", "drop", "add"])
        if what == "change":
            words[i] = random.choice(VOCABULARY)
        elif what == "drop":
            del words[i]
        else:
            words.insert(i, random.choice(VOCABULARY))
    return words


def noise(k):
    return random.choices(VOCABULARY, k=k)


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def found(docs, bench):
    return {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()}


def test_exact_and_edited_passages(spark, frame):
    texts, planted = [None, "", " ".join(noise(30_000))], set()
    for i, item in enumerate(ITEMS):
        w = item.split()
        for k in range(20):
            planted.add((len(texts), i))
            passage = edited(w, int(D.EDIT_SHARE * min(len(w), D.PASSAGE_WORDS) * (k % 3) / 2))
            glue = [" ", "\n", ", "][k % 3]
            texts.append(glue.join(noise(k) + [x.upper() if k % 2 else x for x in passage] + noise(20 - k)))
    clean = len(texts)
    texts += [" ".join(noise(300)) for _ in range(50)]
    got = found(frame(texts), benchmark(spark))
    assert len(planted & got) >= 0.95 * len(planted)
    assert {p for p in planted if (p[0] - 3) % 20 % 3 == 0} <= got  # unchanged passages
    assert not any(d >= clean or d == 2 for d, _ in got)


def test_distances_are_exact(spark, frame):
    w = ITEMS[3].split()
    texts = [" ".join(noise(15) + edited(w, k % 4) + noise(15)) for k in range(40)]
    for r in D.leaks(frame(texts), benchmark(spark, [ITEMS[3]])).collect():
        assert r["distance"] == brute.edit_distance_inside(w, texts[r["doc_id"]].split())


def test_first_words_dropped_at_the_start_of_a_document(spark, frame):
    rng = random.Random(12)
    items = [" ".join(rng.choices(VOCABULARY, k=k)) for k in (7, 10, 13, 16) * 25]
    dropped = [(i, k) for i, x in enumerate(items) for k in (1, 2, 3) if k <= D.EDIT_SHARE * len(x.split())]
    texts = [" ".join(items[i].split()[k:] + rng.choices(VOCABULARY, k=20 * (i % 2))) for i, k in dropped]
    got = {(r["doc_id"], r["item_id"]): r for r in D.leaks(frame(texts), benchmark(spark, items)).collect()}
    missed = [x for at, x in enumerate(dropped) if (at, x[0]) not in got]
    assert len(missed) <= 0.05 * len(dropped)
    for (at, item), r in got.items():
        assert item == dropped[at][0] and r["distance"] == dropped[at][1] and 0 <= r["start_word"] <= 3


def test_long_items_of_few_words(spark, frame):
    chinese, mixed = "北京是中华人民共和国的首都和政治中心所在地", "氢原子的光谱线系由Balmer在1885年发现"
    items = [chinese, mixed + ",", "Supercalifragilistic EXPIALIDOCIOUS", "ภาษาไทยไม่มีช่องว่างระหว่างคำ", "短句子", "two words"]
    texts = [f"前言。{chinese}。后记", f"a b {mixed} c", "so supercalifragilistic, expialidocious!", "คือ" + items[3] + "ครับ", "短句子", "two words",
             chinese[:-1], "supercalifragilistic expialidociousness", "xsupercalifragilistic expialidocious", chinese[5:] + chinese[:5], chinese[:9] + " 。" + chinese[9:]]
    rows = D.leaks(frame(texts), benchmark(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"], r["start_word"]) for r in rows) == [(0, 0, 0, 0), (1, 1, 0, 2), (2, 2, 0, 1), (3, 3, 0, 0)]
    assert {r["doc_id"] for r in D.without_leaks(frame(texts), benchmark(spark, items)).collect()} == set(range(4, len(texts)))


def test_parts_of_the_benchmark(spark, frame, monkeypatch):
    texts = [f"before {x} after" for x in ITEMS] + ["clean words here"]
    whole = found(frame(texts), benchmark(spark))
    assert {(i, i) for i in range(len(ITEMS))} <= whole
    monkeypatch.setattr(D, "PART_BYTES", 200)  # several passes
    assert found(frame(texts), benchmark(spark)) == whole
    assert [r["doc_id"] for r in D.without_leaks(frame(texts), benchmark(spark)).collect()] == [len(ITEMS)]


def test_nulls_short_items_repeated_rows_and_empty(spark, frame):
    bench = spark.createDataFrame([(None, ITEMS[2]), (1, None), (2, ""), (3, "one two"), (4, ITEMS[2])], "item_id long, text string")
    docs = frame([ITEMS[2], ITEMS[2], "one two", None], ids=[None, 8, 8, 9])
    got = sorted(str(tuple(r)[:2]) for r in D.leaks(docs, bench).collect())
    assert got == sorted(["(None, None)", "(None, 4)", "(8, None)", "(8, 4)"])
    kept = D.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [8, 9]
    assert D.without_leaks(docs, bench.limit(0)).count() == 4
    assert D.leaks(docs.limit(0), bench).count() == 0 and D.leaks(docs, bench.limit(0)).count() == 0
