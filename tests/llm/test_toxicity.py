import random

import numpy as np

from threatspark.llm import toxicity as X


def corpus(n=600, seed=3):
    random.seed(seed)
    plain = [f"{a}{b}" for a in ("ba", "lo", "mi", "ru", "te") for b in ("nal", "ster", "ving", "der", "mo")]
    rude = ["grobnik", "grobnak", "schlump", "schlumper"]
    texts, toxic = [], []
    for i in range(n):
        words = random.choices(plain, k=random.randint(5, 200))
        bad = i % 5 == 0
        for _ in range(random.randint(1, 5) if bad else 0):
            words.insert(random.randrange(len(words)), random.choice(rude) + random.choice(["", ",", "us"]))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def test_held_out_accuracy(spark, frame):
    texts, toxic = corpus()
    docs = frame(texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic) if i % 2], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in X.score(docs, X.train(docs, X.graded(labels)), "x_").collect()}
    unseen = [i for i in range(len(texts)) if i % 2 == 0]
    right = [int(rows[i]["x_p_toxic"] >= 0.5) == toxic[i] for i in unseen]
    assert np.mean(right) > 0.98
    assert all(rows[i]["severity"] == 7 for i in unseen)  # the table's own column stays
    kept = {r["doc_id"] for r in X.reject_toxic(docs, labels).collect()}
    assert sum(i in kept for i in unseen if not toxic[i]) >= 0.99 * sum(not toxic[i] for i in unseen)
    by_grade = {g: np.mean([rows[i]["x_severity"] for i in rows if rows[i]["x_grade"] == g]) for g in (0, 1, 2)}
    assert by_grade[0] < by_grade[1] < by_grade[2]


def test_regression_recovers_order():
    rng = np.random.default_rng(1)
    n, f = 3000, 12
    x = rng.random((n, f)) < 0.3
    w = rng.normal(size=f) * 2
    eta = x @ w
    grade = (eta[:, None] + rng.logistic(size=(n, 1)) > np.array([0.0, 2.0])).sum(axis=1)
    rows, cols = np.nonzero(x)
    got, theta = X.fit_ordinal(rows, cols, grade, f, 3, l2=0)
    assert theta[0] < theta[1] and np.corrcoef(got, w)[0, 1] > 0.97 and np.abs(theta - [0, 2]).max() < 0.5


def test_nulls_empty_tables_and_single_grades(spark, frame):
    docs = frame([None, "", "grobnik " * 20_000, "calm", "calm"], ids=[1, None, 3, 4, 4])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.reject_toxic(docs, none).count() == 5
    clean = spark.createDataFrame([(1, 1, 0), (4, None, 0), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert X.reject_toxic(docs, clean).count() == 5
    assert X.reject_toxic(docs.limit(0), clean).count() == 0
    assert X.reject_toxic(docs, clean).columns == docs.columns
