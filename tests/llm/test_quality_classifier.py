import random

import numpy as np

from threatspark.llm import quality_classifier as C


def test_selects_target_like_texts(spark, frame):
    random.seed(2)
    good = [f"good{i}" for i in range(60)]
    bad = [f"bad{i}" for i in range(60)]
    texts = [" ".join(random.choices(bad if i % 4 == 0 else good, k=80)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 3)], "doc_id long, quality int")
    rows = C.resample(frame(texts), labels).collect()
    assert len(rows) == 400
    assert abs(sum(r["selected"] for r in rows) - 300) <= 8
    assert np.mean([r["selected"] == (r["doc_id"] % 4 != 0) for r in rows]) > 0.96


def test_kth_largest(spark):
    random.seed(1)
    values = [random.randint(-(1 << 63), (1 << 63) - 1) for _ in range(300)] + [5, 5, 5, -1, 0, (1 << 63) - 1, -(1 << 63)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 150, 151, 152, 307):
        assert C.kth_largest(df, "v", k) == ordered[k - 1]
    assert C.kth_largest(df, "v", 308) is None


def test_draws_follow_weights_and_rank_follows_draw(frame):
    ratios = np.zeros(C.BUCKETS)
    rows = C.importance(frame(["a"] * 2000), ratios).orderBy("draw_rank").collect()
    draws = [r["draw"] for r in rows]
    assert draws == sorted(draws)
    assert abs(np.mean(draws) - 0.5772) < 0.1  # the mean of Gumbel noise
    assert len(set(draws)) == 2000


def test_nulls_ties_and_empty(spark, frame):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None), (0, 1)], "doc_id long, quality int")
    docs = frame([None, "", "x y", "x y", "z " * 50_000], ids=[0, None, 7, 7, 9])
    assert C.resample(docs, labels).count() == 5
    assert C.resample(docs.limit(0), labels).count() == 0
    no = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["selected"] for r in C.resample(docs, no).collect())
    assert not any(r["selected"] for r in C.resample(docs, no, keep_share=0.0).collect())
