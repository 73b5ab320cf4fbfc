import math
import random
from collections import Counter

from tests.llm import brute
from threatspark.llm import mixing as M


def test_schedule_equals_simulation_and_keeps_its_bound(frame):
    random.seed(6)
    for shares, sizes in (({"a": 3, "b": 2}, {"a": 90, "b": 10, "c": 31}), ({"a": 1}, {"a": 5, "b": 5}), ({"x": 7}, {"x": 40}), ({}, {"a": 1})):
        source = [s for s, n in sizes.items() for _ in range(n)]
        docs = frame(["t"] * len(source), source=source)
        rows = M.mix(docs, shares, 1, block_docs=4).collect()
        assert len(rows) == len(source)
        share = {s: shares.get(s, 1) for s in sizes}
        played = brute.pfair({s: math.ceil(n / 4) for s, n in sizes.items()}, share)
        by_slot = {r["slot"]: r["source"] for r in rows}
        assert [by_slot[i] for i in range(len(played))] == [p[0] for p in played]
        assert max(Counter((r["slot"], r["seat"]) for r in rows).values()) == 1
        for _, t, q, active, had in played:  # less than one block from the target at every slot
            assert all(abs(had[x] - t * share[x] / q) < 1 for x in active)


def test_blocks_are_in_key_order_whatever_the_buckets(frame, monkeypatch):
    docs = frame(["t"] * 320, source=["hot"] * 300 + ["b"] * 20)
    whole = {r["doc_id"]: (r["slot"], r["seat"]) for r in M.mix(docs, {}, 1, 8).collect()}
    monkeypatch.setattr(M, "BUCKET_DOCS", 10)
    assert {r["doc_id"]: (r["slot"], r["seat"]) for r in M.mix(docs, {}, 1, 8).collect()} == whole
    assert min(whole.values()) == (0, 0)


def test_no_python_in_the_plan(spark):
    docs = spark.sql("SELECT id AS doc_id, 't' AS text, concat('s', id % 3) AS source FROM range(9)")
    plan = M.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_nulls_repeats_empty_and_clashing_columns(frame):
    docs = frame([None, "", "x", "x", "y"], ids=[1, None, 2, 2, None], source=["a", None, "a", "a", None], block=[9] * 5, slot=[9] * 5)
    rows = M.mix(docs, {}, 1, 2).collect()
    assert len(rows) == 5 and len({(r["slot"], r["seat"]) for r in rows}) == 5
    assert {r["source"] for r in rows} == {"a", None} and all(r["kept"] == 7 for r in rows)
    assert M.mix(docs.limit(0)).count() == 0
