import math
import pathlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import brute
from threatspark.llm import language_model as L
from threatspark.llm import text as T


class Plain:
    """Interpolated modified Kneser-Ney over lists of tokens."""

    def __init__(self, texts, order):
        self.n, pad = order, max(order - 1, 1)
        self.raw, self.count = Counter(), [None] + [Counter() for _ in range(order)]
        longer = [set() for _ in range(order + 1)]
        for t in texts:
            self.raw.update(t)
            s = ["<s>"] * pad + t
            for i in range(pad, len(s)):
                self.count[order][tuple(s[i - order + 1:i + 1])] += 1
                for k in range(1, order):
                    longer[k].add(tuple(s[i - k:i + 1]))
        for k in range(1, order):
            self.count[k].update(g[1:] for g in longer[k])
        self.d, self.total = [None], [None]
        for k in range(1, order + 1):
            have = Counter(self.count[k].values())
            self.d.append((0, *L._discounts(have[1], have[2], have[3], have[4])))
            by = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in self.count[k].items():
                by[g[:-1]][0] += c
                by[g[:-1]][min(c, 3)] += 1
            self.total.append(by)

    def p(self, g):
        if not g:
            return 1 / (len(self.raw) + 1)
        k, low = len(g), self.p(g[1:])
        if g[:-1] not in self.total[k]:
            return low
        total, *have = self.total[k][g[:-1]]
        c, d = self.count[k].get(g, 0), self.d[k]
        return (max(c - d[min(c, 3)], 0) + sum(x * y for x, y in zip(d[1:], have)) * low) / total

    def score(self, t):
        s = ["<s>"] * max(self.n - 1, 1) + t
        return sum(math.log10(self.p(tuple(s[i - self.n + 1:i + 1]))) for i in range(max(self.n - 1, 1), len(s)))


def corpus():
    random.seed(8)
    heads = {i: [random.randint(0, 40) for _ in range(4)] for i in range(41)}
    texts = [None, "", " ", "unseen", "W1 w1"]
    for _ in range(120):
        w, out = random.randint(0, 40), []
        for _ in range(random.randint(1, 60)):
            out.append(("W" if random.random() < 0.1 else "w") + str(w))
            w = random.choice(heads[w]) if random.random() < 0.9 else random.randint(0, 60) % 41
        texts.append(" ".join(out))
    return texts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(frame, order):
    texts = corpus()
    rows = {r["doc_id"]: r for r in L.score_held_out(frame(texts), order).collect()}
    tokens = {i: brute.words(brute.lower(t or "")) + ["</s>"] for i, t in enumerate(texts)}
    out = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 == 2}
    model = Plain([t for i, t in tokens.items() if i not in out], order)
    n, v = sum(model.raw.values()), len(model.raw)
    for i, t in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in out, len(t), sum(model.raw[w] > 0 for w in t), n)
        assert abs(r["base_score"] - sum(math.log10((model.raw[w] + 1) / (n + v + 1)) for w in t)) < 1e-8
        assert abs(r["score"] - model.score(t)) < 1e-8
    # every context's probabilities, the unknown word's included, add up to one
    for context in list(model.total[order])[:20]:
        assert abs(sum(model.p((*context, w)) for w in [*model.raw, "never seen"]) - 1) < 1e-9
    if order == 2:
        assert sum(rows[i]["score"] for i in out) > sum(rows[i]["base_score"] for i in out)


def test_the_query_scores_by_trigrams(frame):
    # After "a b" comes c, after "x b" comes d: a bigram model can't tell.
    texts = ["a b c", "x b d"] * 40
    rows = L.score_held_out(frame([*texts, "a b c", "a b d"])).orderBy("doc_id").collect()
    assert rows[-2]["score"] > rows[-1]["score"] + 1


def test_a_very_long_text_and_contexts_of_many_words(frame, monkeypatch):
    """A context followed by more words than are added up when asked for, and
    shards of few bytes, so that what is sent on for a word meets again."""
    monkeypatch.setattr(L, "SHARD_BYTES", 5000)
    monkeypatch.setattr(L, "MERGE_ROWS", 40)
    random.seed(5)
    texts = [" ".join(f"the w{random.randint(0, 400)}" for _ in range(15_000)), "the w1 the w2", "the", "w3 the w900"]
    rows = {r["doc_id"]: r for r in L.score_held_out(frame(texts, ids=[2, 3, 4, 5]), 3).collect()}
    tokens = {i: t.split() + ["</s>"] for i, t in zip([2, 3, 4, 5], texts)}
    model = Plain([t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2], 3)
    assert max(sum(v[1:]) for v in model.total[2].values()) > L.LONG
    for i, t in tokens.items():
        assert abs(rows[i]["score"] - model.score(t)) < 1e-6


def test_counts_do_not_depend_on_blocks(frame, monkeypatch):
    texts = corpus()
    whole = {r["doc_id"]: r["score"] for r in L.score_held_out(frame(texts)).collect()}
    monkeypatch.setattr(L, "COUNT_TOKENS", 50)
    monkeypatch.setattr(L, "SCORE_BYTES", 100)
    parts = {r["doc_id"]: r["score"] for r in L.score_held_out(frame(texts, partitions=7)).collect()}
    assert all(abs(whole[i] - parts[i]) < 1e-9 for i in whole)


def test_empty_training_null_and_repeated_ids(frame):
    docs = frame(["a b", "a b", None], ids=[None, 5, 5])
    rows = L.score_held_out(docs).collect()
    assert len(rows) == 3 and all(math.isfinite(r["score"]) and not (r["doc_id"] is None and r["held_out"]) for r in rows)
    nothing = L.score(docs, L.train(docs.limit(0))).collect()
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["train_tokens"] == 0 for r in nothing)
    assert L.score_held_out(docs.limit(0)).count() == 0


def test_blocks_are_small_and_come_back_whole():
    """Disk: a block's words go as steps between sorted hashes, its rows by the first word of the context."""
    rng = np.random.default_rng(4)
    drawn = T.mix(np.minimum(rng.zipf(1.2, 60_000), 1 << 40).astype(np.uint64))
    for columns in (3, 2, 1):
        g = L._grams([drawn[i:len(drawn) - 2 + i] for i in range(columns)])
        block = L._pack(g)
        back = L._unpack(block)
        rows = lambda x: sorted(zip(*[x.tokens(i).tolist() for i in range(columns)], x.counts.tolist()))
        assert rows(back) == rows(g)
        assert columns < 3 or len(block) < 4.3 * len(g.counts)


def test_counts_beyond_a_byte_and_contexts_beyond_a_step(frame):
    """Counts of MANY and more are kept besides the bytes; starts are distances within a step."""
    texts = [" ".join(["the cat sat"] * 400 + [f"v{i} w{i} the" for i in range(300)]), "the cat sat v7 w7 the end", "cat the v299 w299"]
    rows = {r["doc_id"]: r for r in L.score_held_out(frame(texts, ids=[3, 4, 5])).collect()}
    tokens = {i: t.split() + ["</s>"] for i, t in zip([3, 4, 5], texts)}
    model = Plain([t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2], 3)
    for i, t in tokens.items():
        assert abs(rows[i]["score"] - model.score(t)) < 1e-6


def test_the_arrays_are_small_and_nothing_shuffled_is_kept(frame, spark):
    """Disk: an n-gram is its words' places in its shard's dictionary, and an order's shuffle goes with its count."""
    rng = random.Random(6)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 2000)}" for _ in range(10_000)) for _ in range(8)]
    before = spark.conf.get(L._CLEANUP, None)
    model = L.train(frame(texts), 3)
    assert spark.conf.get(L._CLEANUP, None) == before
    grams = len({(*t[i:i + 3],) for t in (x.split() for x in texts) for i in range(len(t) - 2)})
    size = sum(p.stat().st_size for p in pathlib.Path(model.folder.removeprefix("file:")).glob("3-*"))
    assert grams > 15_000 and size < 9 * grams


def test_a_lookup_opens_one_file_and_takes_no_step_too_many(frame, monkeypatch):
    """Time: a shard's arrays of an order are one file, however many shards
    there are; words of one follower are read once, others in as many steps as halve them."""
    monkeypatch.setattr(L, "SHARD_BYTES", 2000)
    rng = random.Random(9)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 500)}" for _ in range(3000)) for _ in range(4)]
    docs = frame(texts, ids=[3, 4, 5, 6])
    model = L.train(docs, 3)
    files = [p.name for p in pathlib.Path(model.folder.removeprefix("file:")).glob("*.npy")]
    assert model.shard_bits >= 4 and 0 < len(files) <= 4 << model.shard_bits
    plain = Plain([t.split() + ["</s>"] for t in texts], 3)
    for r, t in zip(sorted(L.score(docs, model).collect(), key=lambda r: r["doc_id"]), texts):
        assert abs(r["score"] - plain.score(t.split() + ["</s>"])) < 1e-6

    read = []
    places = L._places
    monkeypatch.setattr(L, "_places", lambda have, name, which: read.append(len(which)) or places(have, name, which))
    draw = np.random.default_rng(3)
    n = np.concatenate([np.zeros(50, np.int64), np.ones(5000, np.int64), draw.integers(2, 400, 200)])
    last = np.cumsum(n)
    held = np.concatenate([np.sort(draw.choice(1 << 20, k, replace=False)) for k in n])
    for size in (1 << 20, 1 << 25):
        have = L._split_places("words", held, size)
        wanted = np.where(draw.random(len(n)) < 0.6, held[np.minimum(last - n // 2 - 1, len(held) - 1)], draw.integers(-1, 1 << 20, len(n))).astype(np.int32)
        read.clear()
        at, hit = L._search(have, "words", last - n, last, wanted)
        there = [w in held[b - k:b] for w, k, b in zip(wanted, n, last)]
        assert hit.tolist() == there and any(there) and not all(there) and (held[at[hit]] == wanted[hit]).all()
        assert sum(read) == len(n) + sum(math.ceil(math.log2(k)) for k in n if k > 1)


def test_rows_are_sorted_the_same_in_one_number_or_in_columns():
    draw = np.random.default_rng(8)
    for size, most in ((50, 1), (50, 300), (1 << 22, 1), (1 << 21, 9)):  # the last two don't fit into 64 bits
        columns = [draw.integers(0, min(size, 12), 4000) + (size - 12 if size > 50 else 0) for _ in range(3)]
        counts = draw.integers(1, most + 1, 4000)
        rows, n, new = L._sorted(columns, counts, size)
        assert sorted(zip(*columns, counts)) == sorted(zip(*rows, n)) and [*zip(*rows)] == sorted(zip(*columns))
        assert new.tolist() == [i == 0 or rows[0][i] != rows[0][i - 1] or rows[1][i] != rows[1][i - 1] or rows[2][i] != rows[2][i - 1] for i in range(len(n))]
    words, at = L._numbered(np.array([7, 3, 7, 1 << 63, 0], np.uint64))
    assert words.tolist() == [0, 3, 7, 1 << 63] and at.tolist() == [2, 1, 2, 3, 0]
