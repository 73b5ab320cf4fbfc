import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threatspark.llm import token_alignment as A

FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def own():
    a = Tokenizer.from_file(A.A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=A.B_FILE)
    vocab = {i: t for t, i in json.load(open(A.A_FILE))["model"]["vocab"].items()}
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    byte = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}

    def bytes_a(i):
        return bytes(byte[c] for c in vocab[i])

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def tokens(text):
        x = [(i, bytes_a(i)) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        y = [(i, bytes_b(i)) for i in b.encode(text)] if text else []
        if not text or any(b"".join(t for _, t in z) != (" " + text).encode() for z in (x, y)):
            return [], []
        return x, y

    return tokens


def brute(texts, tokens):
    """Byte by byte: which tokens hold it, and where both end."""
    docs = []
    for text in texts:
        x, y = tokens(text)
        of_a = [k for k, (_, t) in enumerate(x) for _ in t]
        of_b = [k for k, (_, t) in enumerate(y) for _ in t]
        links = [(x[i][0], y[j][0]) for i, j in sorted(set(zip(of_a, of_b)))]
        groups, i0, j0 = [], 0, 0
        for p in range(len(of_a)):
            if p + 1 == len(of_a) or (of_a[p + 1] != of_a[p] and of_b[p + 1] != of_b[p]):
                groups.append(",".join(str(t) for t, _ in x[i0:of_a[p] + 1]) + "|" + ",".join(str(t) for t, _ in y[j0:of_b[p] + 1]))
                i0, j0 = of_a[p] + 1, of_b[p] + 1
        docs.append((len(x), len(y), groups, links))
    count = Counter(pair for _, _, _, links in docs for pair in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return [(na, nb, len(g), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), ";".join(g))
            for na, nb, g, links in docs]


def texts():
    random.seed(4)
    words = "the of and thinking über naïve 東京 \U0001f600 <s> </s> <0x41> <|endoftext|> a1b2 ''s don't 123456 ____ ☃".split()
    out = [None, "", " ", "\n", "   lead and trail  ", "▁mark", "a b", "\x00\x01", "ﬁ ligature", "é"]
    out += ["x" * 3000, "word " * 800, "東" * 900, " ".join(random.choice(words) for _ in range(2500))]
    out += [" ".join(random.choice(words) for _ in range(random.randint(1, 60))) for _ in range(40)]
    return out + out[-12:] + ["The same text.\nTwice."] * 9


@pytest.mark.parametrize("step", [3, 64, A.PIECE])
def test_equals_brute_force(frame, own, step):
    docs = texts()
    want = brute(docs, own)
    got = {r["doc_id"]: r for r in A.align(frame(docs), step=step).collect()}
    assert len(got) == len(docs)
    for k, w in enumerate(want):
        assert tuple(got[k][n] for n in FIGURES) + (got[k]["groups"],) == w, (k, docs[k])
    assert sum(w[0] > 0 for w in want) > 40 and [w[0] for w in want[:2]] == [0, 0]


def test_tables_ids_and_digest(frame, spark):
    docs = frame(["One text here", "One text here", None, "other"], ids=[5, 5, None, None])
    rows = A.align(docs).withColumn("d", A.digest(F.col("groups"))).collect()
    assert sorted((str(r["doc_id"]), r["n_a"] > 0) for r in rows) == [("5", True), ("5", True), ("None", False), ("None", True)]
    two = [r for r in rows if r["doc_id"] == 5]
    assert two[0] == two[1] and two[0]["count_sum"] == 2 * two[0]["n_links"]
    assert all(r["d"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in rows)
    assert A.align(docs.limit(0)).count() == 0
    named = spark.createDataFrame([("k", "Some text")], "doc_id string, text string")
    assert A.align(named).first()["doc_id"] == "k"


def test_cuts_divide_the_merge_into_equal_pieces():
    random.seed(9)
    for _ in range(50):
        total = random.randint(1, 60)
        a, b = (np.array(sorted(random.sample(range(1, total), random.randint(0, total - 1)))  + [total]) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        step = random.randint(1, 9)
        i, j = A._cuts(a, b, step)
        for k in range(len(i)):
            head = merged[:min(k * step, len(merged))]
            assert (i[k], j[k]) == (sum(s == 0 for _, s in head), sum(s == 1 for _, s in head))


def test_ids_in_no_merge_order_go_by_the_tokenizer_itself():
    """A file whose ids don't stand in merge order can't be read as ranks."""
    model = json.load(open(A.A_FILE))
    model["model"]["merges"] = model["model"]["merges"][1:100] + model["model"]["merges"][:1]
    keep = set(A._byte_level()) | {"".join(m.split(" ") if isinstance(m, str) else m) for m in model["model"]["merges"]}
    model["model"]["vocab"] = {k: v for k, v in model["model"]["vocab"].items() if k in keep}
    file = json.dumps(model).encode()
    encode, vocabulary = A._encoder_a(file)
    text = " the thing and another theory"
    assert encode(text).tolist() == Tokenizer.from_str(file.decode()).encode(text).ids
    assert vocabulary.joined(encode(text)).tobytes() == text.encode()
