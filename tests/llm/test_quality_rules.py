from collections import Counter

from tests.llm import brute
from threatspark.llm import quality_rules as Q


def plain(text, lengths):
    w = brute.words(text)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    for n in lengths:
        count = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
        inside = {i + j for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1 for j in range(n)}
        out[f"dup_{n}gram_chars"] = sum(len(w[i]) for i in inside)
        if n == 5:
            out["n_repeat_words"] = len(inside)
    seen, dup, chars, lines = set(), 0, 0, 0
    for line in (text or "").split("\n"):
        if brute.words(line):
            lines += 1
            if line in seen:
                dup, chars = dup + 1, chars + sum(map(len, brute.words(line)))
            seen.add(line)
    return out | {"n_word_lines": lines, "n_dup_lines": dup, "dup_line_chars": chars}


TEXTS = [None, "", " \n\t", "one", "a b c d e " * 9, "añb #$ c\n añb #$ c\nañb #$ c", "x y z\nx y z\n\n\nx y z \nw",
         " ".join(f"w{i % 7}" for i in range(40)), " ".join(f"u{i}" for i in range(30_000)), "k\n" * 3000]


def test_equals_brute_force(frame):
    rows = {r["doc_id"]: r.asDict() for r in Q.repetition(frame(TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        want = plain(t, (5, 6, 7, 8, 9, 10))
        assert {k: rows[i][k] for k in want} == want, i


def test_verdicts(frame):
    rows = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in Q.judge(Q.repetition(frame(TEXTS))).collect()}
    assert rows[0] == rows[1] == rows[3] == (True, False)  # fewer than ten words
    assert rows[4] == (True, False)                        # all words repeat
    assert rows[8] == (False, True)                        # 30,000 different words
    assert rows[9] == (True, False)


def test_rows_with_repeated_and_null_ids_and_empty_table(frame):
    docs = frame(["a b", "c", "d e f"], ids=[None, 4, 4])
    assert sorted(str(r["doc_id"]) + str(r["n_words"]) for r in Q.repetition(docs).collect()) == ["41", "43", "None2"]
    assert Q.judge(Q.repetition(docs.limit(0))).count() == 0
