import hashlib
import random

import numpy as np
import pyarrow as pa

from tests.llm import brute
from threatspark.llm import line_dedup


def digest(docs):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"])
            for r in line_dedup.line_digest(docs, line_dedup.keep_bitmaps(docs)).collect()}


def test_equals_brute_force(spark, frame):
    random.seed(5)
    pool = [f"Line number {i} of the shared pool" for i in range(12)] + ["short", "", "  \t"]
    texts = [None, "", "\n\n", "x" * 50_000]
    for _ in range(60):
        lines = [random.choice(pool) + random.choice(["", " ", "\r", "\t"]) for _ in range(random.randint(1, 9))]
        texts.append("\n".join(random.choice([str.upper, str])(x) for x in lines))
    texts += ["A hot line that every one of these documents holds\nown " + str(i) for i in range(40)]
    docs = list(enumerate(texts))
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in brute.line_dedup(docs).items()}
    got = digest(frame(texts))
    assert got == want
    assert sum(k for _, k, _ in want.values()) > 50


def test_runs_over_batch_and_partition_edges():
    """The scan gives the same drops however the sorted rows are cut."""
    rows = sorted(((h, -d, line) for h, n in ((1, 1), (2, 9), (3, 3), (4, 2), (5, 30), (6, 3)) for d in range(n) for line in range(2)))
    cols = {"d": [-d for _, d, _ in rows], "row": [0] * len(rows), "h1": [h for h, _, _ in rows], "h2": [0] * len(rows),
            "line": [x for _, _, x in rows], "n_lines": [2] * len(rows)}
    kinds = dict(zip(cols, ["i8", "i8", "i8", "i8", "i4", "i4"]))
    count = {h: len({d for x, d, _ in rows if x == h}) for h in range(1, 7)}
    want = {(h, -d, x) for h, d, x in rows if count[h] >= 3 and -d != max(-e for y, e, _ in rows if y == h)}
    for batch in (1, 2, 3, 7, 1000):
        for cut in ([], [10], [30], [15, 16, 40], [31, 35, 50, 70]):
            drops, still_open, sums = set(), [], {}
            # range partitioning keeps equal (hash, document) together
            edges = [0, *[c + (c % 2) for c in cut], len(rows)]
            for a, b in zip(edges, edges[1:]):
                batches = [pa.RecordBatch.from_arrays([pa.array(np.array(v[i:min(i + batch, b)], kinds[k])) for k, v in cols.items()], list(cols))
                           for i in range(a, b, batch)]
                for out in line_dedup._scan(3)(iter(batches)):
                    for r in out.to_pylist():
                        if r["state"] == line_dedup.DROP:
                            drops.add((r["h1"], r["d"], r["line"]))
                        elif r["state"] == line_dedup.OPEN:
                            still_open.append(r)
                        else:
                            n, top = sums.get(r["h1"], (0, r["d"]))
                            sums[r["h1"]] = n + r["line"], max(top, r["d"])
            for r in still_open:
                n, top = sums[r["h1"]]
                if n >= 3 and r["d"] != top:
                    drops.add((r["h1"], r["d"], r["line"]))
            assert drops == want, (batch, cut)


def test_columns_stay_and_characters_are_counted_anew(frame):
    line = "This line is in all three of the documents"
    docs = frame([line + "\nö", line, line, None], n_chars=[len(line) + 2, len(line), len(line), 0])
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = {r["doc_id"]: (r["text"], r["n_chars"], r["kept"]) for r in out.collect()}
    assert rows == {0: ("ö", 1, 7), 1: ("", 0, 7), 2: (line, len(line), 7), 3: (None, 0, 7)}


def test_repeated_and_null_ids_and_empty_table(frame, spark):
    line = "This line is in all three of the documents"
    docs = frame([line, line, line, line + "\nx", line], ids=[1, 1, 1, None, 2])
    got = sorted((str(r["doc_id"]), r["text"]) for r in line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect())
    assert got == [("1", ""), ("1", ""), ("1", ""), ("2", line), ("None", "x")]  # three documents: null, 1, 2
    empty = frame(["x"]).limit(0)
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0


def test_bitmaps_round_trip():
    for n, drop in ((1, [0]), (9, [0, 8]), (1000, list(range(0, 1000, 3)))):
        keep = line_dedup._unpack(line_dedup._bitmap(np.array(drop), n), n)
        assert np.flatnonzero(~keep).tolist() == drop and len(keep) == n
