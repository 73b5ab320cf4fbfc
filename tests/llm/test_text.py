import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from threatspark.llm import text as T

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\r\x0böあ\x1c.", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_lines_and_hashes(rows):
    data, offsets = T.buffers(pa.array(rows, pa.string()))
    start, end, doc = T.spans(data, offsets)
    raw = data.tobytes()
    got = [(d, raw[a:b].decode()) for d, a, b in zip(doc.tolist(), start, end)]
    assert got == [(i, w) for i, t in enumerate(rows) for w in brute.words(t)]
    a, b, d = T.line_spans(data, offsets)
    assert [(k, raw[x:y].decode()) for k, x, y in zip(d.tolist(), a, b)] == [(i, x) for i, t in enumerate(rows) for x in (t or "").split("\n")]
    h = T.Segments(data, lower=True).hashes(start, end)
    by = {}
    for (_, w), x in zip(got, h.tolist()):
        assert by.setdefault(brute.lower(w), x) == x
    assert len(set(by.values())) == len(by)


def test_hashes_do_not_depend_on_the_place():
    word = b"hash"
    filler = b"y" * (3 * T._CHUNK)
    for at in (0, 1, T._CHUNK - 2, T._CHUNK, 2 * T._CHUNK + 17):
        data = np.frombuffer(filler[:at] + word + filler, np.uint8)
        assert T.Segments(data).hashes(np.array([at]), np.array([at + 4]))[0] == T.Segments(np.frombuffer(word, np.uint8)).hashes(np.array([0]), np.array([4]))[0]


def test_slices_cover_all_documents():
    offsets = np.array([0, 5, 5, 100, 101, 102, 500])
    for most in (1, 10, 99, 1000):
        parts = list(T.slices(offsets, most))
        assert [i for a, b in parts for i in range(a, b)] == list(range(6))


def test_sliced_and_large_columns():
    column = pa.array(["a b", None, "c", "d e f"])
    for kind in (pa.string(), pa.large_string()):
        data, offsets = T.buffers(column.cast(kind).slice(1))
        assert data.tobytes() == b"cd e f" and offsets.tolist() == [0, 0, 1, 6]
