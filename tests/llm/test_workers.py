"""Executors need no copy of this package: what runs in tasks travels by value."""

import os
import pickle
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData

from threatspark.llm import arrays, language_model, lexical_search, line_dedup, substring_dedup, token_alignment, url_filter

RUNS = {
    "op3": lambda docs: language_model.score_held_out(docs).count(),
    "op5": lambda docs: line_dedup.line_digest(docs, line_dedup.keep_bitmaps(docs)).count(),
    "op8": lambda docs: substring_dedup.remove_repeats(docs.select("doc_id", "text")).count(),
    "op10": lambda docs: url_filter.filter_urls(docs.selectExpr("doc_id AS page_id", "'http://a.' || doc_id || '.com/x' AS url"),
                                                docs.selectExpr("'b.com' AS key").limit(1)).count(),
    "op11": lambda docs: token_alignment.align(docs).count(),
    "op12": lambda docs: lexical_search.search(docs, docs.selectExpr("doc_id AS item_id", "text"), broadcast_rows=0).count(),
}


@pytest.mark.parametrize("name", RUNS)
def test_task_functions_load_without_the_package(frame, monkeypatch, tmp_path, name):
    sent = []

    def noting(real):
        def call(self, func, *args, **kw):
            sent.append(func)
            return real(self, func, *args, **kw)
        return call

    for of, method in ((DataFrame, "mapInArrow"), (GroupedData, "applyInArrow")):
        real_class = type(frame(["x"])) if of is DataFrame else type(frame(["x"]).groupBy("doc_id"))
        monkeypatch.setattr(real_class, method, noting(getattr(real_class, method)))
    docs = frame(["some words that repeat " * 30, "some words that repeat " * 30, "others", None])
    assert RUNS[name](docs) >= 0 and len(sent) >= 1
    file = tmp_path / "functions"
    file.write_bytes(cloudpickle.dumps(sent))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = f"import pickle; print(len(pickle.load(open({str(file)!r}, 'rb')))); import sys; assert not any(m.startswith('threatspark') for m in sys.modules)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout) == len(sent), done.stderr


def test_broadcast_index_is_plain_arrays(frame):
    docs = frame(["some words", "other words"])
    index = lexical_search.build(docs.selectExpr("doc_id AS item_id", "text"))[0]
    sent = []

    class Context:
        sparkContext = type("C", (), {"broadcast": staticmethod(sent.append)})

    lexical_search._source(Context, index, False)
    assert index.small and b"threatspark" not in pickle.dumps(sent)


def test_arrays_held_are_bounded_and_stay_behind(tmp_path, monkeypatch):
    import numpy as np
    monkeypatch.setattr(arrays, "HELD_MAPS", 2)
    for i in range(4):
        arrays.save(f"{tmp_path}/{i}.npy", np.arange(i + 1))
        assert len(arrays.load(f"{tmp_path}/{i}.npy")) == i + 1
    assert len(arrays._maps) == 2 and not cloudpickle.loads(cloudpickle.dumps(arrays._maps))
    with pytest.raises(FileNotFoundError):
        arrays.load(f"{tmp_path}/none.npy")


def test_arrays_of_one_file_come_back_as_they_were(tmp_path, monkeypatch):
    import numpy as np
    named = {"a": np.arange(5, dtype=np.uint16), "none": np.zeros(0, np.int64), "two": np.arange(6, dtype=np.int64).reshape(2, 3), "odd": np.arange(7, dtype=np.uint8)}
    monkeypatch.setattr(arrays, "HELD_SETS", 2)
    for i in range(4):
        arrays.save_all(f"{tmp_path}/{i}.npy", named | {"i": np.array([i])})
        back = arrays.load_all(f"{tmp_path}/{i}.npy")
        assert back.pop("i").tolist() == [i] and [*back] == [*named]
        assert all(x.dtype == named[n].dtype and x.shape == named[n].shape and (x == named[n]).all() and x.ctypes.data % x.itemsize == 0 for n, x in back.items())
    assert len(arrays._sets) == 2 and not cloudpickle.loads(cloudpickle.dumps(arrays._sets))
    with pytest.raises(FileNotFoundError):
        arrays.load_all(f"{tmp_path}/none.npy")
