"""Numpy arrays in the folder that driver and executors share.

Tasks write them, workers map them into memory: only the pages that a lookup
touches are read, and the system may drop them again, so an array may be
larger than a worker's memory. Where the shared folder isn't mounted (a path
with a scheme other than file:), an array is read whole through pyarrow.fs,
and a task keeps those it used last, up to HELD_BYTES.
"""

from __future__ import annotations

import io
import json
import math
import mmap
import os
import sys
import uuid
from collections import OrderedDict

import numpy as np

HELD_BYTES = 256 << 20   # of arrays that a task has fetched
HELD_MAPS = 1024         # of arrays that it has mapped
#: From Python 3.13 on a mapped file need not stay open, so that only the maps of a process are limited (65,530).
_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}
HELD_SETS = 8192 if _UNTRACKED else 512  # of files of several arrays that it has mapped
_ALIGNED = 64            # bytes at whose multiples an array starts in a file of several


class _Held(OrderedDict):
    """The arrays used last. Travels empty with the functions that use it."""

    def __reduce__(self):
        return _Held, ()


_held, _maps, _sets = _Held(), _Held(), _Held()


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if "://" not in path else None


def save(path: str, array: np.ndarray) -> None:
    """Write so that a retried or doubled task does no harm: the same content
    under a name of its own, then one rename."""
    at = _local(path)
    if at is None:
        from pyarrow import fs
        store, at = fs.FileSystem.from_uri(path)
        out = io.BytesIO()
        np.save(out, array)
        store.create_dir(os.path.dirname(at), recursive=True)
        name = f"{at}.{uuid.uuid4().hex}"
        with store.open_output_stream(name) as f:
            f.write(out.getbuffer())
        store.move(name, at)
        return
    os.makedirs(os.path.dirname(at), exist_ok=True)
    part = f"{at}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, at)


def _fetch(path: str) -> np.ndarray:
    from pyarrow import fs
    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_stream(at) as f:
        return np.load(io.BytesIO(f.read()))


def load(path: str) -> np.ndarray:
    """Maps or fetches an array; raises FileNotFoundError where there is none."""
    at = _local(path)
    held = _held if at is None else _maps
    if path not in held:
        held[path] = _fetch(path) if at is None else np.asarray(np.load(at, mmap_mode="r"))  # a plain view is quicker to index
        while len(held) > 1 and (sum(x.nbytes for x in held.values()) > HELD_BYTES if at is None else len(held) > HELD_MAPS):
            held.popitem(last=False)
    held.move_to_end(path)
    return held[path]


def save_all(path: str, named: dict[str, np.ndarray]) -> None:
    """Several arrays in one file, which is mapped or fetched as one."""
    where, at = [], 0
    for name, x in named.items():
        where.append((name, x.dtype.str, x.shape, at))
        at += -(-x.nbytes // _ALIGNED) * _ALIGNED
    head = json.dumps(where).encode()
    first = -(-(8 + len(head)) // _ALIGNED) * _ALIGNED
    out = np.zeros(first + at, np.uint8)
    out[:8] = np.array([len(head)], "<u8").view(np.uint8)
    out[8:8 + len(head)] = np.frombuffer(head, np.uint8)
    for (_, _, _, start), x in zip(where, named.values()):
        out[first + start:first + start + x.nbytes] = np.ascontiguousarray(x).reshape(-1).view(np.uint8)
    save(path, out)


def _named(raw: np.ndarray) -> dict[str, np.ndarray]:
    size = int(raw[:8].view("<u8")[0])
    first = -(-(8 + size) // _ALIGNED) * _ALIGNED
    return {name: raw[first + at:first + at + math.prod(shape) * np.dtype(kind).itemsize].view(kind).reshape(shape)
            for name, kind, shape, at in json.loads(raw[8:8 + size].tobytes())}


def load_all(path: str) -> dict[str, np.ndarray]:
    """What save_all wrote, by name, as views of the file; raises like load."""
    at = _local(path)
    if at is None:
        return _named(load(path))
    if path not in _sets:
        with open(at, "rb") as f:
            file = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED)
        raw = np.frombuffer(file, np.uint8)
        _sets[path] = _named(raw[10 + int(raw[8:10].view("<u2")[0]):])  # after numpy's own head
        while len(_sets) > HELD_SETS:
            _sets.popitem(last=False)
    _sets.move_to_end(path)
    return _sets[path]


def find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``q`` stands in sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(q), np.int64), np.zeros(len(q), bool)
    at = np.searchsorted(keys, q)
    at[at == len(keys)] = 0
    return at, keys[at] == q
