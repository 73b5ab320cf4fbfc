"""Operator 11: alignment of two tokenizers by merge-path pieces.

Both tokenizers cut the same bytes (a blank and the text), so each gives a
sorted row of token ends. Merging the two rows meets every overlap once: at
each distinct end, the A token and the B token that hold the byte before it
are linked, and where both end a group closes. A binary search on evenly
spaced diagonals of the merge finds where the k-th piece starts in both rows
without merging what lies before it, so every document becomes pieces of at
most PIECE steps, stored once. Pieces are merged independently of each other;
a group that crosses an edge is stitched from the pieces' loose ends.

How many documents hold a linked pair of ids is counted over all pieces,
summed by pair, and stored as sorted arrays by A id; a second pass over the
pieces looks its links up there. Documents are tokenized once.

Every input row counts as a document of its own, rows with equal or null ids
too. Null and empty texts, and texts that a tokenizer does not give back byte
by byte, have no tokens: zeros and an empty string. Only the id and the text
are read, so other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatspark.llm import arrays
from threatspark.llm import text as T
from threatspark.llm.shared import new_folder, stored

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
PIECE = 1 << 15            # merge steps (tokens of A and B) of a piece
CHUNK = 1 << 20            # tokens that a task merges at once
HELD = 1 << 23             # pairs that a task holds before it counts them and hands them on
SHARDS = 64                # of the pair counts, by A id: at most |A| * |B| / 64 pairs each
MAX_FILE = 32 << 20        # bytes of a tokenizer file, which travels with the tasks
#: Fixed value: how byte-level BPE of this kind cuts text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_PAIR = np.uint64(22)      # a pair's code: A id above this bit, B id below; a chunk's piece above twice as many


@dataclass(frozen=True)
class Tokenizers:
    """The bytes of both files; they travel with the tasks, whose machines need no copy."""
    a: bytes
    b: bytes


def tokenizers(a_file: str = A_FILE, b_file: str = B_FILE) -> Tokenizers:
    """Reads a byte-level BPE file (A) and a piece model (B)."""
    out = []
    for name in (a_file, b_file):
        with open(name, "rb") as f:
            out.append(f.read(MAX_FILE + 1))
        if len(out[-1]) > MAX_FILE:
            raise ValueError(f"{name} has over {MAX_FILE} bytes")
    return Tokenizers(*out)


# ------------------------------------------------------------ tokens

class _Vocabulary:
    """Bytes of each id of one tokenizer."""

    def __init__(self, by_id: list[bytes]):
        self.size = np.array([len(x) for x in by_id], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(by_id), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        end = np.cumsum(n)
        return self.data[np.repeat(self.start[ids] - end + n, n) + np.arange(end[-1] if len(end) else 0)]


def _byte_level() -> dict[str, int]:
    """Printable characters stand for themselves, the other bytes for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _encoder_a(file: bytes):
    """(function from a text to its ids, vocabulary)"""
    model = json.loads(file)
    special = {t["id"] for t in model.get("added_tokens", [])}
    vocab = {k: v for k, v in model["model"]["vocab"].items() if v not in special}
    table = _byte_level()
    of = {v: bytes(table[c] for c in k) for k, v in vocab.items()}
    by_id = [of.get(i, b"") for i in range(max([*of, *special]) + 1)]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    made = [vocab["".join(m)] for m in merges]
    pre = model.get("pre_tokenizer") or {}
    if made == sorted(set(made)) and not model.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
            and not pre.get("add_prefix_space"):
        import tiktoken  # ids stand in merge order, so they serve as ranks: the same tokens, faster
        ranks = {x: i for i, x in enumerate(by_id) if x}
        enc = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return (lambda text: enc.encode_to_numpy(text, disallowed_special=())), _Vocabulary(by_id)
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(file.decode())
    tok.encode_special_tokens = True
    return (lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)), _Vocabulary(by_id)


def _encoder_b(file: bytes):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_proto=file)
    by_id = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        by_id.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return (lambda texts: model.encode(texts, num_threads=1)), _Vocabulary(by_id)


def _cuts(ends_a: np.ndarray, ends_b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How many A and B tokens come before each diagonal of the merge (A first
    where ends are equal): a binary search on all diagonals at once."""
    d = np.arange(0, len(ends_a) + len(ends_b), step)
    low, high = np.maximum(d - len(ends_b), 0), np.minimum(d, len(ends_a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        goes = np.zeros(len(d), bool)
        goes[open_] = ends_a[mid[open_]] <= ends_b[d[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & goes, mid + 1, low), np.where(open_ & ~goes, mid, high)
    i = np.append(low, len(ends_a))
    return i, np.append(d - low, len(ends_b))


def _packed(ids: np.ndarray) -> bytes:
    """Ids in three planes of bytes; the empty highest one vanishes when compressed."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(raw, np.uint8).reshape(3, -1).T
    return out.view("<u4").ravel()


_PIECES = "row long, doc_id {id}, piece int, pieces int, own_a int, own_b int, all_a int, lead long, tokens binary"


def _encode(both: Tokenizers, step: int):
    """Documents to pieces. A document without tokens is one empty piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, va = _encoder_a(both.a)
        encode_b, vb = _encoder_b(both.b)
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for first, last, data, _ in T.pieces(batch.column("text")):
                texts = [x or "" for x in batch.column("text").slice(first, last - first).to_pylist()]
                rows, at = [], 0
                for k, (text, b) in enumerate(zip(texts, encode_b(texts))):
                    n = len(text.encode())
                    raw, at = data[at:at + n], at + n
                    a, b = (encode_a(" " + text), np.array(b, np.uint32)) if text else (np.zeros(0, np.uint32), np.zeros(0, np.uint32))
                    for v, ids in ((va, a), (vb, b)):
                        back = v.joined(ids)
                        if len(back) != n + 1 or back[0] != 32 or not np.array_equal(back[1:], raw):
                            a = b = np.zeros(0, np.uint32)
                            break
                    ea, eb = np.cumsum(va.size[a]), np.cumsum(vb.size[b])
                    i, j = _cuts(ea, eb, step) if len(a) else (np.zeros(2, np.int64), np.zeros(2, np.int64))
                    for p in range(len(i) - 1):
                        # one more token of each side than the piece owns, if there is one: the links' other halves
                        pa_, pb_ = a[i[p]:i[p + 1] + 1], b[j[p]:j[p + 1] + 1]
                        lead = (ea[i[p] - 1] if i[p] else 0) - (eb[j[p] - 1] if j[p] else 0)
                        rows.append((first + k, p, len(i) - 1, i[p + 1] - i[p], j[p + 1] - j[p], len(pa_), lead,
                                     press.compress(_packed(np.concatenate([pa_, pb_])))))
                doc, *ints, tokens = zip(*rows)
                doc = pa.array(doc, pa.int64())
                kinds = [pa.int32()] * 5 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(doc), batch.column("doc_id").take(doc),
                     *[pa.array(x, t) for x, t in zip(ints, kinds)], pa.array(tokens, pa.binary())],
                    ["row", "doc_id", "piece", "pieces", "own_a", "own_b", "all_a", "lead", "tokens"])

    return run


def pieces(docs: DataFrame, both: Tokenizers, step: int = PIECE) -> DataFrame:
    """All documents' token rows, cut at the merge path's diagonals and stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    out = rows.mapInArrow(_encode(both, step), _PIECES.format(id=docs.schema["doc_id"].dataType.simpleString()))
    return stored(out, "token-pieces")


# ------------------------------------------------------------ merging

@dataclass
class _Merged:
    """The pieces of a chunk, merged. Links and groups are in order of their pieces."""
    piece_a: np.ndarray     # piece of every A token held
    piece_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    own_a: np.ndarray       # is it the piece's own, or the next one's?
    own_b: np.ndarray
    closes: np.ndarray      # does a group close with this B token?
    group_a: np.ndarray     # groups closed before this token, in all the chunk
    group_b: np.ndarray
    pairs: np.ndarray       # codes of the links
    piece: np.ndarray       # and their pieces


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Rows whose tokens are merged together."""
    unpress = zstandard.ZstdDecompressor()
    held, n, first = [], 0, 0
    for k, blob in enumerate(batch.column("tokens")):
        ids = _unpacked(unpress.decompress(blob.as_py()))
        held.append(ids)
        n += len(ids)
        if n >= CHUNK:
            yield slice(first, k + 1), held
            held, n, first = [], 0, k + 1
    if held:
        yield slice(first, first + len(held)), held


def _merge(batch: pa.RecordBatch, rows: slice, held: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray) -> _Merged:
    col = {n: batch.column(n).to_numpy()[rows] for n in ("own_a", "own_b", "all_a", "lead")}
    many = len(held)
    a = np.concatenate([x[:n] for x, n in zip(held, col["all_a"])])
    b = np.concatenate([x[n:] for x, n in zip(held, col["all_a"])])
    all_a, all_b = col["all_a"].astype(np.int64), np.array([len(x) for x in held]) - col["all_a"]
    piece_a, piece_b = np.repeat(np.arange(many), all_a), np.repeat(np.arange(many), all_b)
    start_a, start_b = np.cumsum(all_a) - all_a, np.cumsum(all_b) - all_b

    def ends(size, piece, start):  # within the piece
        s = np.concatenate([[0], np.cumsum(size)])
        return s[1:] - s[start[piece]]

    ea = ends(size_a[a], piece_a, start_a) + col["lead"][piece_a]
    eb = ends(size_b[b], piece_b, start_b)
    reach = np.zeros(many, np.int64)
    np.maximum.at(reach, piece_a, ea)
    np.maximum.at(reach, piece_b, eb)
    base = np.cumsum(reach + 1) - reach - 1
    ga, gb = ea + base[piece_a], eb + base[piece_b]
    own_a = np.arange(len(a)) - start_a[piece_a] < col["own_a"][piece_a]
    own_b = np.arange(len(b)) - start_b[piece_b] < col["own_b"][piece_b]
    to_b, to_a = np.searchsorted(gb, ga, "left"), np.searchsorted(ga, gb, "right")
    before = to_a - 1
    inside = before >= start_a[piece_b]
    closes = own_b & np.where(inside, ga[np.maximum(before, 0)] == gb if len(ga) else False, col["lead"][piece_b] == eb)
    done = np.concatenate([[0], np.cumsum(closes)])
    link_b = own_b & ~closes
    pairs = np.concatenate([a[own_a].astype(np.uint64) << _PAIR | b[to_b[own_a]], a[to_a[link_b]].astype(np.uint64) << _PAIR | b[link_b]])
    return _Merged(piece_a, piece_b, a, b, own_a, own_b, closes, done[to_b], done[:-1], pairs, np.concatenate([piece_a[own_a], piece_b[link_b]]))


def _sizes(both: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id, made once and sent in place of the files."""
    return _encoder_a(both.a)[1].size, _encoder_b(both.b)[1].size


def _distinct(m: _Merged) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of each piece, with their pieces."""
    key = np.sort(m.piece.astype(np.uint64) << (_PAIR + _PAIR) | m.pairs)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> (_PAIR + _PAIR)).astype(np.int64), key & np.uint64((1 << 2 * int(_PAIR)) - 1)


def _held_pairs(size_a: np.ndarray, size_b: np.ndarray):
    """Documents of one piece: pairs and in how many of the task's documents they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            keys, n = np.unique(np.concatenate(pairs), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["pair", "docs"])

        pairs, n = [], 0
        for batch in batches:
            for rows, held in _chunks(batch):
                pairs.append(_distinct(_merge(batch, rows, held, size_a, size_b))[1])
                n += len(pairs[-1])
                if n > HELD:
                    yield out()
                    pairs, n = [], 0
        if n:
            yield out()

    return run


def _row_pairs(size_a: np.ndarray, size_b: np.ndarray):
    """Documents of several pieces: the distinct pairs of each piece, with the document's row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, held in _chunks(batch):
                piece, pair = _distinct(_merge(batch, rows, held, size_a, size_b))
                row = batch.column("row").to_numpy()[rows][piece]
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(pair.astype(np.int64))], ["row", "pair"])

    return run


def pair_counts(cut: DataFrame, both: Tokenizers) -> DataFrame:
    """(pair, docs): in how many documents an A id and a B id are linked."""
    sizes = _sizes(both)
    alone = cut.filter("pieces = 1").mapInArrow(_held_pairs(*sizes), "pair long, docs long")
    several = (cut.filter("pieces > 1").mapInArrow(_row_pairs(*sizes), "row long, pair long").distinct()
               .groupBy("pair").agg(F.count("*").alias("docs")))
    return alone.unionByName(several).groupBy("pair").agg(F.sum("docs").alias("docs"))


def _write_counts(folder: str):
    """One shard: pairs in order, their counts, and whether one is its A id's highest."""
    def run(key, rows):
        pair = rows.column("pair").to_numpy().astype(np.uint64)
        order = np.argsort(pair)
        at = f"{folder}/{key[0].as_py()}"
        arrays.save(f"{at}-pairs.npy", pair[order])
        arrays.save(f"{at}-docs.npy", rows.column("docs").to_numpy()[order])
        arrays.save(f"{at}-best.npy", rows.column("best").to_numpy(zero_copy_only=False)[order])
        return pa.table({"pairs": pa.array([len(pair)], pa.int64())})

    return run


def write_counts(counts: DataFrame) -> str:
    """Stores the counts for look-ups; returns the folder."""
    folder = new_folder(counts.sparkSession, "token-pairs")
    a = F.shiftrightunsigned("pair", int(_PAIR))
    ranked = counts.withColumn("a", a).withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))
    sharded = ranked.groupBy((F.col("a") % SHARDS).alias("shard"))
    sharded.applyInArrow(_write_counts(folder), "pairs long").agg(F.sum("pairs")).collect()  # one number
    return folder


def _look_up(folder: str, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and best marks of distinct pairs, all of which are stored."""
    docs, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    shard = (pairs >> _PAIR) % np.uint64(SHARDS)
    order = np.argsort(shard, kind="stable")
    edge = np.searchsorted(shard[order], np.arange(SHARDS + 1))
    for s in np.flatnonzero(np.diff(edge)).tolist():
        own = order[edge[s]:edge[s + 1]]
        at, _ = arrays.find(arrays.load(f"{folder}/{s}-pairs.npy"), pairs[own])
        docs[own], best[own] = arrays.load(f"{folder}/{s}-docs.npy")[at], arrays.load(f"{folder}/{s}-best.npy")[at]
    return docs, best


# ------------------------------------------------------------ groups

_DIGITS = 10


def _decimal(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Right-aligned decimal digits of 0..size-1, one free place at the end, and their number."""
    width = len(str(max(size - 1, 0)))
    n = np.arange(size)
    out = np.zeros((size, width + 1), np.uint8)
    for k in range(width):
        out[:, width - 1 - k] = 48 + n // _DIGITS ** k % _DIGITS
    many = np.ones(size, np.int64)
    for k in range(1, width):
        many += n >= _DIGITS ** k
    return out, many


def _written(m: _Merged, many: int, clean: np.ndarray, digits_a, digits_b) -> list[str]:
    """Each piece's complete groups as text, first groups that began elsewhere left out (``clean``: none did)."""
    closed = np.bincount(m.piece_b[m.closes], minlength=many)       # groups that end in a piece
    end = np.cumsum(closed)
    skip = np.where(clean, 0, 1)
    whole_a = m.own_a & (m.group_a < end[m.piece_a]) & (m.group_a >= (end - closed + skip)[m.piece_a])
    whole_b = m.own_b & (m.group_b < end[m.piece_b]) & (m.group_b >= (end - closed + skip)[m.piece_b])
    ids = np.concatenate([m.a[whole_a], m.b[whole_b]])
    order = np.argsort(np.concatenate([m.group_a[whole_a] * 2, m.group_b[whole_b] * 2 + 1]), kind="stable")
    side = (np.arange(len(ids)) >= whole_a.sum())[order]
    ids, group = ids[order], np.concatenate([m.group_a[whole_a], m.group_b[whole_b]])[order]
    piece = np.concatenate([m.piece_a[whole_a], m.piece_b[whole_b]])[order]
    if not len(ids):
        return [""] * many
    last = np.ones(len(ids), bool)
    last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
    mark = np.where(last, np.where(side, ord(";"), ord("|")), ord(",")).astype(np.uint8)
    width = max(digits_a[0].shape[1], digits_b[0].shape[1])
    cells, size = np.zeros((len(ids), width), np.uint8), np.zeros(len(ids), np.int64)
    for of, (digits, n) in ((~side, digits_a), (side, digits_b)):
        cells[of, width - digits.shape[1]:] = digits[ids[of]]
        size[of] = n[ids[of]]
    cells[:, -1] = mark
    flat = cells[np.arange(width) >= (width - 1 - size)[:, None]].tobytes()
    at = np.concatenate([[0], np.cumsum(size + 1)])
    edge = at[np.searchsorted(piece, np.arange(many + 1))]
    return [flat[x:max(y - 1, x)].decode() for x, y in zip(edge[:-1], edge[1:])]  # without the last mark


_ALIGNED = "row long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_LOOSE = _ALIGNED + ", piece int, closed boolean, head_a array<int>, head_b array<int>, tail_a array<int>, tail_b array<int>"


def _align(folder: str, size_a: np.ndarray, size_b: np.ndarray, loose: bool):
    """Figures and groups of every piece; with ``loose``, also the tokens
    before its first and after its last group's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits_a, digits_b = _decimal(len(size_a)), _decimal(len(size_b))
        for batch in batches:
            for rows, held in _chunks(batch):
                m, many = _merge(batch, rows, held, size_a, size_b), len(held)
                codes, code = np.unique(m.pairs, return_inverse=True)
                docs, best = _look_up(folder, codes)
                total = np.zeros(many, np.int64)
                np.add.at(total, m.piece, docs[code])
                closed = np.bincount(m.piece_b[m.closes], minlength=many)
                number = batch.column("piece").to_numpy()[rows]
                count = [np.bincount(m.piece_a[m.own_a], minlength=many), np.bincount(m.piece_b[m.own_b], minlength=many), closed,
                         np.bincount(m.piece, minlength=many), np.bincount(m.piece[best[code]], minlength=many), total]
                cols = [batch.column("row").slice(rows.start, many), batch.column("doc_id").slice(rows.start, many),
                        *[pa.array(c.astype(np.int64)) for c in count],
                        pa.array(_written(m, many, number == 0 if loose else np.ones(many, bool), digits_a, digits_b), pa.string())]
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
                if loose:
                    end = np.cumsum(closed)
                    first = end - closed

                    def ids(own, piece, group, values, head):
                        out, edge = [], np.searchsorted(piece, np.arange(many + 1))
                        for p in range(many):
                            at = slice(edge[p], edge[p + 1])
                            if head:  # of the first piece only if no group ends in it
                                keep = own[at] & (group[at] == first[p]) & (number[p] > 0 or closed[p] == 0)
                            else:
                                keep = own[at] & (group[at] == end[p]) & (closed[p] > 0)
                            out.append(values[at][keep].astype(np.int32))
                        return pa.array(out, pa.list_(pa.int32()))

                    a, b = (m.own_a, m.piece_a, m.group_a, m.a), (m.own_b, m.piece_b, m.group_b, m.b)
                    cols += [pa.array(number, pa.int32()), pa.array(closed > 0), ids(*a, True), ids(*b, True), ids(*a, False), ids(*b, False)]
                    names += ["piece", "closed", "head_a", "head_b", "tail_a", "tail_b"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _stitch():
    """One document of several pieces: their groups in order, and those that cross edges put together."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece")
        text, open_a, open_b = [], [], []
        for r in rows.select(["piece", "closed", "groups", "head_a", "head_b", "tail_a", "tail_b"]).to_pylist():
            open_a += r["head_a"]
            open_b += r["head_b"]
            if r["closed"]:
                if open_a or open_b:
                    text.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
                text += [r["groups"]] if r["groups"] else []
                open_a, open_b = r["tail_a"], r["tail_b"]
        names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        out = rows.slice(0, 1).select(names[:2])
        for n in names[2:]:
            out = out.append_column(n, pa.array([int(rows.column(n).to_numpy().sum())], pa.int64()))
        return out.append_column("groups", pa.array([";".join(text)], pa.string()))

    return run


def align(docs: DataFrame, both: Tokenizers | None = None, step: int = PIECE) -> DataFrame:
    """One row per document: numbers of A and B tokens, groups and links; how
    many links are the most common of their A id; the links' counts summed; and
    the groups themselves, as `a1,a2|b1;a3|b2,b3`."""
    both = both or tokenizers()
    cut = pieces(docs, both, step)
    folder = write_counts(pair_counts(cut, both))
    sizes, kind = _sizes(both), docs.schema["doc_id"].dataType.simpleString()
    alone = cut.filter("pieces = 1").mapInArrow(_align(folder, *sizes, False), _ALIGNED.format(id=kind))
    several = (cut.filter("pieces > 1").mapInArrow(_align(folder, *sizes, True), _LOOSE.format(id=kind))
               .groupBy("row").applyInArrow(_stitch(), _ALIGNED.format(id=kind)))
    return alone.unionByName(several).drop("row")


def digest(groups: Column) -> Column:
    return F.when(groups == "", "").otherwise(F.sha2(groups, 256))
