"""Operator 2: MinHash near-dedup by a multi-index Hamming join.

A text's signature is c chunks of 5 MinHash values of 16 bits. If two
signatures differ in at most 2c - 1 values, then by pigeonhole some chunk
differs in at most one; so for every chunk the five keys that each leave one
value out are written down, and the two signatures share a key. c is the least
number for which a pair at the similarity asked for differs in more values
with a chance of at most MISS (c = 13 at 0.85, 23 at 0.8).

Pairs of a key are never written out. Equal shingle sets are one node. First
every node is compared with one node that shares a key with it; keys whose
nodes then all belong to one component are settled. What is left over, nodes of
different components that still share a key, is compared in blocks of bounded
size, large components against the others only. All links are confirmed on
full shingle sets, so what is returned are exact components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.llm import text as T
from threatspark.llm.graph import components
from threatspark.llm.shared import stored

WORDS = 5            # words of a shingle
PERCENT = 80         # least similarity, in percent
VALUES = 5           # values of a chunk
MISS = 1e-6          # chance that a pair at the least similarity shares no key
BLOCK = 100_000      # shingles of one side of a comparison, unless one text has more

_rng = np.random.default_rng(2)
_XOR, _TIMES = (_rng.integers(1 << 63, size=1000 * VALUES, dtype=np.uint64) for _ in range(2))
_TIMES = _TIMES * np.uint64(2) + np.uint64(1)


def chunks_for(percent: int, miss: float = MISS) -> int:
    """Chunks of a signature, by the chance that more than 2c - 1 of 5c values differ."""
    differ = 1 - percent / 100
    for c in range(1, 1000):
        m = VALUES * c
        if sum(math.comb(m, k) * differ ** k * (1 - differ) ** (m - k) for k in range(2 * c, m + 1)) <= miss:
            return c
    raise ValueError(f"{percent} percent is too little for signatures of {VALUES}-value chunks with one error each")


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every document in order, and where each document's end."""
    docs = len(offsets) - 1
    start, end, doc = T.spans(data, offsets)
    h = T.Segments(data, lower=True).hashes(start, end)
    g, at = T.grams(h, doc, words)
    own = doc[at]
    n_words = np.bincount(doc, minlength=docs)
    first = np.cumsum(n_words) - n_words
    for n in range(1, words):  # a shorter text is one shingle
        short = np.flatnonzero(n_words == n)
        if len(short):
            whole, where = T.grams(h, doc, n)
            hit = np.searchsorted(where, first[short])
            g, own = np.concatenate([g, whole[hit]]), np.concatenate([own, short])
    order = np.argsort(g)
    order = order[np.argsort(own[order], kind="stable")]
    g, own = g[order], own[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
    g, own = g[new], own[new]
    return g, np.searchsorted(own, np.arange(docs), "right")


def _profiles(docs: DataFrame, words: int, chunks: int) -> DataFrame:
    """Per row: d, row, n (set size), f1 and f2 (the set's fingerprint), sig."""
    values = chunks * VALUES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.pieces(batch.column("text")):
                g, ends = _sets(data, offsets, words)
                n = np.diff(ends, prepend=0)
                full = np.flatnonzero(n)
                begin = (ends - n)[full]
                prints, sig = np.zeros((2, j - i), np.uint64), np.zeros((j - i, values), "<u2")
                if len(full):
                    prints[0, full], prints[1, full] = np.add.reduceat(g, begin), np.add.reduceat(T.mix(g + np.uint64(7)), begin)
                    for k in range(values):
                        least = np.minimum.reduceat((g ^ _XOR[k]) * _TIMES[k], begin)
                        sig[full, k] = T.mix(least) & np.uint64(0xFFFF)
                raw = sig.tobytes()
                width = 2 * values
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").slice(i, j - i), batch.column("row").slice(i, j - i), pa.array(n),
                     *[pa.array(p.view(np.int64)) for p in prints], pa.array([raw[k * width:(k + 1) * width] for k in range(j - i)], pa.binary())],
                    ["d", "row", "n", "f1", "f2", "sig"])

    return docs.mapInArrow(run, "d long, row long, n long, f1 long, f2 long, sig binary")


def _keys(chunks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                node = part.column("node").to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), "<u2").reshape(len(node), chunks, VALUES).astype(np.uint64)
                out = []
                for c in range(chunks):
                    for left_out in range(VALUES):
                        key = np.full(len(node), c * VALUES + left_out, np.uint64)
                        for v in range(VALUES):
                            if v != left_out:
                                key = T.mix(key) + sig[:, c, v]
                        out.append(T.mix(key).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.tile(node, len(out)))], ["key", "node"])
    return run


def _set_table(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.pieces(batch.column("text")):
                g, ends = _sets(data, offsets, words)
                raw = np.ascontiguousarray(g).tobytes()
                at = [0, *(8 * ends).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(i, j - i), pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary())], ["node", "shingles"])
    return run


def _linked(percent: int):
    """Compares the two sides (0 and 1) of a group; a side-2 node is on both.
    Returns pairs of different components with a large enough similarity."""
    def run(rows):
        node = rows.column("node").to_numpy()
        comp, side = rows.column("comp").to_numpy(), rows.column("side").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        left = np.flatnonzero(side != 1)
        owner = np.repeat(left, size[left])
        all_left = np.concatenate([sets[k] for k in left]) if len(left) else np.zeros(0, np.uint64)
        order = np.argsort(all_left, kind="stable")
        all_left, owner = all_left[order], owner[order]
        out = []
        for k in np.flatnonzero(side != 0).tolist():
            lo, hi = np.searchsorted(all_left, sets[k], "left"), np.searchsorted(all_left, sets[k], "right")
            n = hi - lo
            hit = owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            common = np.bincount(hit, minlength=len(sets))
            good = (100 * common >= percent * (size + size[k] - common)) & (common > 0) & (comp != comp[k])
            out += [(node[x], node[k]) for x in np.flatnonzero(good).tolist()]
        return pa.table({"u": pa.array([a for a, _ in out], pa.int64()), "v": pa.array([b for _, b in out], pa.int64())})
    return run


def _first_links(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every node against the least hub among its keys. A hub's nodes are cut
    into parts of bounded size, each with a copy of the hub."""
    edges = members.filter("node <> hub").groupBy("node").agg(F.min("hub").alias("hub")).join(sizes, "node")
    parts = edges.groupBy("hub").agg(F.ceil(F.sum("n") / (4 * BLOCK)).alias("parts"))
    visits = edges.join(parts, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), "node", F.lit(1).alias("side"))
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("hub").alias("node"), F.lit(0).alias("side"))
    return (visits.unionByName(hubs).join(sets, "node").withColumn("comp", F.col("node"))
            .groupBy("hub", "part").applyInArrow(_linked(percent), "u long, v long"))


def _late_links(members: DataFrame, comp: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share a key, by blocks of nodes
    (of bounded total size) within clusters (components tied by unsettled keys)."""
    m = members.select("key", "node").join(comp, "node")
    open_keys = m.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key", "low")
    unsettled = stored(m.join(open_keys, "key").groupBy("node", "comp", "low").agg(F.count("*")).select("node", "comp", "low"), "near-unsettled")
    cluster = components(unsettled.select(F.col("comp").alias("u"), F.col("low").alias("v")), "near-clusters")
    nodes = (unsettled.select("node", "comp").distinct()
             .join(cluster.select(F.col("node").alias("comp"), F.col("component").alias("cluster")), "comp", "left")
             .withColumn("cluster", F.coalesce("cluster", "comp")))
    size = nodes.join(sizes, "node").groupBy("cluster", "comp").agg(F.sum("n").alias("n"))
    rest = size.groupBy("cluster").agg(F.sum(F.when(F.col("n") < BLOCK, F.col("n")).otherwise(0)).alias("rest"))
    large = F.col("n") >= BLOCK
    # A large component has blocks of its own; small ones share blocks.
    block = F.when(large, F.struct(F.col("comp").alias("own"), F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("no"))).otherwise(
        F.struct(F.lit(None).cast("long").alias("own"), F.pmod(F.xxhash64("comp"), F.ceil(F.col("rest") / BLOCK)).alias("no")))
    placed = stored(nodes.join(size, ["cluster", "comp"]).join(rest, "cluster").select("cluster", "node", "comp", block.alias("block")), "near-blocks")
    blocks = placed.select("cluster", "block").distinct()
    a, b = blocks.select("cluster", F.col("block").alias("a")), blocks.select("cluster", F.col("block").alias("b"))
    pairs = a.join(b, "cluster").filter("a <= b AND NOT (a.own IS NOT NULL AND b.own IS NOT NULL AND a.own = b.own)")
    sides = pairs.select("cluster", "a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("block"), F.lit(2).alias("side")))).otherwise(
        F.array(F.struct(F.col("a").alias("block"), F.lit(0).alias("side")), F.struct(F.col("b").alias("block"), F.lit(1).alias("side"))))).alias("s"))
    rows = sides.select("cluster", "a", "b", F.col("s.block").alias("block"), F.col("s.side").alias("side")).join(placed, ["cluster", "block"])
    return (rows.select("cluster", "a", "b", "side", "node", "comp").join(sets, "node")
            .groupBy("cluster", "a", "b").applyInArrow(_linked(percent), "u long, v long"))


def _relabelled(nodes: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``column`` replaced by its component where it has one."""
    own = labels.select(F.col("node").alias(column), F.col("component").alias("__to"))
    return nodes.join(own, column, "left").withColumn(column, F.coalesce("__to", column)).drop("__to")


def _nodes(classes: DataFrame) -> DataFrame:
    """Adds each class's node: its least doc_id. Where classes share one, as
    different texts repeat an id, all but the first get a (negative) hash."""
    first = classes.groupBy("d").agg(F.min(F.struct("n", "f1", "f2")).alias("__first"), F.count("*").alias("__c")).filter("__c > 1").drop("__c")
    shared = stored(first, "near-shared")
    if shared.isEmpty():
        return classes.withColumn("node", F.col("d"))
    other = F.xxhash64("d", "n", "f1", "f2").bitwiseOR(F.lit(-(1 << 63)))
    node = F.when(F.col("__first").isNull() | (F.col("__first") == F.struct("n", "f1", "f2")), F.col("d")).otherwise(other)
    return stored(classes.join(shared, "d", "left").withColumn("node", node).drop("__first"), "near-nodes")


def _groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """d, row (its text's hash), n and component of every row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("row"), "text")
    chunks = chunks_for(percent)
    profiles = stored(_profiles(d, words, chunks), "near-profiles")
    classes = _nodes(stored(profiles.filter("n > 0 AND d IS NOT NULL").groupBy("n", "f1", "f2")
                            .agg(F.min(F.struct("d", "row", "sig")).alias("m"))
                            .select("n", "f1", "f2", "m.d", "m.row", "m.sig"), "near-classes"))
    keys = classes.select("node", "sig").mapInArrow(_keys(chunks), "key long, node long")
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("__top")).filter("hub < __top").select("key", "hub")
    members = stored(keys.join(hubs, "key"), "near-members")
    wanted = members.select("node").distinct().join(classes.select("node", "d", "row"), "node")
    texts = d.join(wanted.hint("merge"), ["d", "row"]).select("node", "text")
    sets = stored(texts.mapInArrow(_set_table(words), "node long, shingles binary"), "near-sets")
    sizes = classes.select("node", "n")
    first = components(_first_links(members, sizes, sets, percent), "near-first")
    comp = stored(_relabelled(members.select("node").distinct().withColumn("comp", F.col("node")), first, "comp"), "near-comp")
    late = _late_links(members, comp, sizes, sets, percent)
    c = comp.select("node", "comp")
    across = (late.join(c.select(F.col("node").alias("u"), F.col("comp").alias("cu")), "u")
              .join(c.select(F.col("node").alias("v"), F.col("comp").alias("cv")), "v").select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    final = stored(_relabelled(comp, components(across, "near-last"), "comp"), "near-final")
    named = classes.select("n", "f1", "f2", "d", "node").join(final, "node", "left").withColumn("component", F.coalesce("comp", "node"))
    # a component's label is its least node: the least doc_id, or a hash below all of them, for which it is looked up
    hashed = named.filter("component < 0")
    if not hashed.isEmpty():
        least = hashed.groupBy("component").agg(F.min("d").alias("__least"))
        named = named.join(least, "component", "left").withColumn("component", F.coalesce("__least", "component"))
    out = profiles.select("d", "row", "n", "f1", "f2").join(named.select("n", "f1", "f2", "component"), ["n", "f1", "f2"], "left")
    component = F.when(F.col("d").isNotNull(), F.when(F.col("n") == 0, F.col("d")).otherwise(F.col("component")))
    return out.select("d", "row", "n", component.alias("component"), F.coalesce(F.col("d") == component, F.lit(True)).alias("kept"))


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Words: runs of bytes other than blank and 0x09-0x0D, A-Z lower-cased. A
    document's set: its distinct ``words``-word shingles; a shorter text is
    one shingle; a text without words, or null, is empty and linked with
    nothing. Two documents are linked if 100 * common >= percent * union.
    component_id: the smallest doc_id reachable; kept: doc_id = component_id.

    doc_id holds whole numbers and is meant to be unique. Rows that repeat one
    take part with their own texts: an id doesn't tie different texts together,
    and each row gets its own text's component. A row without a doc_id is
    linked with nothing: component_id null, kept. Only doc_id and text are read.
    """
    kind = docs.schema["doc_id"].dataType
    return _groups(docs, words, percent).select(F.col("d").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"),
                                                F.col("component").cast(kind).alias("component_id"), "kept")


def without_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows that near_groups() doesn't keep; columns as
    they were. A row goes by its doc_id and text, so that of rows with one id
    only copies go. Of a group all rows with its smallest id stay, as do rows
    without an id, a text or words."""
    gone = _groups(docs, words, percent).filter("NOT kept").select(F.col("d").alias("__gone_id"), F.col("row").alias("__gone_text"))
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["__gone_id"]) & (F.xxhash64(docs["text"]) == gone["__gone_text"]), "left_anti")
