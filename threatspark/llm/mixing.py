"""Operator 1: mixing sources to target weights by Pfair scheduling.

Each source's documents, in a pseudo-random order, form blocks. Of a source
with share a out of q (the sum of all shares), block i = 0, 1, ... may go out
from slot floor(i*q/a) on and is due before slot ceil((i+1)*q/a). Every slot
takes the released block with the earliest deadline, ties to the source first
by name. On one output this meets every deadline, so at any slot each source
has had less than one block more or less than its target.

The schedule repeats every q slots, so it is worked out once for q slots, and
a block's slot is arithmetic on its number. When a source runs out, the others
go on with their shares of the new sum: there are at most as many such phases
as sources. Only the table of sources (one row each) is ever brought together;
documents are ranked in hash buckets of bounded size. DataFrame and SQL
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DOCS = 16
BUCKET_DOCS = 5_000    # documents that one window sorts, on average
SEED = "mix-1"

# Target shares of the query's mix; a source not named gets 1.
SHARES = {"src0": 6, "src1": 3, "src2": 3, "src3": 2, "src4": 2}
DEFAULT_SHARE = 1

_NO_SOURCE = "\x00"  # stands for a null source, which is one of its own and sorts first


def order_key(seed: str = SEED) -> Column:
    """A 60-bit pseudo-random key: the first 15 hex digits of md5(seed + doc_id)."""
    text = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


# One step of the schedule of one period. `shares`: of the active sources (0 for the others), `q`: their sum; the
# state has the blocks that each source has had, and the source of every slot so far.
_STEP = """
struct(
  transform(st.done, (n, i) -> n + CAST(i = {pick} AS BIGINT)) AS done,
  concat(st.slots, array({pick})) AS slots)"""
_PICK = """
array_min(transform(sequence(0, size(shares) - 1), i -> CASE
  WHEN shares[i] > 0 AND st.done[i] < shares[i] AND (st.done[i] * q) DIV shares[i] <= t
  THEN struct(((st.done[i] + 1) * q + shares[i] - 1) DIV shares[i] AS due, i AS i) END)).i"""


def _period(shares: str) -> str:
    """SQL for the sources (by index) of the slots of one period."""
    step = _STEP.format(pick="p")
    return f"""
transform(array({shares}), shares -> transform(array(aggregate(shares, 0L, (x, y) -> x + y)), q ->
  aggregate(sequence(0L, q - 1),
    struct(transform(shares, x -> 0L) AS done, CAST(array() AS ARRAY<INT>) AS slots),
    (st, t) -> transform(array({_PICK}), p -> {step})[0],
    st -> st.slots))[0])[0]"""


# One phase: from the blocks left of each source to the phase's record. A source's block number b of a phase is at
# slot (b DIV a) * q + (place of the b mod a-th of its slots in the period).
_PHASE = """
transform(array(transform(left, (n, i) -> IF(n > 0, all_shares[i], 0L))), a ->
transform(array(aggregate(a, 0L, (x, y) -> x + y)), q ->
transform(array({period}), slots ->
transform(array(transform(a, (x, i) -> filter(transform(sequence(0, size(slots) - 1), j -> IF(slots[j] = i, CAST(j AS BIGINT), NULL)), v -> v IS NOT NULL))), places ->
transform(array(array_min(transform(a, (x, i) -> IF(x > 0, ((left[i] - 1) DIV x) * q + places[i][CAST((left[i] - 1) % x AS INT)] + 1, NULL)))), length ->
  struct(a AS shares, q AS q, places AS places, length AS length,
    transform(a, (x, i) -> IF(x > 0, (length DIV q) * x + size(filter(places[i], v -> v < length % q)), 0L)) AS sent)
)[0])[0])[0])[0])[0]"""


def phases(sources: DataFrame) -> DataFrame:
    """``sources``: source, share (long, at least 1), blocks (long, at least
    1). One row: names (sorted array) and an array of phases, each with the
    active shares by source, their sum q, each source's places in a period,
    the phase's length in slots and the blocks that each source sends."""
    phase = _PHASE.format(period=_period("a"))
    kind = "STRUCT<shares: ARRAY<BIGINT>, q: BIGINT, places: ARRAY<ARRAY<BIGINT>>, length: BIGINT, sent: ARRAY<BIGINT>>"
    one = sources.agg(F.sort_array(F.collect_list(F.struct("source", "share", "blocks"))).alias("s")).select(
        F.col("s.source").alias("names"), F.col("s.share").alias("all_shares"), F.col("s.blocks").alias("blocks"))
    return one.selectExpr("names", f"""
      CASE WHEN size(names) = 0 THEN CAST(array() AS ARRAY<{kind}>) ELSE aggregate(sequence(1, size(names)),
        struct(blocks AS left, CAST(array() AS ARRAY<{kind}>) AS phases),
        (z, k) -> IF(array_max(z.left) = 0, z,
          transform(array(z.left), left -> transform(array({phase}), ph ->
            struct(transform(left, (n, i) -> n - ph.sent[i]) AS left, concat(z.phases, array(ph)) AS phases))[0])[0]),
        z -> z.phases) END AS phases""")


def _plan(docs: DataFrame, share: Column, block_docs: int) -> DataFrame:
    """One row: a map from source to its phases (first own block, blocks, first slot, share, q, places)."""
    sources = docs.groupBy(F.col("__source").alias("source")).agg(F.count("*").alias("n")).select(
        "source", share.cast("long").alias("share"), F.ceil(F.col("n") / block_docs).cast("long").alias("blocks"))
    starts = phases(sources).selectExpr("names", "phases", """
      transform(sequence(0, size(phases)), k -> aggregate(slice(phases, 1, k), 0L, (x, p) -> x + p.length)) AS at""")
    return starts.selectExpr("""
      map_from_arrays(names, transform(names, (name, i) -> filter(transform(phases, (p, k) -> struct(
        k AS phase,
        aggregate(slice(phases, 1, k), 0L, (x, o) -> x + o.sent[i]) AS first_block,
        p.sent[i] AS blocks, at[k] AS first_slot, p.shares[i] AS share, p.q AS q, p.places[i] AS places)),
        p -> p.blocks > 0))) AS plan""")


def _share(shares: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, share in shares.items():
        out = F.when(F.col("source") == name, F.lit(share)).otherwise(out)
    return out


def mix(docs: DataFrame, shares: dict[str, int] = SHARES, default_share: int = DEFAULT_SHARE,
        block_docs: int = BLOCK_DOCS, seed: str = SEED) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, source, ...) and: block (the
    document's block within its source, from 0), phase, slot (the block's
    place in the mix, from 0) and seat (the document's place in its block).
    Ordered by slot and seat, the rows are the mix. Columns of these names are
    replaced.

    Shares are positive whole numbers; the number of sources and the sum of
    shares are small (their product bounds the schedule). No row is dropped or
    repeated: sources that run out leave the mix. Within a source the order is
    by md5 of seed and doc_id, then doc_id and the other columns that can be
    sorted; equal rows take the next seats in any order. A null source is a
    source of its own, a null doc_id an empty text. An empty table gives an
    empty mix.
    """
    own = ["block", "phase", "slot", "seat"]
    columns = [c for c in docs.columns if c not in own]
    if any(s < 1 for s in [*shares.values(), default_share]):
        raise ValueError("shares are positive whole numbers")
    base = docs.select(*columns, F.coalesce("source", F.lit(_NO_SOURCE)).alias("__source"), order_key(seed).alias("__key"))
    narrow = docs.select("doc_id", F.coalesce("source", F.lit(_NO_SOURCE)).alias("__source"), order_key(seed).alias("__key"))
    # Buckets are ranges of the key, so ranks run on from one bucket to the next.
    total = narrow.agg(F.count("*").alias("n")).select(F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET_DOCS)).alias("n")).scalar()

    def bucketed(df: DataFrame) -> DataFrame:
        return df.withColumn("__bucket", F.floor(F.col("__key") / F.lit(float(1 << 60)) * total))

    counts = bucketed(narrow).groupBy("__source", "__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__source", "__bucket", F.coalesce(before, F.lit(0)).alias("__before"))
    ties = [F.col(c) for c, kind in docs.dtypes if c in columns and not kind.startswith(("map", "variant", "array", "struct")) and c != "text"]
    rank = F.row_number().over(Window.partitionBy("__source", "__bucket").orderBy("__key", *ties))
    ranked = bucketed(base).withColumn("__rank", rank).join(offsets, ["__source", "__bucket"])
    at = F.col("__before") + F.col("__rank") - 1
    plan = _plan(narrow, _share(shares, default_share), block_docs).scalar()
    numbered = ranked.withColumn("block", F.floor(at / block_docs).cast("long")).withColumn("seat", (at % block_docs).cast("int"))
    numbered = numbered.withColumn("__phases", F.element_at(plan, F.col("__source")))
    phase = F.filter("__phases",
                     lambda p: (F.col("block") >= p["first_block"]) & (F.col("block") < p["first_block"] + p["blocks"]))[0]
    placed = numbered.withColumn("__phase", phase)
    i = F.col("block") - F.col("__phase.first_block")
    share = F.col("__phase.share")
    slot = (F.col("__phase.first_slot") + F.floor(i / share) * F.col("__phase.q")
            + F.element_at("__phase.places", (i % share + 1).cast("int")))
    return placed.select(*columns, "block", F.col("__phase.phase").cast("int").alias("phase"), slot.cast("long").alias("slot"), "seat")
