"""Operator 13: invertible Bloom lookup sketches of documents' paragraphs.

A paragraph is a stretch of a line up to a sentence's end, of at least
PARAGRAPH code points if the line has as many. Its digest goes into one cell
of each of three sub-tables; a cell keeps a count, the digests' XOR and their
check values' XOR. Subtracting two versions' sketches cell by cell cancels
what they share. A cell left with one digest is pure: the digest is read off
and taken out of its other cells, which makes more cells pure, until nothing
is left and the differing digests are known on each side. A sketch too small
for its difference gets stuck and is tried again with more cells, up to GROWTH
times as many: several sketches of the same size, between which a hash of the
digest chooses. Those of them that get stuck grow again, until none does.

DataFrame functions only. Documents are dealt into ranges of ids, so a text
moves once, to be beside its successor's. A sketch has a fixed size, so it is
built, subtracted and peeled within its row, and retries need no exchange.

A fingerprint stands for the set of a text's paragraphs: equal texts have
equal fingerprints, and neither order nor repeats count. Null counts as empty;
two empty texts are alike (1.0). Rows follow each other by descending id, null
ids last and equal ids by the hash of the text; rows with equal ids stay
separate documents. Other columns aren't read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatspark.llm.shared import stored

PARAGRAPH = 80
SUB_TABLES = 3
CELLS = 4                  # cells of a sub-table
GROWTH = 16                # a stuck sketch is tried again as so many at most, ...
LOAD = 4                   # with so many digests of both sides in each
TRIES = 4                  # sizes tried in one job
RANGE_ROWS = 500           # documents of a range of ids, ...
RANGES = 10_000            # unless that makes more ranges than this

# Fixed values of the check value: two primes below 2**31 and two multipliers.
_PRIMES, _FACTORS = (2147483629, 2147483647), (1000003, 7368787)

#: A paragraph; the pieces of a text, put together, are the text.
PATTERN = rf"[^\n]{{{PARAGRAPH}}}[^\n.!?]*[.!?\n]*|[^\n]+\n*|\n+"


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))


def digests(text: Column) -> Column:
    """Distinct 60-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.conv(F.substring(F.md5(p), 1, 15), 16, 10).cast("long")))


def check_value(key: Column) -> Column:
    """A 31-bit value of a digest that XOR doesn't carry over."""
    return ((key % _PRIMES[0]) * _FACTORS[0] + F.shiftright(key, 31) * _FACTORS[1]) % _PRIMES[1]


def _places(key: Column, level: int) -> list[Column]:
    """The numbers of a digest's cells, one in each sub-table. The fingerprint's own cells are bits of the digest."""
    if level == 0:
        return [(F.shiftright(key, 20 * t) % CELLS + CELLS * t).cast("int") for t in range(SUB_TABLES)]
    return [(F.pmod(F.xxhash64(key, F.lit(SUB_TABLES * level + t)), F.lit(CELLS)) + CELLS * t).cast("int") for t in range(SUB_TABLES)]


def _with(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _zero() -> Column:
    return F.lit(0).cast("long")


def _xor(total: Column, x: Column) -> Column:
    return total.bitwiseXOR(x)


def sketch(keys: Column, level: int = 0) -> Column:
    """Cells (at, n, k, c): number, count, digests, check values."""
    def cells(known: Column) -> Column:
        own = lambda i: F.filter(known, lambda x: x[f"p{i // CELLS}"] == i)
        held = F.array(*[F.struct(F.lit(i).alias("at"), own(i).alias("x")) for i in range(SUB_TABLES * CELLS)])
        return F.transform(held, lambda o: F.struct(
            o["at"].alias("at"), F.size(o["x"]).cast("long").alias("n"), F.aggregate(o["x"], _zero(), lambda s, x: _xor(s, x["k"])).alias("k"),
            F.aggregate(o["x"], _zero(), lambda s, x: _xor(s, x["c"])).alias("c")))

    known = F.transform(keys, lambda k: F.struct(k.alias("k"), check_value(k).alias("c"), *[p.alias(f"p{t}") for t, p in enumerate(_places(k, level))]))
    return _with(known, cells)


def fingerprint(keys: Column) -> Column:
    """A sketch as text: `n:keys:checks` of each cell in hexadecimal digits, cells set apart by blanks."""
    return F.array_join(F.transform(sketch(keys), lambda c: F.lower(F.concat_ws(":", F.hex(c["n"]), F.hex(c["k"]), F.hex(c["c"])))), " ")


# ------------------------------------------------------------ versions

def _ranges(docs: DataFrame) -> tuple[Column, int]:
    """The number of the range of ids that a row belongs to; null ids have the
    lowest. At most RANGES bounds reach the driver."""
    n = docs.count()
    many = min(RANGES, -(-n // RANGE_ROWS))
    if many < 2:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0), many
    listed = lambda values, end: F.expr("array(" + ",".join(f"{v}{end}" for v in values) + ")")
    shares = listed([i / many for i in range(1, many)], "D")
    found = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10 * many)).alias("b")).first()["b"] or []
    bounds = sorted(set(found))
    if not bounds:  # null ids only
        return F.lit(-1), many
    step = max(1, int(len(bounds) ** 0.5))
    tops, all_ = listed(bounds[::step], "L"), listed(bounds, "L")
    coarse = F.size(F.filter(tops, lambda b: b <= F.col("doc_id")))       # bounds at or below, by steps
    fine = F.size(F.filter(F.slice(all_, (coarse - 1) * step + 1, step), lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), -1).when(coarse == 0, 0).otherwise((coarse - 1) * step + fine), many


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and digests of every document and of the next one by
    descending id (after the last: the first), texts null as empty."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    part, _ = _ranges(docs)
    rows = docs.withColumn("part", part).withColumn("order", F.xxhash64("text"))
    heads = (rows.groupBy("part").agg(F.max(F.struct("doc_id", "order")).alias("h"))
             .select("part", "h.doc_id", "h.order").orderBy(F.col("part").desc()).collect())  # one row per range: RANGES at most
    follows = [(a["part"], b["doc_id"], b["order"]) for a, b in zip(heads, heads[1:] + heads[:1])]
    after = spark.createDataFrame(follows, "after int, doc_id long, order long")
    r, a = rows.alias("r"), F.broadcast(after).alias("a")  # RANGES rows at most
    edge = (r.join(a, F.col("r.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("r.order") == F.col("a.order")))
            .select(F.col("a.after").alias("part"), "text").distinct()
            .select("part", F.col("text").alias("head_text")))
    by = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), F.col("order").desc())
    near = rows.withColumn("keys", digests(F.col("text"))).withColumn("next_text", F.lead("text").over(by)).withColumn("next_keys", F.lead("keys").over(by))
    out = near.join(edge, "part", "left")
    return (out.withColumn("next_keys", F.coalesce("next_keys", digests(F.col("head_text"))))
            .withColumn("next_text", F.coalesce("next_text", "head_text")).drop("part", "order", "head_text"))


def edited(text: Column, other: Column) -> Column:
    """The text, its last floor(n / 2) code points replaced by the first as many of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def versions(docs: DataFrame) -> DataFrame:
    """Every document with its edited text's hash and the digests of its text,
    its edited text and the next document, under a number of its own; stored."""
    own = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return stored(own.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "keys", digests(F.col("edited")).alias("edited_keys"), "next_keys"), "fingerprint-versions")


# ------------------------------------------------------------ subtraction and peeling

def _cell(old: Column, n: Column, k: Column, c: Column) -> Column:
    return F.struct(old["at"].alias("at"), (old["n"] - n).alias("n"), _xor(old["k"], k).alias("k"), _xor(old["c"], c).alias("c"))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x, y["n"], y["k"], y["c"]))


def peel(cells: Column, level: int = 0) -> Column:
    """(cells, left, right): takes out the digest of one pure cell after
    another and counts those of either side. What is left over isn't empty if
    the sketch was too small."""
    pure = lambda c: (F.abs(c["n"]) == 1) & (c["c"] == check_value(c["k"]))

    def take(state: Column, one: Column) -> Column:
        held = F.struct(one["n"].alias("n"), one["k"].alias("k"), one["c"].alias("c"), F.array(*_places(one["k"], level)).alias("at"))
        rest = _with(held, lambda h: F.transform(state["cells"], lambda c: F.when(F.array_contains(h["at"], c["at"]), _cell(c, h["n"], h["k"], h["c"])).otherwise(c)))
        return F.struct(rest.alias("cells"), (state["left"] + (one["n"] == 1).cast("long")).alias("left"),
                        (state["right"] + (one["n"] == -1).cast("long")).alias("right"), F.lit(True).alias("goes_on"))

    def step(state: Column, _: Column) -> Column:
        stop = F.struct(state["cells"].alias("cells"), state["left"].alias("left"), state["right"].alias("right"), F.lit(False).alias("goes_on"))
        found = lambda x: F.when(F.size(x) > 0, take(state, F.element_at(x, 1))).otherwise(stop)
        return F.when(state["goes_on"], _with(F.filter(state["cells"], pure), found)).otherwise(state)

    start = F.struct(cells.alias("cells"), _zero().alias("left"), _zero().alias("right"), F.lit(True).alias("goes_on"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SUB_TABLES * CELLS)), start, step)


def _tried(pairs: DataFrame, level: int) -> DataFrame:
    """Adds ``left`` and ``right``, null where the sketches of this level's size get stuck."""
    done = peel(subtract(sketch(F.col("a"), level), sketch(F.col("b"), level)), level)
    cell = "struct<at:int,n:bigint,k:bigint,c:bigint>"
    none = F.lit(None).cast(f"struct<cells:array<{cell}>,left:bigint,right:bigint,goes_on:boolean>")
    out = pairs.select("pair", "a", "b", F.when(F.size("a") + F.size("b") > 0, done).otherwise(none).alias("done"))
    clear = F.coalesce(F.forall("done.cells", lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0)), F.lit(True))
    of = lambda side: F.coalesce(F.col(f"done.{side}"), F.lit(0)).alias(side)
    return out.select("pair", "a", "b", clear.alias("clear"), of("left"), of("right")).select(
        "pair", *[F.when(~F.col("clear"), F.col(x)).alias(x) for x in ("a", "b")], *[F.when(F.col("clear"), F.col(x)).alias(x) for x in ("left", "right")])


def _split(tried: DataFrame, level: int) -> DataFrame:
    """Stuck rows become several, each with the digests that a hash sends there."""
    many = F.least(F.lit(GROWTH), F.greatest(F.lit(2), F.ceil((F.size("a") + F.size("b")) / LOAD))).cast("int")
    part = lambda keys, n, g: F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(-level)), n) == g)
    parts = _with(many, lambda n: F.transform(F.sequence(F.lit(0), n - 1), lambda g: F.struct(part(F.col("a"), n, g).alias("a"), part(F.col("b"), n, g).alias("b"))))
    stuck = F.filter(parts, lambda x: F.size(x["a"]) + F.size(x["b"]) > 0)
    none = F.lit(None).cast("array<struct<a:array<bigint>,b:array<bigint>>>")
    out = tried.select("pair", "left", "right", F.explode_outer(F.when(F.col("left").isNull(), stuck).otherwise(none)).alias("x"))
    return out.select("pair", "left", "right", "x.a", "x.b")


def _next_size(rows: DataFrame, level: int) -> DataFrame:
    """Tries the rows that _split made; settled rows pass."""
    new = _tried(rows.select(F.struct("pair", "left", "right").alias("pair"), F.coalesce("a", F.array().cast("array<bigint>")).alias("a"),
                             F.coalesce("b", F.array().cast("array<bigint>")).alias("b")), level)
    was = F.col("pair.left").isNotNull()
    return new.select("pair.pair", "a", "b", F.when(was, F.col("pair.left")).otherwise(F.col("left")).alias("left"),
                      F.when(was, F.col("pair.right")).otherwise(F.col("right")).alias("right"))


def differences(pairs: DataFrame) -> DataFrame:
    """(pair, left, right): how many digests only ``a`` and only ``b`` of a pair
    hold. ``pairs``: a unique number, and the distinct digests ``a`` and ``b``.
    TRIES sizes are one pass; the few pairs that are still stuck are stored
    and go on from there."""
    open_, done, level = pairs, [], 0
    while True:
        rows = _tried(open_, level)
        for _ in range(TRIES - 1):
            level += 1
            rows = _next_size(_split(rows, level), level)
        rows = stored(rows, f"fingerprint-tried-{level}")
        done.append(rows.filter(F.col("left").isNotNull()).select("pair", "left", "right"))
        open_ = rows.filter(F.col("left").isNull())
        if open_.isEmpty():
            break
        level += 1
        open_ = _split(open_, level).select("pair", "a", "b")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.groupBy("pair").agg(F.sum("left").alias("left"), F.sum("right").alias("right"))


def likeness(n_a: Column, n_b: Column, only_a: Column, only_b: Column) -> Column:
    """Twice the shared paragraphs over all paragraphs; 1 for two empty texts."""
    return F.when(n_a + n_b == 0, 1.0).otherwise((n_a + n_b - only_a - only_b) / (n_a + n_b))


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, how alike they
    are, and how alike the document and the next one are; with the numbers of
    paragraphs that differ."""
    own = versions(docs)
    pairs = own.select(F.explode(F.array(
        F.struct((F.col("row") * 2).alias("pair"), F.col("keys").alias("a"), F.col("edited_keys").alias("b")),
        F.struct((F.col("row") * 2 + 1).alias("pair"), F.col("keys").alias("a"), F.col("next_keys").alias("b")))).alias("x")).select("x.*")
    other = F.col("pair") % 2 == 1
    pick = lambda n, of: F.max(F.when(of, F.col(n)))
    apart = differences(pairs).groupBy(F.shiftright("pair", 1).alias("row")).agg(
        pick("left", ~other).alias("left_edited"), pick("right", ~other).alias("right_edited"),
        pick("left", other).alias("left_next"), pick("right", other).alias("right_next"))
    out = own.join(apart, "row", "left")
    n = {k: F.size(k) for k in ("keys", "edited_keys", "next_keys")}
    differ = [F.coalesce(c, F.lit(0)).alias(c) for c in ("left_edited", "right_edited", "left_next", "right_next")]
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("keys")).alias("fingerprint"), fingerprint(F.col("edited_keys")).alias("edited_fingerprint"),
                      likeness(n["keys"], n["edited_keys"], differ[0], differ[1]).alias("near_edited"),
                      likeness(n["keys"], n["next_keys"], differ[2], differ[3]).alias("near_next"), *differ)
