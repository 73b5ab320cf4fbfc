"""Star schema: fact build (C11, J1-J4, G2, H13), dimensions (C10), score
breakdown (G3) and rule validation (G10).

The fact is ONE logical plan: NVD left-joined to four lookups, each reduced to
at most one row per CVE first, so every join is a key-to-key join on
``cve_id`` (no fan-out, no skew on the probe side). The joins are not hinted:
AQE broadcasts a side only after measuring it at runtime below
``spark.sql.autoBroadcastJoinThreshold``; larger sides stay sort-merge joins,
which all share the ``cve_id`` hash partitioning of the NVD side.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatspark.functions.strings import decimal_text
from threatspark.functions.casts import tolerant_int
from threatspark.plans import feeds
from threatspark.plans.rules import (COLLECTIONS, SourceShape, score_addend, score_expr,
                                     score_rules, threat_rules, threat_value)

DEFAULT_RUN_TS = _dt.datetime(2024, 6, 1, 0, 0, 0)


# ---------------------------------------------------------------- lookups

def exploit_lookup(exploits: DataFrame, only: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """One exploit per code, the newest (date_published, id) winning.
    ``explode`` skips null or empty code lists (Q6). ``only``: the codes to
    look up (cve_id); all if None. The winner is found by its order and id
    alone (a key of ``exploits``); the other columns join one row per code,
    in ``tasks`` tasks (None: as many as the planner chooses)."""
    x = exploits.select(F.explode("codes").alias("code"), "date_published", "id")
    if only is not None:
        x = x.join(only.select(F.col("cve_id").alias("code")), "code", "left_semi")
    best = _newest(x, "code", "date_published", tolerant_int(F.col("id")), "id")
    body = exploits.drop("codes")
    if tasks is not None:
        best, body = best.repartition(tasks, "id"), body.repartition(tasks, "id")
    return best.join(body, "id", "left").select("code", *[c for c in exploits.columns if c != "codes"])


def module_lookup(modules: DataFrame, refs: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """One module per CVE reference (case-sensitive 'CVE-' prefix, Q21),
    the newest (mod_time, fullname) winning. ``refs`` is the long form
    (fullname, ref); without it the ``references`` array is exploded. ``only``:
    the CVEs to look up. As in J3, the body joins the winners alone."""
    body = modules.drop("references") if "references" in modules.columns else modules
    if refs is None:
        refs = modules.select("fullname", "mod_time", F.explode("references").alias("ref"))
    cve_refs = refs.filter(F.col("ref").startswith("CVE-"))
    if only is not None:
        cve_refs = cve_refs.join(only.select(F.col("cve_id").alias("ref")), "ref", "left_semi")
    if "mod_time" not in cve_refs.columns:
        cve_refs = cve_refs.select("fullname", "ref").join(body.select("fullname", "mod_time"), "fullname")
    best = _newest(cve_refs, "ref", "mod_time", F.lit(0), "fullname")
    return best.join(body, "fullname").select("ref", *body.columns)


def _newest(rows: DataFrame, by: str, newest: str, number: Column, name: str) -> DataFrame:
    """(by, name): per ``by`` the name that is greatest by (newest, number, name), nulls lowest."""
    return rows.groupBy(by).agg(F.max(F.struct(F.col(newest).alias("a"), number.alias("b"), F.col(name).alias("c"))).alias("w")).select(by, F.col("w.c").alias(name))


# ---------------------------------------------------------------- fact (C11)

def _needed_fields(alias: str) -> list[str]:
    out: list[str] = []
    for r in threat_rules():
        if r.source == alias and r.field not in out:
            out.append(r.field)
    for r in score_rules():
        if r.source == alias and r.kind in ("value", "cvss"):
            for f in list(r.fields) + (["metrics"] if r.kind == "cvss" else []):
                if f not in out:
                    out.append(f)
    return out


def _side(df: DataFrame, key: str, alias: str, shape: SourceShape) -> DataFrame:
    fields = [f for f in _needed_fields(alias) if f in df.columns] or [key]
    packed = df.select(F.col(key).alias("cve_id"), F.struct(*fields).alias(alias))
    shape.schemas[alias] = packed.schema[alias].dataType
    return packed


def joined_sources(nvd: DataFrame, kev: DataFrame, epss: DataFrame,
                   exploits_by_code: DataFrame, modules_by_ref: DataFrame) -> tuple[DataFrame, SourceShape]:
    """NVD (F9: non-empty id) left-joined to the four one-row-per-CVE lookups."""
    shape = SourceShape()
    base = _side(nvd.filter(F.length("cve_id") > 0), "cve_id", "NVD", shape)
    j = (base
         .join(_side(kev, "cve_id", "CISA", shape), "cve_id", "left")
         .join(_side(epss, "cve", "EPSS", shape), "cve_id", "left")
         .join(_side(exploits_by_code, "code", "ExploitDB", shape), "cve_id", "left")
         .join(_side(modules_by_ref, "ref", "Metasploit", shape), "cve_id", "left"))
    return j, shape


def rules_text() -> str:
    """The registered rules, to tell whether a fact was built by other ones."""
    return hashlib.md5(repr([threat_rules(), score_rules()]).encode()).hexdigest()


def threats_expr(shape: SourceShape) -> Column:
    """One struct field per threat rule, falsy values as null."""
    return F.struct(*[threat_value(r, shape).alias(r.key) for r in threat_rules()])


def build_fact(nvd: DataFrame, kev: DataFrame, epss: DataFrame, exploits_by_code: DataFrame,
               modules_by_ref: DataFrame, run_ts: _dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    """fct_final: cve_id, vrr_score, threats, date_added (one row per NVD CVE)."""
    j, shape = joined_sources(nvd, kev, epss, exploits_by_code, modules_by_ref)
    return j.select("cve_id", score_expr(shape).alias("vrr_score"),
                    threats_expr(shape).alias("threats"),
                    F.lit(run_ts).cast("timestamp").alias("date_added"))


@feeds.memo_plan
def fact_from_feeds(spark: SparkSession, sf_dir: str,
                    run_ts: _dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    return build_fact(
        feeds.feed_nvd(spark, sf_dir), feeds.feed_kev(spark, sf_dir), feeds.feed_epss(spark, sf_dir),
        exploit_lookup(feeds.feed_exploit(spark, sf_dir), tasks=feeds.line_tasks(spark, sf_dir)),
        module_lookup(feeds.feed_modules(spark, sf_dir), feeds.feed_module_refs(spark, sf_dir)),
        run_ts)


@feeds.memo_plan
def addends_from_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cve_id plus one decimal addend column per score rule (G3 input)."""
    j, shape = joined_sources(
        feeds.feed_nvd(spark, sf_dir), feeds.feed_kev(spark, sf_dir), feeds.feed_epss(spark, sf_dir),
        exploit_lookup(feeds.feed_exploit(spark, sf_dir)),
        module_lookup(feeds.feed_modules(spark, sf_dir), feeds.feed_module_refs(spark, sf_dir)))
    return j.select("cve_id", *[score_addend(r, shape).alias(r.name) for r in score_rules()])


# ---------------------------------------------------------------- flat views

def flat_threats(fact: DataFrame) -> DataFrame:
    """Threat struct as scalar columns: arrays joined with '|', numbers as text."""
    st = fact.schema["threats"].dataType
    cols = []
    for f in st.fields:
        c = F.col("threats")[f.name]
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, T.DecimalType):
            c = decimal_text(c)
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return fact.select("cve_id", *cols)


def threats_map(threats: Column, struct_type: T.StructType) -> Column:
    """Threat struct -> map<string, array<string>> without null entries, the
    report-side form (scalars become one-element arrays, Q15: all text)."""
    entries = []
    for f in struct_type.fields:
        c = threats[f.name]
        if isinstance(f.dataType, T.ArrayType):
            v = F.transform(c, lambda x: x.cast("string"))
        elif isinstance(f.dataType, T.DecimalType):
            v = F.array(decimal_text(c))
        else:
            v = F.array(c.cast("string"))
        entries.append(F.when(c.isNotNull(), F.struct(F.lit(f.name).alias("key"), v.alias("value"))))
    arr = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return F.map_from_entries(arr)


# ---------------------------------------------------------------- dims

def dim_threats(spark: SparkSession, run_ts: _dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    rows = [(r.category, r.name, [r.field], COLLECTIONS[r.source], run_ts) for r in threat_rules()]
    return spark.createDataFrame(rows, "category string, name string, field array<string>, "
                                       "source_collection string, date_added timestamp")


def dim_vrr(spark: SparkSession, run_ts: _dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    rows = [(r.category, r.name, list(r.fields), float(r.weight), COLLECTIONS[r.source], run_ts)
            for r in score_rules()]
    return spark.createDataFrame(rows, "category string, name string, field array<string>, "
                                       "weight double, source_collection string, date_added timestamp")


def score_breakdown(addends: DataFrame, dims: DataFrame) -> DataFrame:
    """Per factor, how many CVEs it adds to and the points it adds."""
    names = [c for c in addends.columns if c != "cve_id"]
    long = addends.unpivot("cve_id", names, "name", "points")
    per = long.groupBy("name").agg(
        F.count_if(F.col("points") > 0).alias("n_cves"),
        F.sum("points").cast("double").alias("total_points"))
    return dims.select("category", "name", "weight", "source_collection").join(per, "name", "left")


def validate_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """For every (source, field) of every rule, the number of rows in
    the source table holding a value. One aggregation pass per table."""
    wanted: dict[str, list[str]] = {}
    for r in threat_rules():
        wanted.setdefault(r.source, []).append(r.field)
    for r in score_rules():
        wanted.setdefault(r.source, []).extend(r.fields)
    parts = []
    for alias, fields in wanted.items():
        df = tables[alias]
        uniq = list(dict.fromkeys(fields))
        aggs = [(F.count(F.col(f)) if f in df.columns else F.lit(0).cast("long")).alias(f) for f in uniq]
        counts = df.agg(*aggs)
        parts.append(counts.select(F.lit(alias).alias("source"),
                                   F.explode(F.array(*[F.struct(F.lit(f).alias("field"),
                                                                F.col(f).alias("n_rows")) for f in uniq]))
                                   .alias("x")).select("source", "x.field", "x.n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_rules_valid(tables: dict[str, DataFrame]) -> None:
    """Raise with the full list when any rule field is missing everywhere."""
    missing = validate_rules(tables).filter("n_rows = 0").collect()  # small: one row per rule field
    if missing:
        lines = [f"field '{r['field']}' (source {r['source']}) missing in all rows" for r in missing]
        raise ValueError("rule fields missing: " + "; ".join(lines))
