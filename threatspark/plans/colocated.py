"""J1-J4 without a shuffle: the fact's five inputs, each at most one row per
CVE, stored as tables of equal bucket counts, bucketed and sorted by CVE.

The work that moves rows (the newest exploit and module per CVE) is done once,
when the tables are written; a fact from them, say after a change of rules,
reads bucket against bucket. The tables hold the columns that rules may read,
not only those of the present rules.

A folder holds one version, with its bucket count in its name; it is written
anew, never changed. The session's catalog needs to know the tables only while
a session uses them: ``colocated`` registers a folder's tables again.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatspark.plans import fact as fact_mod

ROWS_PER_BUCKET = 100_000  # CVEs whose rows of all five tables one task sorts for the join

# The five inputs and their key columns, as build_fact takes them.
SIDES = {"nvd": "cve_id", "cisa": "cve_id", "epss": "cve", "exploits_by_code": "code", "modules_by_ref": "ref"}


def _name(root: str, side: str) -> str:
    return f"colocated_{hashlib.md5(root.encode()).hexdigest()[:16]}_{side}"


def store_colocated(spark: SparkSession, nvd: DataFrame, cisa: DataFrame, epss: DataFrame, exploits: DataFrame,
                    modules: DataFrame, refs: DataFrame | None, root: str, buckets: int | None = None,
                    tasks: int | None = None) -> str:
    """Writes the five tables below ``root`` and returns their folder.
    ``buckets``: one per ROWS_PER_BUCKET CVEs of ``nvd`` if None. Rows without
    a CVE are left out, as no CVE joins them. ``tasks``: as exploit_lookup takes them."""
    if buckets is None:
        buckets = max(1, -(-nvd.count() // ROWS_PER_BUCKET))
    folder = f"{root.rstrip('/')}/buckets-{buckets}"
    sides = zip(SIDES.items(), (nvd, cisa, epss, fact_mod.exploit_lookup(exploits, tasks=tasks), fact_mod.module_lookup(modules, refs)))
    for (side, key), df in sides:
        # dealt out as the buckets are, so that one task writes one file of one bucket
        (df.filter(F.length(key) > 0).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
         .format("parquet").option("path", f"{folder}/{side}").saveAsTable(_name(folder, side)))
    return folder


def colocated(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a folder that store_colocated returned, in any session."""
    buckets = int(folder.rsplit("-", 1)[1])
    out = {}
    for side, key in SIDES.items():
        name, path = _name(folder, side), f"{folder}/{side}"
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} ({spark.read.parquet(path).schema.toDDL()}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        out[side] = spark.table(name)
    return out


def fact_colocated(spark: SparkSession, folder: str, run_ts: _dt.datetime = fact_mod.DEFAULT_RUN_TS) -> DataFrame:
    """C11 from the stored tables: the plan has no exchange but the broadcasts
    that the planner chooses for small sides."""
    return fact_mod.build_fact(**{("kev" if side == "cisa" else side): df for side, df in colocated(spark, folder).items()}, run_ts=run_ts)
