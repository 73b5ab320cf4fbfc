"""A10: table scans of layer tables and driver tables (Parquet)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


_READS: dict[tuple[int, str], DataFrame] = {}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables. Timestamps stay ``timestamp_ntz``
    as stored, so range predicates on them are pushed to the Parquet scan;
    cast explicitly where a zoned timestamp is needed.

    The tables are read-only, so the scan (a plan, not data) is memoised per
    session: a query that reads lineitem three times lists and opens the
    file footer once."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (id(spark), path)
    df = _READS.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _READS[key] = df
    return df


def read_table(spark: SparkSession, root: str, layer: str, name: str,
               where=None, columns: list[str] | None = None) -> DataFrame:
    """A layer table with an optional predicate and projection; both reach the
    Parquet scan (pushed filters, pruned read schema)."""
    df = spark.read.parquet(os.path.join(root, layer, name))
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df
