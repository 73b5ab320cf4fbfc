"""Array / map / struct column functions.

Functions that accept both the raw (struct) and the flattened (string) form
of a field decide at plan time from the column's data type, so the compiled
expression stays a single native Column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatspark.functions.casts import CVSS_DECIMAL

# Fixed values that must equal the reference's for right results.
METRIC_KEYS = ["cvssMetricV2", "cvssMetricV30", "cvssMetricV31", "cvssMetricV40"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def english_values(descs) -> Column:
    """H1: values of the elements whose lang is 'en'."""
    return F.transform(F.filter(_c(descs), lambda x: x["lang"] == "en"),
                       lambda x: x["value"])


def pluck(arr, field: str) -> Column:
    """H2: one field of every struct in an array."""
    return F.transform(_c(arr), lambda x: x[field])


def first_descriptions(weaknesses) -> Column:
    """H3: first description value of every weakness that has one (any language)."""
    w = F.filter(_c(weaknesses), lambda x: F.size(x["description"]) > 0)
    return F.transform(w, lambda x: x["description"][0]["value"])


def non_empty_metrics(metrics) -> Column:
    """H4: drop metric types whose list is empty."""
    return F.map_filter(_c(metrics), lambda k, v: F.size(v) > 0)


def metric_columns(metrics) -> list[Column]:
    """H4: the known metric types as ``metrics_<type>`` columns."""
    m = non_empty_metrics(metrics)
    return [F.try_element_at(m, F.lit(k)).alias(f"metrics_{k}") for k in METRIC_KEYS]


def _field_type(schema: T.StructType, name: str) -> T.DataType | None:
    return schema[name].dataType if name in schema.fieldNames() else None


def _get(root: Column | None, name: str) -> Column:
    return F.col(name) if root is None else root[name]


def cvss_base(schema: T.StructType, flat: str = "metrics_cvssMetricV31",
              nested: str = "metrics", key: str = "cvssMetricV31",
              root: Column | None = None) -> Column:
    """H7: first v3.1 base score; nested map as fallback when the flat list is
    missing or empty; 0 otherwise. Result is decimal(4,1)."""
    cands = []
    if _field_type(schema, flat) is not None:
        lst = _get(root, flat)
        cands.append(F.when(F.size(lst) > 0, F.get(lst, 0)["cvssData"]["baseScore"]))
    if isinstance(_field_type(schema, nested), T.MapType):
        lst2 = F.try_element_at(_get(root, nested), F.lit(key))
        cands.append(F.when(F.size(lst2) > 0, F.get(lst2, 0)["cvssData"]["baseScore"]))
    if not cands:
        return F.lit(0).cast(CVSS_DECIMAL)
    # The fallback is taken only when the flat list is absent or empty.
    first = cands[0]
    val = first if len(cands) == 1 else F.when(
        F.size(_get(root, flat)) > 0, cands[0]).otherwise(cands[1])
    return F.coalesce(val.cast("double").try_cast(CVSS_DECIMAL), F.lit(0).cast(CVSS_DECIMAL))


def url_list(schema: T.StructType, field: str, subkey: str = "url",
             root: Column | None = None) -> Column:
    """H8: structs' ``subkey`` when truthy; plain strings are kept for 'url'."""
    dt = _field_type(schema, field)
    col = _get(root, field)
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        vals = F.transform(col, lambda x: x[subkey])
    elif isinstance(dt, T.ArrayType) and subkey == "url":
        vals = col
    elif isinstance(dt, T.ArrayType):
        vals = F.filter(col, lambda x: F.lit(False))
    else:
        return F.array().cast("array<string>")
    return F.filter(vals, lambda x: x.isNotNull() & (x != ""))


def cwe_list(schema: T.StructType, field: str, root: Column | None = None) -> Column:
    """H9: English descriptions of struct weaknesses, plain strings as they are."""
    dt = _field_type(schema, field)
    col = _get(root, field)
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        return F.flatten(F.transform(col, lambda w: english_values(w["description"])))
    if isinstance(dt, T.ArrayType):
        return col
    return F.array().cast("array<string>")


def first_truthy(*cols) -> Column:
    """First non-null, non-empty of several text columns."""
    return F.coalesce(*[F.when(_c(c) != "", _c(c)) for c in cols])


def path_col(df: DataFrame, path: str) -> Column:
    """H6: dotted path into nested columns; numeric parts index arrays;
    the word TRUE is a constant true. Missing parts give null."""
    if path == "TRUE":
        return F.lit(True)
    parts = path.split(".")
    dt: T.DataType = df.schema
    col: Column | None = None
    for p in parts:
        if isinstance(dt, T.StructType) and p in dt.fieldNames():
            col = F.col(p) if col is None else col[p]
            dt = dt[p].dataType
        elif isinstance(dt, T.MapType):
            col = F.try_element_at(col, F.lit(p))
            dt = dt.valueType
        elif isinstance(dt, T.ArrayType) and p.isdigit():
            col = F.get(col, int(p))
            dt = dt.elementType
        else:
            return F.lit(None)
    return col
