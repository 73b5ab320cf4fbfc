"""Gold layer: column-configurable mirror (B11-B13, C3) and the long-format
factor table (C12, H6, H12, S3, X4)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.functions.nested import first_truthy, path_col


def mirror(df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = (),
           manual: dict | None = None, keys: Sequence[str] = ("_id", "id")) -> DataFrame:
    """With an include list, only those columns (that exist) plus the
    keys; an empty or missing include list keeps all (Q22). B12: drop the
    excluded columns (only without include). B13: constant columns override."""
    if include:
        cols = [c for c in include if c in df.columns]
        cols += [k for k in keys if k in df.columns and k not in cols]
        out = df.select(*cols)
    else:
        out = df.drop(*[c for c in exclude if c in df.columns])
    if manual:
        out = out.withColumns({k: F.lit(v) for k, v in manual.items()})
    return out


@dataclass(frozen=True)
class Factor:
    name: str
    path: str
    category: str = "General"
    kind: str = "Dynamic"


def factor_table(sources: dict[str, tuple[DataFrame, Sequence[Factor]]], target: str) -> DataFrame:
    """One row per (CVE, factor) with a non-null value; id = md5 of
    '{cve}_{factor}_{target}'. The CVE is the first truthy of id / cveID /
    cve_id (H12). Sources are stacked with unionByName (X4)."""
    parts = []
    for source, (df, factors) in sources.items():
        idc = [c for c in ("id", "cveID", "cve_id") if c in df.columns]
        cve = first_truthy(*idc)
        rows = F.array(*[F.struct(F.lit(f.name).alias("factor_name"),
                                  path_col(df, f.path).cast("string").alias("value"),
                                  F.lit(f.category).alias("category"),
                                  F.lit(f.kind).alias("static_or_dynamic")) for f in factors])
        long = df.select(cve.alias("cve_id"), F.explode(rows).alias("x")) \
            .filter(F.col("cve_id").isNotNull() & F.col("x.value").isNotNull()) \
            .select("cve_id", "x.*", F.lit(source).alias("source"))
        parts.append(long)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.md5(F.concat_ws("_", "cve_id", "factor_name", F.lit(target))).alias("s_no"),
                      "cve_id", "factor_name", "value", "category", "static_or_dynamic", "source")


__all__ = ["Factor", "factor_table", "mirror"]
