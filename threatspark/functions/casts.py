"""Tolerant parsing and casting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatspark.functions.strings import strip

EPSS_DECIMAL = T.DecimalType(20, 15)  # a probability as published, not rounded
CVSS_DECIMAL = T.DecimalType(4, 1)
SCORE_DECIMAL = T.DecimalType(28, 15)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso(c) -> Column:
    """ISO-8601 timestamp, optional 'Z' or offset; junk -> null (UTC)."""
    return F.try_to_timestamp(_c(c))


def parse_day(c) -> Column:
    """%Y-%m-%d (unpadded month/day accepted); junk -> null."""
    return F.try_to_date(_c(c), "yyyy-M-d")


def tolerant_int(c) -> Column:
    """Like int(text): optional sign and digits with surrounding white space, as a long."""
    t = strip(_c(c).cast("string"))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))


def decimal_or_zero(c, dtype: T.DecimalType = EPSS_DECIMAL) -> Column:
    """Null or '' -> 0; else the decimal value (null if unparseable)."""
    col = _c(c)
    t = strip(col.cast("string"))
    return F.when(col.isNull() | (t == ""), F.lit(0).cast(dtype)) \
        .otherwise(t.try_cast(dtype))


def round2(c) -> Column:
    """Round half-up to 2 decimals in decimal arithmetic, expose double."""
    return F.round(_c(c).cast(SCORE_DECIMAL), 2).cast("double")


def falsy_to_null(c, dtype: T.DataType) -> Column:
    """null, '', 0, 0.0, False and [] become null (Python truthiness)."""
    col = _c(c)
    if isinstance(dtype, T.StringType):
        return F.when(col != "", col)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(col) > 0, col)
    if isinstance(dtype, T.BooleanType):
        return F.when(col, col)
    if isinstance(dtype, T.NumericType):
        return F.when(col != 0, col)
    return col


def split_quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """rows failing any check go to quarantine with a reason; the rest pass.

    ``checks`` maps a reason to a Column that is true when the row is bad.
    """
    reasons = F.filter(F.array(*[F.when(bad, F.lit(r)) for r, bad in checks.items()]),
                       lambda x: x.isNotNull())
    tagged = df.withColumn("_reasons", reasons)
    good = tagged.filter(F.size("_reasons") == 0).drop("_reasons")
    bad = tagged.filter(F.size("_reasons") > 0) \
        .withColumn("reason", F.array_join("_reasons", ",")).drop("_reasons")
    return good, bad
