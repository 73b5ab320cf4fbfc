"""String column functions (S1-S6, F13). All return JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
CVE_PREFIX = "CVE-"
CWE_MARKER = "CWE-"
NA_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
            "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
            "n/a", "nan", "null"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Leading and trailing white space of any kind removed (``trim`` takes blanks only)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def normalize_cves(c) -> Column:
    """Split on ',', strip, upper, keep 'CVE-' prefixed, dedupe, sort."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","),
                        lambda x: F.upper(strip(x)))
    kept = F.filter(parts, lambda x: x.startswith(CVE_PREFIX))
    return F.array_sort(F.array_distinct(kept))


def join_text(a, b) -> Column:
    """S2: 'a b' trimmed, a null side counts as empty."""
    return strip(F.concat(F.coalesce(_c(a), F.lit("")), F.lit(" "),
                          F.coalesce(_c(b), F.lit(""))))


def finding_id(host, plugin, null_text: str = "") -> Column:
    """S3: md5 of '{host}-{plugin}'. A missing part is ``null_text``: '' by
    default, 'nan' reproduces the text a missing pandas cell gives (Q11)."""
    return F.md5(F.concat(F.coalesce(_c(host).cast("string"), F.lit(null_text)), F.lit("-"),
                          F.coalesce(_c(plugin).cast("string"), F.lit(null_text))))


def factor_id(cve, factor: str, table: str) -> Column:
    """S3: md5 of '{cve}_{factor}_{table}'."""
    return F.md5(F.concat(_c(cve), F.lit(f"_{factor}_{table}")))


def threats_to_text(m) -> Column:
    """map<string,array<string>> -> 'k: v1, v2; k2: v'. Empty/null -> ''."""
    entries = F.transform(F.map_entries(_c(m)),
                          lambda e: F.concat(e["key"], F.lit(": "),
                                             F.array_join(e["value"], ", ")))
    return F.coalesce(F.array_join(entries, "; "), F.lit(""))


def lowercase_in(c, values: list[str]) -> Column:
    """case-insensitive membership."""
    return F.lower(_c(c).cast("string")).isin([v.lower() for v in values])


def na_to_null(c) -> Column:
    """Q14: pandas-style NA words read as missing."""
    col = _c(c)
    return F.when(col.isin(NA_WORDS), F.lit(None)).otherwise(col)


def cve_of(n) -> Column:
    """Fixture rule: a synthetic CVE id from an integer key, padded to six
    digits; longer numbers stay whole."""
    text = _c(n).cast("string")
    return F.concat(F.lit("CVE-2024-"), F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text))


def decimal_text(c) -> Column:
    """A decimal as short text like Python's float repr: trailing zeros
    dropped, one kept after the point ('0.39480' -> '0.3948', '1.00' -> '1.0')."""
    t = F.regexp_replace(_c(c).cast("string"), r"0+$", "")
    t = F.when(_c(c).cast("string").contains("."), t).otherwise(_c(c).cast("string"))
    return F.when(t.endswith("."), F.concat(t, F.lit("0"))).otherwise(t)


def threats_json(m) -> Column:
    """G7 export form: map<string,array<string>> as a JSON object whose
    single-value lists are unwrapped to the value ({"k": "v", "k2": ["a", "b"]})."""
    def one(x):  # JSON text of one string, escaped by to_json
        j = F.to_json(F.array(x))
        return F.substring(j, 2, F.length(j) - 2)
    parts = F.transform(F.map_entries(_c(m)), lambda e: F.concat(
        one(e["key"]), F.lit(":"),
        F.when(F.size(e["value"]) == 1, one(e["value"][0])).otherwise(F.to_json(e["value"]))))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
