"""EPSS snapshot files (gzip CSV with '#' metadata lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatspark.functions.casts import EPSS_DECIMAL, decimal_or_zero, split_quarantine
from threatspark.operators.incremental import snapshot_gate

# Fixed values that must equal the reference's for right results.
DAY_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
SCORE_DATE_PATTERN = r"score_date:(\d{4}-\d{2}-\d{2})"


def score_date_of(line: Column) -> Column:
    """The score date inside a metadata line, null when absent."""
    d = F.regexp_extract(line, SCORE_DATE_PATTERN, 1)
    return F.when(d != "", d)


def read_epss(spark: SparkSession, path: str, since: str | None = None,
              run_date: str | None = None, trust_names: bool = False) -> DataFrame:
    """Rows of every snapshot file under ``path``, stamped with the file's
    score date (today / ``run_date`` when the file has none); whole files
    dated on or before ``since`` are skipped (F4).

    The metadata line alone decides. With ``trust_names``, for folders whose
    files are known to be named by their score date, files whose name carries
    a day on or before ``since`` are not opened at all. Metadata: one pass
    over the text, reduced to one row per file. Rows: the CSV reader with '#'
    as comment char, header lines dropped; rows without a CVE stay, for the
    bronze step to reject. Both are keyed by file name and joined (J11); the
    metadata side has one row per file."""
    name_day = F.regexp_extract(F.col("_metadata.file_name"), DAY_IN_NAME, 1)
    open_ = F.lit(True) if since is None or not trust_names else (name_day == "") | (name_day > F.lit(since))
    text = spark.read.text(path).filter(open_).withColumn("_file", F.col("_metadata.file_path"))
    files = text.groupBy("_file").agg(F.max(F.when(F.col("value").startswith("#"), score_date_of(F.col("value")))).alias("score_date"))
    files = snapshot_gate(files, since)
    rows = spark.read.option("header", True).option("comment", "#").option("ignoreLeadingWhiteSpace", True) \
        .schema("cve string, epss string, percentile string").csv(path).filter(open_) \
        .withColumn("_file", F.col("_metadata.file_path"))
    today = F.lit(run_date) if run_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    out = rows.join(files, "_file").withColumn("date", F.coalesce("score_date", today))
    return out.drop("_file", "score_date").filter(F.col("cve").isNull() | (F.col("cve") != "cve"))


def bronze_epss(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B3 + F12: numbers as decimal, null/'' -> 0; unparseable text goes to
    quarantine instead of failing the load (Q17)."""
    typed = raw.select("cve", decimal_or_zero("epss", EPSS_DECIMAL).alias("epss"),
                       decimal_or_zero("percentile", EPSS_DECIMAL).alias("percentile"), "date",
                       F.col("epss").alias("_epss_raw"), F.col("percentile").alias("_pct_raw"))
    good, bad = split_quarantine(typed, {
        "epss_not_a_number": F.col("epss").isNull(),
        "percentile_not_a_number": F.col("percentile").isNull(),
        "missing_cve": F.col("cve").isNull() | (F.col("cve") == ""),
    })
    return good.drop("_epss_raw", "_pct_raw"), bad
