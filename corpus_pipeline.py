"""The corpus pipeline: documents in, a filtered and mixed corpus out.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; it
is written as Parquet and read again as the next stage's docs. All stages but
the last return the columns that they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threatspark.llm import decontamination, line_dedup, mixing, near_dedup, toxicity
from threatspark.llm.shared import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the severity model rejects go."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines found in three documents stay in one; no document goes."""
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near copies (five-word shingles, similarity
    0.8 or more) the document with the smallest id stays."""
    return near_dedup.without_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark passage go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document gets its place (slot, seat) in the mix."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: SQL cannot express the trained and the edit-distance stages; tests/llm checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
