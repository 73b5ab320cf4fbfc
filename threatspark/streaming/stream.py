"""Structured Streaming form of the layer loads.

New files in a landing folder are picked up by the file source, the
checkpoint remembers which files were done (resume, R1), and every
micro-batch is merged into the versioned table with the same upsert as the
batch path, so re-delivered rows are absorbed (R2). ``availableNow`` drains
what is there and stops, which is how a scheduled incremental run uses it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from threatspark.operators.merge import read_current, upsert_bucketed, upsert_table, vacuum


def stream_layer(spark: SparkSession, source_dir: str, schema: str, target: str, key: str | Sequence[str],
                 checkpoint: str, order: Sequence[str | Column] | None = None, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, transform=None, timeout_s: int | None = None,
                 buckets: int | None = None,
                 dedupe: tuple[str, str, Sequence[str]] | None = None) -> DataFrame:
    """Drain ``source_dir`` into the table at ``target``; returns the table.

    With ``buckets`` the target is hash-bucketed by key and each micro-batch
    rewrites only the buckets it touches (``upsert_bucketed``); without, each
    micro-batch commits a new full version (atomic for readers).

    ``dedupe`` = (event-time column, delay, columns): re-delivered copies are
    dropped in the stream itself, within the watermark (R2), before the merge.

    ``order`` (column names) holds over all deliveries: a back-dated row that
    arrives late never replaces a newer stored one. The stream runs until the
    backlog is drained; ``timeout_s`` is the caller's own limit, if any."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    if transform is not None:
        stream = transform(stream)
    if dedupe is not None:
        ts_col, delay, cols = dedupe
        stream = stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(cols))

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if buckets:
            upsert_bucketed(batch.sparkSession, target, batch, key, buckets=buckets, order=order, keep_newer=bool(order))
            return
        upsert_table(batch.sparkSession, target, batch, key, order=order, keep_newer=bool(order))

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream into {target} did not drain in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    vacuum(spark, target)
    return read_current(spark, target)
