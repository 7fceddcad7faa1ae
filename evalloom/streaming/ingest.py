"""Incremental ingest of the request log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evalloom.operators.joins import merge_matched
from evalloom.operators.predicates import with_status_columns
from evalloom.session import stage
from evalloom.sources import Ledger, merge_stored, read_stored

MERGED = "merged_batch"


def request_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Rows of an append-only parquet folder, as they arrive. `path` may be a glob."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def append_stream(
    df: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> None:
    """Append everything available to a parquet folder, each row exactly once, and stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(out).awaitTermination()


def ingest(
    spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Append the request rows that arrived since the last run, marked as not judged yet.

    A log partitioned by `date` lets later look-backs skip the folders of older days.
    """
    fresh = with_status_columns(request_stream(spark, source, schema))
    append_stream(fresh, out, checkpoint, partition_by)


def evaluate_batches(
    df: DataFrame, evaluate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> None:
    """Evaluate each micro-batch and store the result.

    A batch owns the folder `batch_id=<n>`, so one that is run again after a failure replaces its own
    output and no other's.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        evaluate(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (
        df.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def merge_batch(
    batch: DataFrame, batch_id: int, evaluate: Callable[[DataFrame], DataFrame], path: str, ledger: str, key: str, *,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, partition_by: str = "date",
) -> list:
    """Merge what `evaluate` returns for a batch into the stored table, once, and return the rewritten partitions.

    A batch that the ledger beside the table holds is skipped. Every row that a batch changes also gets its number as
    `merged_batch`, so that a batch whose job was lost half-way, and which the ledger lacks, changes only the rest when
    it runs again. `merge` (by default all columns of the update are set) may read the row it changes.
    """
    spark = batch.sparkSession
    applied = Ledger(spark, ledger)
    if applied.has(batch_id):
        return []
    updates = evaluate(batch).withColumn(MERGED, F.lit(batch_id).cast("bigint"))
    held = read_stored(spark, path)
    if MERGED in held.columns:
        updates = updates.join(held.filter(F.col(MERGED) >= batch_id).select(key), key, "left_anti")
    both = (lambda rows, new: merge_matched(merge(rows, new), new, key)) if merge else (lambda rows, new: merge_matched(rows, new, key))
    touched = merge_stored(path, stage(updates, "updates"), key, both, partition_by=partition_by)
    applied.note(batch_id)
    return touched


def merge_batches(df: DataFrame, evaluate: Callable[[DataFrame], DataFrame], path: str, ledger: str, checkpoint: str, key: str, **options) -> None:
    """`merge_batch` for everything available in the stream. One stream at a time may write to a table."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, evaluate, path, ledger, key, **options)

    (
        df.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
