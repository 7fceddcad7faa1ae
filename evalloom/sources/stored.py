"""Tables kept in a folder of parquet partitions: evolving appends, and merges that rewrite only what they touch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evalloom.session import stage, stored

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its files; a file that lacks one has nulls there."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def _checked(old: StructType, new: StructType) -> None:
    kinds = {f.name: f.dataType for f in old}
    changed = [f.name for f in new if f.name in kinds and kinds[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns with another type than the stored table has: {', '.join(changed)}")


def append_stored(df: DataFrame, path: str, *, partition_by: str | None = None) -> None:
    """Append rows to the stored table. New columns join its schema; columns it has and `df` lacks are null.

    A column that changes its type is an error, raised before anything is written. Nothing stored is read or rewritten
    but the footers that hold the schema.
    """
    spark = df.sparkSession
    if stored(spark, path):
        old = read_stored(spark, path)
        _checked(old.drop(partition_by).schema if partition_by else old.schema, df.schema)
    if partition_by:
        # Else each task would write a file of its own into every partition it has a row of.
        df = df.hint("rebalance", partition_by)
    df.write.mode("append").partitionBy(*([partition_by] if partition_by else [])).parquet(path)


def merge_stored(path: str, updates: DataFrame, key: str, merge: Merge, *, partition_by: str = "date") -> list:
    """Merge `updates` into the stored table partition by partition, and return the partitions that were rewritten.

    The partitions that hold a key of the updates are found by a join of the keys alone; if the updates name their
    partition, only those are looked into. The rows of the touched ones go through `merge(rows, updates)`, which may add
    columns, are staged, and replace their partitions; the files of all others stay as they are. If the job is lost
    half-way, merging the same updates again gives the same table, as long as `merge` sets values.
    """
    spark = updates.sparkSession
    target = read_stored(spark, path)
    keys = updates.select(*([key, partition_by] if partition_by in updates.columns else [key])).distinct()
    if partition_by in updates.columns:
        asked = [row[0] for row in keys.select(partition_by).distinct().collect()]
        target = target.filter(F.col(partition_by).isin([x for x in asked if x is not None]))
    # At most as many values as the table has partitions.
    met = target.select(key, partition_by).join(keys, keys.columns, "left_semi")
    touched = [row[0] for row in met.select(partition_by).distinct().collect()]
    if not touched:
        return []
    unnamed = F.col(partition_by).isNull() & F.lit(None in touched)
    rows = target.filter(F.col(partition_by).isin([x for x in touched if x is not None]) | unnamed)
    merged = stage(merge(rows, updates.drop(partition_by)), "merged")
    _checked(rows.schema, merged.schema)
    writer = merged.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)
    return touched


class Ledger:
    """The batches that were applied to a table: one folder each, so that noting a batch twice changes nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def has(self, batch_id: int) -> bool:
        return stored(self.spark, f"{self.path}/batch_id={batch_id}")

    def note(self, batch_id: int) -> None:
        done = self.spark.range(1).select(F.current_timestamp().alias("applied_at")).coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.schema("applied_at timestamp, batch_id bigint").parquet(self.path)
