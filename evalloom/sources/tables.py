"""Batch tables: catalog, parquet, JSON lines, in-memory records and key/value metadata."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# A table read in fewer partitions than this is small enough to be moved.
SMALL_PARTITIONS = 32


def load(
    spark: SparkSession, name: str, base: str | None = None, *, spread_by: str | None = None
) -> DataFrame:
    """The catalog table `name`, or `<base>/<name>.parquet` if a folder is given.

    `spread_by` is for work that spends far more on a row than reading it takes: a table in so few files
    that it would leave cores idle is spread by that column. Larger tables stay where they are.
    """
    table = spark.table(name) if base is None else spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    if spread_by is not None:
        cores = spark.sparkContext.defaultParallelism
        if table.rdd.getNumPartitions() < min(cores, SMALL_PARTITIONS):
            return table.repartition(cores, spread_by)
    return table


def load_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines under a declared schema, so no pass over the data is spent on inference."""
    return spark.read.schema(schema).json(path)


def from_records(
    spark: SparkSession, records: Iterable[dict[str, Any]], schema: StructType | str
) -> DataFrame:
    """A table of the caller's records. Fields a record lacks are null."""
    return spark.createDataFrame(list(records), schema=schema)


def save(
    df: DataFrame, name: str, *, path: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Overwrite the table `name`, stored at `path` if given, and return it as a reader sees it."""
    writer = df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_jsonl(df: DataFrame, path: str) -> None:
    """One folder of JSON-lines files, written in parallel. Null fields are kept as nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_evolving(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append by column name. A column only one side has is null on the other."""
    return base.unionByName(new, allowMissingColumns=True)


def legacy_layout(columns: Iterable[str]) -> str:
    """`metadata` if the legacy name holds the key/value table itself, `view` if it holds the rows."""
    return "metadata" if set(columns) == {"key", "value"} else "view"


def fold_kv(df: DataFrame, order: Column | str | None = None) -> DataFrame:
    """A key/value table with one row per key, to be joined on however many keys there are.

    A key that occurs more than once keeps the value latest by `order` (the greatest value where no order is given).
    """
    order = F.col("value") if order is None else (F.col(order) if isinstance(order, str) else order)
    return df.groupBy("key").agg(F.max_by("value", order).alias("value"))


def kv_to_map(df: DataFrame, order: Column | str | None = None) -> DataFrame:
    """The rows of `fold_kv` as one row holding a map, for metadata that a caller wants at hand."""
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return fold_kv(df, order).agg(F.map_from_entries(entries).alias("metadata"))
