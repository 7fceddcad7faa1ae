"""Proportional stratified interleaving of rows into shards, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000
LAW = "rows"


def _ranked(df: DataFrame, groups: list[str], order: list[str], rank: str, total: str | None = None) -> DataFrame:
    """`rank` from 0 in each group, whose buckets follow each other and hold the order within; `total` rows of it.

    No task sees more rows than a bucket has: the windows over a whole group run on one row per bucket.
    """
    sizes = df.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    whole = W.partitionBy(*groups)
    before = whole.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    kept = [F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")]
    if total:
        kept.append(F.sum("__n").over(whole).alias(total))
    sizes = sizes.select(*groups, "__bucket", *kept)
    place = F.row_number().over(W.partitionBy(*groups, "__bucket").orderBy(*order)) - 1
    return (
        df.withColumn("__place", place).join(sizes, [*groups, "__bucket"])
        .withColumn(rank, F.col("__place") + F.col("__before"))
        .drop("__place", "__before", "__bucket")
    )


def interleave(
    docs: DataFrame, shards: int, *, stratum: str = "source", key: str = "doc_id", text: str = "text",
    seed: int = 42, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Every row with its `shard` and `slot`: each shard has the mixture of the table.

    Rows are shuffled within a stratum by a seeded digest of key and text; rank r of n gives the fraction
    (r + 1/2) / n; the rows in order of that fraction are cut into shards whose counts differ by one at most.
    Text itself does not move: the shuffles carry key, size, checksum and digest.

    Nulls: a null stratum is a stratum of its own; a null key is digested as such; a null text has size 8 and
    checksum 0. Equal rows of a stratum take neighbouring ranks. An empty table gives no rows. Other columns
    are left out, so their names cannot clash.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    named = F.coalesce(F.concat(F.lit("v"), F.col(stratum).cast("string")), F.lit("n"))
    digest = F.md5(F.concat_ws(
        "/", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.crc32(raw).cast("string")
    ))
    total = docs.count()
    buckets = max(1, -(-total // rows_per_bucket))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        named.alias("__stratum"),
        digest.alias("__digest"),
    )
    # The digest is even over its range, and so are its buckets.
    rows = rows.withColumn(
        "__bucket", F.floor(F.conv(F.substring("__digest", 1, 8), 16, 10).cast("double") * buckets / 2**32)
    )
    rows = _ranked(rows, ["__stratum"], ["__digest", "doc_id", "size"], "__rank", "__count")
    rows = rows.withColumn("__fraction", (2 * F.col("__rank") + 1) / (2 * F.col("__count")))
    rows = rows.withColumn("__all", F.lit(0)).withColumn("__bucket", F.floor(F.col("__fraction") * buckets))
    rows = _ranked(rows, ["__all"], ["__fraction", "__stratum"], "__at")
    rows = rows.withColumn("shard", F.expr(f"int(__at * {shards} div {max(total, 1)})"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.expr(f"bigint(__at - (bigint(shard) * {total} + {shards - 1}) div {shards})").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.when(F.col("__stratum") != "n", F.expr("substring(__stratum, 2)")).alias("stratum"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Store the assignment as one folder per shard, so that a reader of a shard reads its folder only."""
    interleave(docs, shards, **options).write.mode("overwrite").partitionBy("shard").parquet(path)
