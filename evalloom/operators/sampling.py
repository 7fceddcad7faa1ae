"""Samples, caps, prefixes and ranks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators.ranks import values_at
from evalloom.session import stage


def hash_order(key: str, seed: int | str) -> Column:
    """A pseudo-random order of the keys that is the same on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_draw(key: str, seed: int | str) -> Column:
    """A number below 2 to the 32 by the digest of the key."""
    return F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, rate: float, key: str, seed: int | str = 0) -> DataFrame:
    """Keep each key with probability `rate`, decided by its hash: a plain filter, no shuffle."""
    return df.filter(hash_draw(key, seed) < F.lit(rate) * 4294967296)


def bernoulli_sample(df: DataFrame, rate: float, seed: int | None = None) -> DataFrame:
    """The engine's own sample; which rows it keeps depends on how the data is partitioned."""
    return df.sample(withReplacement=False, fraction=rate, seed=seed)


def random_n(df: DataFrame, n: int, key: str, seed: int | str = 0) -> DataFrame:
    """n random rows, taken as a distributed top-n of the hash order."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def first_n(df: DataFrame, n: int, position: str = "corpus_pos") -> DataFrame:
    """The first n rows in corpus order."""
    return df.orderBy(position).limit(n)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, salt: Column, salts: int) -> DataFrame:
    """The first n rows of each group by a unique order, for groups too large for one task.

    Each group is cut into `salts` slices by a hash; a row among the first n of its group is among the
    first n of its slice, so only n rows per slice go on to the group's own ranking.
    """
    slices = W.partitionBy(*group, "__salt").orderBy(*order)
    kept = (
        df.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(salts)))
        .withColumn("__rank", F.row_number().over(slices))
        .filter(F.col("__rank") <= n)
    )
    whole = W.partitionBy(*group).orderBy(*order)
    return (
        kept.withColumn("__rank", F.row_number().over(whole))
        .filter(F.col("__rank") <= n)
        .drop("__salt", "__rank")
    )


def cap_per_hour(
    df: DataFrame, n: int = K.HOURLY_CAP, *, ts: str = "timestamp", key: str = "request_id",
    seed: int | str = 0, salts: int = 256,
) -> DataFrame:
    """At most n random rows per clock hour. The rest is not marked, so it comes back next time."""
    timed = df.withColumn("__hour", F.date_trunc("hour", ts)).withColumn("__draw", hash_order(key, seed))
    order = [F.col("__draw"), F.col(key)]
    return top_per_group(timed, ["__hour"], order, n, F.col(key), salts).drop("__hour", "__draw")


def position_at_rank(df: DataFrame, rank: Callable[[Column], Column], position: str = "corpus_pos") -> Column:
    """The position with a given rank (1 for the lowest) as a constant; null if there is none.

    `rank` gets the number of rows. Positions are unique integers, dense or as sparse as digests. They are read once;
    levels of counters find the one (see `ranks`), so no task sorts more than 65,536 of them, whatever their spread.
    """
    held = stage(df.select(
        F.struct(F.lit(0).alias("all")).alias("group"), F.col(position).cast("bigint").alias("key"),
        F.col(position).alias("value"), F.lit(1).cast("bigint").alias("n"),
    ).filter("key IS NOT NULL"), "positions")
    row = values_at(held, F.array(rank(F.col("total")).cast("bigint") - 1)).first()
    return F.lit(row.value if row else None).cast(df.schema[position].dataType)


def segmented_lag(
    df: DataFrame, key: str, order: str, columns: list[str], *, width: int = 10_000
) -> DataFrame:
    """Add `prev_<column>`: the value on the preceding row of the same key by a unique integer order.

    A key of any length is cut into ranges of `width` orders. Inside a range this is a plain `lag`; the
    first row of a range takes the last row of the key's preceding non-empty range.
    """
    ranged = df.withColumn("__range", F.floor(F.col(order) / width))
    values = F.struct(*[F.col(c) for c in columns])
    last = ranged.groupBy(key, "__range").agg(F.max_by(values, F.col(order)).alias("__last"))
    carried = last.select(
        key, "__range", F.lag("__last").over(W.partitionBy(key).orderBy("__range")).alias("__carry")
    ).filter(F.col("__carry").isNotNull())
    inside = W.partitionBy(key, "__range").orderBy(order)
    lagged = ranged.withColumn("__prev", F.lag(values).over(inside)).join(
        carried, [key, "__range"], "left"
    )
    prev = F.coalesce(F.col("__prev"), F.col("__carry"))
    return lagged.withColumns({f"prev_{c}": prev[c] for c in columns}).drop(
        "__range", "__prev", "__carry"
    )
