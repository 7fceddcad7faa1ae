"""A stored keyword index: an inverted table of tokens, a table of their grams, and word frequencies.

It is built once per corpus, in one pass over the text, and opened by every later query set:

    index = build_index(corpus, path)
    kept = retrieve_context(queries, corpus, index=open_index(spark, path))
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom.functions.text import words
from evalloom.session import stage

# Longest gram used to look keywords up; longer keywords are looked up by one gram and then compared.
GRAM = 4
# Characters of text to a bucket of postings, and the least number of buckets.
BUCKET_CHARS, MIN_BUCKETS = 256 << 20, 8


def grams(text: Column, sizes: list[int]) -> Column:
    """Every distinct substring of one of the sizes."""
    length = F.length(text)

    def of_size(n: int) -> Column:
        starts = F.when(length >= n, F.sequence(F.lit(1), length - n + 1))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")), lambda at: F.substring(text, at, F.lit(n))
        )

    return F.array_distinct(F.concat(*[of_size(n) for n in sizes]))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


@dataclass(frozen=True)
class KeywordIndex:
    """The tables of `build_index`: `documents (corpus_pos, n_chars)`, `postings (token, corpus_pos, n_chars)`,
    `grams (gram, token)` and `frequencies (word, df)`. Postings and grams lie in folders by bucket of their key."""

    documents: DataFrame
    postings: DataFrame
    grams: DataFrame
    frequencies: DataFrame
    buckets: int

    def lookup(self, pieces: DataFrame) -> tuple[DataFrame, bool, bool]:
        """For `keyword, piece, spaced`: every posting `corpus_pos, n_chars, keyword, exact` of a token with the piece.

        `exact` says that the piece is the keyword itself, so that every text with the token holds it. Keywords that are
        white space alone (`spaced`) are not looked up. The other two values say whether there are postings that are
        not exact, and keywords that were not looked up. Only the buckets of the asked grams and tokens are read.
        """
        gram = F.when(~F.col("spaced"), F.substring("piece", 1, GRAM))
        asked = stage(pieces.withColumn("gram", gram).withColumn("bucket", _bucket("gram", self.buckets)), "keyword-pieces")
        found = [row.bucket for row in asked.select(F.when(~F.col("spaced"), F.col("bucket")).alias("bucket")).distinct().collect()]
        held = self.grams.filter(F.col("bucket").isin([b for b in found if b is not None]))
        pairs = held.join(asked.drop("spaced"), ["bucket", "gram"]).filter(F.contains("token", "piece"))
        tokens = stage(pairs.select(
            "token", "keyword", (F.col("piece") == F.col("keyword")).alias("exact"), _bucket("token", self.buckets)
        ), "token-keywords")
        kinds = tokens.select("bucket", "exact").distinct().collect()
        postings = self.postings.filter(F.col("bucket").isin(sorted({row.bucket for row in kinds})))
        hits = postings.join(tokens, ["bucket", "token"]).drop("bucket", "token")
        return hits, not all(row.exact for row in kinds), None in found


def build_index(docs: DataFrame, path: str, *, buckets: int | None = None) -> KeywordIndex:
    """Write the index of `corpus_pos, content` (and `n_chars`) to `path`, and open it.

    Each text is read and cut into its distinct tokens once; postings, grams and word frequencies follow from those.
    A bucket of a frequent token is split over several tasks and files by its size. The number of `buckets` grows with
    the corpus unless it is given. A null text has no tokens.
    """
    spark = docs.sparkSession
    n_chars = F.col("n_chars").cast("int") if "n_chars" in docs.columns else F.length("content")
    tokens = F.array_distinct(F.split(F.lower("content"), r"\s+"))
    docs.select("corpus_pos", n_chars.alias("n_chars"), tokens.alias("tokens")).write.mode("overwrite").parquet(f"{path}/documents")
    held = spark.read.parquet(f"{path}/documents")
    if buckets is None:
        total = held.agg(F.sum(F.col("n_chars").cast("bigint"))).first()[0] or 0
        buckets = max(MIN_BUCKETS, -(-total // BUCKET_CHARS))

    def store(table: DataFrame, name: str, key: str) -> None:
        spread = table.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", "bucket")
        spread.sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}")

    store(held.select(F.explode("tokens").alias("token"), "corpus_pos", "n_chars"), "postings", "token")
    vocabulary = spark.read.parquet(f"{path}/postings").select("token").distinct()
    store(vocabulary.select(F.explode(grams(F.col("token"), list(range(1, GRAM + 1)))).alias("gram"), "token"), "grams", "gram")
    spelled = held.select(F.explode(F.array_distinct(F.flatten(F.transform("tokens", words)))).alias("word"))
    spelled.groupBy("word").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").parquet(f"{path}/frequencies")
    spark.range(buckets, buckets + 1).coalesce(1).write.mode("overwrite").parquet(f"{path}/buckets")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> KeywordIndex:
    """The index stored at `path`."""
    def table(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    return KeywordIndex(
        table("documents", "corpus_pos bigint, n_chars int"),
        table("postings", "token string, corpus_pos bigint, n_chars int, bucket int"),
        table("grams", "gram string, token string, bucket int"),
        table("frequencies", "word string, df bigint"),
        table("buckets", "id bigint").first().id,
    )
