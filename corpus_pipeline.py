"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom.llm import decontamination, language, near_text, packing, suffix_dedup
from evalloom.session import stage
from evalloom.sources import load


# Bytes of text that a task hands to Python at once; ten thousand rows, the default, may be far more.
BATCH_BYTES = 4 << 20


def _bounded(spark: SparkSession) -> None:
    """Keep what a task holds beside the rows it works on small, in this session's jobs."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text parses into phrases of a labelled language; texts without letters go."""
    _bounded(spark)
    return language.keep_languages(docs, language.fit(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a Jaccard similarity of 0.75 on five-word shingles."""
    _bounded(spark)
    return near_text.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of 50 bytes and more that a document of a smaller id has as well."""
    _bounded(spark)
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words of a benchmark item in a row."""
    _bounded(spark)
    return decontamination.decontaminate(docs, load(spark, "benchmark", sf_dir))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in sequences of 1024 tokens."""
    _bounded(spark)
    return packing.pack(docs)


STAGES = [
    ("known_language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_passages", benchmark_passages),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, "documents", sf_dir)
    for place, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs


QUERIES = {"pipeline": run}
# Language, the linear program and checksums are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None
ORACLE: dict[str, str] = {}
