"""Session set-up and staged intermediate tables."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import deque
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Names of staged folders: a label and a random number.
STAGED = re.compile(r"^[a-z_-]+-[0-9a-f]{32}$")
# Paths that `stage` has written to inside of `stage_alone`.
_within: ContextVar[list[str] | deque] = ContextVar("within", default=deque(maxlen=0))


def build_session(app: str = "evalloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; keyword names use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Rank filters up to this many rows per group are cut before the shuffle as well.
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    A local-mode session without one uses the warehouse, which driver and executors share there. On a cluster
    the folder must be named.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, computes a result used more than once
    only once, and tells Catalyst its true size, so that a later join broadcasts it only if it really
    is below `spark.sql.autoBroadcastJoinThreshold`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _within.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what `make` returns, and then remove the tables that `make` itself has staged: nothing else may read them."""
    mark = _within.set([])
    try:
        df = make()
        inner = _within.get()
    finally:
        _within.reset(mark)
    out = stage(df, label)
    for path in inner:
        at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return out


def stored(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the folder `path`, or a part of it, by the mark that Spark leaves by default."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def kept_path(source: DataFrame, label: str, build: Callable[[str], object], *, layout: int = 1) -> str:
    """The folder of something derived from the stored table `source`, built on first use and kept in the shared folder.

    Its name holds a digest of the paths, sizes and times of the table's files, so a table that changes gets a new one;
    so does a `layout` that changes.
    A build that did not finish is built again. Two sessions that find it missing at once both build it: have one
    build it first. `clear_staged` removes it.
    """
    spark = source.sparkSession
    file = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("file")
    mark = tuple(source.select(file).agg(F.count(F.lit(1)), F.min("file"), F.max("file"), F.sum(F.col("file") % 1_048_573)).first())
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{hashlib.md5(f'{label}:{layout}:{mark}'.encode()).hexdigest()}"
    done = f"{path}/built"
    if not stored(spark, done):
        build(path)
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(done)
    return path


def clear_staged(spark: SparkSession) -> None:
    """Remove the staged tables of this session's folder. Call it when no DataFrame built on them is needed any more."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(base):
        for entry in files.listStatus(base):
            if STAGED.search(entry.getPath().getName()):
                files.delete(entry.getPath(), True)
