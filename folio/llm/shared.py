"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.session import checkpoint_dir

# A word: a run of characters other than space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # since Spark 4.1; others ignore it


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: what follows reads files that survive the loss of any executor. ``free``: the
    shuffle files of the write go as it ends, else they stay until the driver collects its garbage.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    if free:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(FREE_SHUFFLES)
        elif free:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def mounted(path: str) -> str:
    """The file-system path of a shared folder that is mounted on every machine.

    Memory mapping needs real files, so a folder that only Hadoop clients reach is an error.
    """
    u = urlparse(path)
    if u.scheme not in ("", "file"):
        raise ValueError(f"{path}: a folder mounted on all machines is needed to map files from it")
    return unquote(u.path)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value's text modulo n; -1 for null."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string")), F.lit(n)), F.lit(-1))



def small_side(df: DataFrame, limit: int = 20_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows; else as it is, for a shuffled
    join whose skewed partitions adaptive execution splits. Give it a staged table."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def numbered(rows: DataFrame, key: str, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place among those of their key, and ``n``, how many these are."""
    # the row's own number splits ranges of equal rows; which of these comes first changes nothing
    ranked = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(key), *order, F.col("_tie")]
    ranges = ranked.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    placed = stage(ranges.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)
    counts = placed.groupBy("_range", key).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    own = Window.partitionBy(key)
    before = F.sum("_rows").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select("_range", key, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(own).alias("n"))
    shifts = stage(shifts, name + "-ranges")
    return placed.join(small_side(shifts), ["_range", key]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")
