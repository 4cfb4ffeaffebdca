"""Session helpers: local defaults for tests, shared checkpoint folder for clusters."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job wants regardless of data size: AQE re-plans shuffles at
# runtime (coalescing small partitions, splitting skewed join partitions), and UTC
# keeps timestamp arithmetic identical on every executor.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints written to cut lineage are removed once their DataFrame is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "folio") -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("FOLIO_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("FOLIO_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that names none gets a scratch folder; on a cluster that would be
    one machine's own, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="folio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Cut a long lineage so lost executors do not replay it.

    ``checkpoint`` writes to the reliable checkpoint folder; ``table`` writes parquet
    under the same folder and reads it back. Never a machine-local checkpoint.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if how == "checkpoint" or "void" in df.schema.simpleString():  # Parquet has no type for columns of nothing
        return df.checkpoint(eager=True)
    path = f"{base.rstrip('/')}/folio-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
