"""Streaming sources: job intake and directory watching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.sources.files import parse_jobs


def read_job_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded job intake from JSON-lines files landing in ``source_dir`` (a Kafka
    topic works the same way with ``format("kafka")`` and ``CAST(value AS STRING)``).
    Bad jobs that have a job_id stay as failed rows; without one they are dropped."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_jobs(r.load(source_dir), "value")


def watch_files(spark: SparkSession, directory: str, max_files: int = 1024, glob: str | None = None) -> DataFrame:
    """New files in ``directory`` as a stream of (path, modificationTime, length,
    content); ``max_files`` per micro-batch is the batch size of the watcher."""
    r = (spark.readStream.format("binaryFile")
         .schema("path string, modificationTime timestamp, length long, content binary")
         .option("maxFilesPerTrigger", max_files))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(directory)
