"""File and job sources: binary files, manifests, job JSON, payload unpacking."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.charset import decode_text
from folio.functions.predicates import extension, infer_document_type_col
from folio.operators.intake import parse_jobs  # noqa: F401

TEXT_LIKE = ["text", "txt", "md", "html", "sh", "json"]


def read_files(spark: SparkSession, paths, recursive: bool = True, glob: str | None = None,
               full_path_ids: bool = False) -> DataFrame:
    """One row per file (``binaryFile``): job_id/source_id/source_name = basename (or the
    full path with ``full_path_ids``), bytes in ``raw``. Listing is distributed."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(paths)
    base = F.regexp_extract(F.col("path"), "([^/]+)$", 1)
    ident = F.col("path") if full_path_ids else base
    return df.select(
        F.col("path"), ident.alias("source_id"), ident.alias("source_name"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        F.col("content").alias("raw"))


def infer_document_type(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Document type from the lower-cased extension; unknown -> null plus an error text."""
    t = infer_document_type_col(F.col(path_col))
    return (df.withColumn("document_type", t)
              .withColumn("type_error", F.when(t.isNull(), F.concat(
                  F.lit("Unsupported file type: "), extension(F.col(path_col))))))


def encode_content(df: DataFrame, raw_col: str = "raw", charset: str | None = None) -> DataFrame:
    """Text-like documents -> decoded string; everything else -> base64 of the bytes.

    Without ``charset`` each file's encoding is judged by its first 50,000 bytes
    (:mod:`folio.functions.charset`): marks, UTF-8, UTF-16 and UTF-32 without marks, Latin, Cyrillic and
    CJK encodings. Files that are valid UTF-8 never leave the JVM."""
    t, raw = F.lower(F.col("document_type")), F.col(raw_col)
    is_text = F.coalesce(t.isin(*TEXT_LIKE), F.lit(False))
    if charset is not None:
        text = F.decode(raw, charset)
    else:
        utf8 = F.is_valid_utf8(raw.cast("string")) & ~F.coalesce(F.contains(raw, F.lit(b"\0")) | F.startswith(raw, F.lit(b"\xef\xbb\xbf")), F.lit(True))
        text = F.when(utf8, raw.cast("string")).otherwise(_decoded(F.when(is_text & ~utf8, raw)))
    return df.withColumn("content", F.when(is_text, text).otherwise(F.base64(raw)))


def _decoded(raw: Column) -> Column:
    def decode(files: pd.Series) -> pd.Series:
        return files.map(decode_text, na_action="ignore")

    return F.pandas_udf(decode, "string")(raw)


def read_manifest(spark: SparkSession, path: str, shuffle_seed: int | None = None) -> DataFrame:
    """``sampled_files`` of a dataset manifest JSON -> one row per file (``path``, ``pos``)."""
    m = spark.read.option("multiLine", "true").json(path)
    out = m.select(F.posexplode("sampled_files").alias("pos", "path"))
    if shuffle_seed is not None:
        out = out.orderBy(F.rand(shuffle_seed))
    return out


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job JSON lines (batch). Bad records are kept with ``cm_failed``; see
    :func:`folio.streaming.jobs.read_job_stream` for the streaming source."""
    raw = spark.read.text(path)
    return parse_jobs(raw, "value")


def unpack_payload(jobs: DataFrame) -> DataFrame:
    """Parallel payload lists -> one row per position (``pos``), job columns kept."""
    keep = [c for c in jobs.columns if c != "job_payload"]
    p = F.col("job_payload")
    z = F.arrays_zip(p["content"].alias("content"), p["source_name"].alias("source_name"),
                     p["source_id"].alias("source_id"), p["document_type"].alias("document_type"))
    return (jobs.select(*keep, F.posexplode(z).alias("pos", "_d"))
                .select(*keep, "pos", "_d.content", "_d.source_name", "_d.source_id",
                        F.lower(F.col("_d.document_type")).alias("document_type")))
