"""Sinks: object storage of element payloads, output by content type, vector tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import clean_filename
from folio.operators.ranking import scan
from folio.sources.objects import write_objects

FILE_BYTES = 256 * 1024 * 1024


def quote_path(c: Column) -> Column:
    """Percent-encoding with nothing kept but letters, digits and ``_.-~`` (like Python
    ``quote(s, safe="")``), built on the JVM ``url_encode``."""
    e = F.url_encode(c)
    return F.replace(F.replace(F.replace(e, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def object_key(df: DataFrame, index_col: str = "pos") -> Column:
    """``quote(source_id)/<row index>.quote(image_type or png)``."""
    it = F.when(F.col("document_type") == "image",
                F.coalesce(F.col("metadata.image_metadata.image_type"), F.lit("png"))).otherwise(F.lit("png"))
    return F.concat(quote_path(F.col("metadata.source_metadata.source_id")), F.lit("/"),
                    F.col(index_col).cast("string"), F.lit("."), quote_path(it))


def store_objects(df: DataFrame, base_uri: str, bucket: str = "ingest", structured: bool = True,
                  images: bool = False, write: bool = False, index_col: str = "pos") -> DataFrame:
    """Decode base64 payloads of structured (default) / image rows and point their
    metadata at the stored object: ``source_location`` and the uploaded URL/URI become
    ``<base_uri>/<bucket>/<key>``. With ``write`` the bytes are written under that URI by the
    executors, and appear there when all of them are written (``sources.objects``)."""
    types = (["structured"] if structured else []) + (["image"] if images else [])
    sel = F.coalesce(F.col("document_type").isin(*types), F.lit(False))
    url = F.concat(F.lit(base_uri.rstrip("/") + "/" + bucket + "/"), object_key(df, index_col))
    md = F.col("metadata")
    new_md = md.withField("source_metadata.source_location", url)
    new_md = F.when(F.col("document_type") == "image",
                    new_md.withField("image_metadata.uploaded_image_url", url)) \
              .otherwise(new_md.withField("table_metadata.uploaded_image_uri", url))
    out = df.withColumn("metadata", F.when(sel, new_md).otherwise(md))
    if write:
        payload = df.where(sel).select(object_key(df, index_col).alias("key"), F.unbase64(F.col("metadata.content")).alias("bytes"))
        write_objects(payload.where(F.col("key").isNotNull()), base_uri.rstrip("/") + "/" + bucket)
    return out


def doc_name(col: Column) -> Column:
    """Output file stem for a source: ``<clean basename>.metadata.json``."""
    base = F.regexp_extract(col, "([^/\\\\]+)$", 1)
    return F.concat(clean_filename(base), F.lit(".metadata.json"))


def by_content_type(df: DataFrame) -> DataFrame:
    """Grouping behind :func:`write_by_content_type`: element count per (type, file)."""
    return (df.withColumn("type", F.col("metadata.content_metadata.type"))
              .withColumn("doc_name", doc_name(F.col("metadata.source_metadata.source_name")))
              .groupBy("type", "doc_name").agg(F.count("*").alias("n_elements")))


def write_by_content_type(df: DataFrame, out_dir: str, file_bytes: int = FILE_BYTES) -> int:
    """One JSON array of elements per (type, file): ``<content type>/<file>.metadata.json``, in
    (``pos``, ``piece``) order; the number of files. Files appear when all are written.

    A file holds up to about ``file_bytes``; the elements beyond follow in ``<file>.metadata.1.json`` and
    so on, so that one source, however large, is written by many tasks."""
    keys = [c for c in ("job_id", "pos", "piece") if c in df.columns]
    thin = df.select(F.coalesce(F.col("metadata.content_metadata.type"), F.lit("unknown")).alias("_type"),
                     F.coalesce(doc_name(F.col("metadata.source_metadata.source_name")), F.lit("unknown.metadata.json")).alias("_name"),
                     *keys, F.to_json(F.struct("document_type", "metadata")).alias("_json"))
    placed = scan(thin.withColumn("_size", F.octet_length("_json") + 1), ["_type", "_name"], keys,
                  sums={"_upto": "_size", "_at": F.lit(1).cast("long")})
    part = F.floor((F.col("_upto") - F.col("_size")) / F.lit(int(file_bytes))).cast("long")
    whole = placed.groupBy("_type", "_name", part.alias("_part")).agg(F.array_sort(F.collect_list(F.struct("_at", "_json"))).alias("_items"))
    suffix = F.when(F.col("_part") > 0, F.concat(F.lit("."), F.col("_part").cast("string"))).otherwise("")
    name = F.concat(F.regexp_replace("_name", "[.]json$", ""), suffix, F.lit(".json"))
    text = F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["_json"]), ","), F.lit("]"))
    return write_objects(whole.select(F.concat("_type", F.lit("/"), name).alias("key"), F.encode(text, "utf-8").alias("bytes")), out_dir)


def write_vectors(df: DataFrame, table_path: str, recreate: bool = False, batch_size: int = 5120) -> None:
    """Batch write of vector rows (pk, text, vector, source) as parquet; ``recreate``
    replaces the table, otherwise rows are appended. Files hold at most ``batch_size``
    rows, the reference's insert batch. The streaming form lives in
    :func:`folio.streaming.sinks.write_vector_stream`."""
    (df.write.mode("overwrite" if recreate else "append")
       .option("maxRecordsPerFile", batch_size).parquet(table_path))
