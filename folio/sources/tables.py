"""Driver tables and the element-shaped views derived from them.

The driver ships TPC-H-like tables plus text tables as parquet. The views below give
them the shapes the operators expect (jobs, images, text blocks, detections, traces,
files, vectors, structured rows, job results). They are plain projections and one
window, so Catalyst prunes the parquet scan to the columns each query touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per document, raw (before metadata injection)."""
    d = load(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("job_id"),
        F.col("doc_id").alias("pos"),
        F.col("text").alias("content"),
        F.col("source").alias("source_id"),
        F.concat(F.col("source"), F.lit("/"), _s(F.col("doc_id"))).alias("source_name"),
        F.lit("text").alias("document_type"),
        F.col("lang"),
        (F.col("doc_id") % 3 != 0).alias("has_split"),
        (F.col("doc_id") % 5 == 0).alias("cm_failed"),
    )


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with blank lines between paragraphs, for passage splitting."""
    d = load(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("job_id"), F.col("source").alias("source_id"),
                    F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("content"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    return p.select(
        (k % 50).alias("job_id"),
        (s % 5).alias("page"),
        k.alias("pos"),
        F.concat(F.col("p_brand"), F.lit("|"), _s(s)).alias("content"),
        (s * 20).alias("width"),
        ((k * 37) % 900).cast("int").alias("height"),
        (k * 13 % 500).cast("double").alias("x1"),
        (k * 7 % 700).cast("double").alias("y1"),
        (k * 13 % 500 + s).cast("double").alias("x2"),
        (k * 7 % 700 + s).cast("double").alias("y2"),
        F.col("p_type").alias("source_id"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text blocks with boxes: every lineitem row (whole table)."""
    li = load(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        (F.col("l_orderkey") % 50).alias("job_id"),
        (F.col("l_linenumber") % 5).alias("page"),
        (F.col("l_orderkey") * 100 + F.row_number().over(w)).alias("pos"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus"), _s(pk)).alias("text"),
        (pk * 11 % 500).cast("double").alias("x1"),
        (sk * 17 % 700).cast("double").alias("y1"),
        (pk * 11 % 500 + 40).cast("double").alias("x2"),
        (sk * 17 % 700 + 10).cast("double").alias("y2"),
        F.when(F.col("l_linenumber") % 2 == 0, "nearby_block").otherwise("body").alias("text_type"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    q, t = F.col("l_quantity"), F.col("l_tax")
    return li.select(
        F.col("l_orderkey").alias("image_id"),
        F.row_number().over(w).alias("box_id"),
        F.when(F.col("l_linenumber") % 3 == 0, "table")
         .when(F.col("l_linenumber") % 3 == 1, "chart").otherwise("title").alias("label"),
        (q / 100).alias("x1"), t.alias("y1"), (q / 100 + 0.2).alias("x2"), (t + 0.3).alias("y2"),
        (F.col("l_discount") * 10).alias("score"),
    )


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage spans: exit = entry + latency."""
    e = load(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("job_id"), F.col("event_type").alias("stage"),
        F.col("event_id").alias("pos"), F.col("ts").alias("ts_entry"),
        F.col("value").alias("latency_ms"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    ext = (F.when(F.col("doc_id") % 5 == 0, "pdf").when(F.col("doc_id") % 5 == 1, "docx")
           .when(F.col("doc_id") % 5 == 2, "PPTX").when(F.col("doc_id") % 5 == 3, "md")
           .otherwise("jpg"))
    return d.select(
        F.concat(F.col("source"), F.lit("/"), _s(F.col("doc_id")), F.lit("."), ext).alias("path"),
        F.col("doc_id").alias("pos"), F.col("n_chars").alias("size"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("pk"), F.col("embedding").alias("vector"), F.col("label"))


def structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "pages")
    pid = F.col("page_id")
    return p.select(
        pid.alias("job_id"), pid.alias("pos"), F.lit("structured").alias("document_type"),
        F.when(pid % 4 == 0, "").when(pid % 4 == 1, F.lit(None).cast("string"))
         .otherwise(F.col("url")).alias("table_content"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "success")
         .otherwise(F.lit(None).cast("string")).alias("status"),
        F.col("o_totalprice").alias("size"),
    )
