"""Registered queries: vectors and embeddings, sampling, responses and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import chunk, embed, filters, metadata, responses, sampling, vectors
from folio.plans.q_images import IMAGES_SQL, image_elements
from folio.plans.q_text import JOBS_SQL, _pieces_sql, text_elements
from folio.plans.registry import query
from folio.sources import sinks, tables

CENTROIDS_SQL = """SELECT label, i, avg(e) AS c FROM (
  SELECT label, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings) t
GROUP BY label, i"""

DIST_SQL = f"""SELECT v.vec_id, c.label, sum((v.e - c.c) * (v.e - c.c)) AS d2,
       sum(v.e * c.c) AS dotp, sqrt(sum(v.e * v.e)) AS nv, sqrt(sum(c.c * c.c)) AS nc
FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings) v
JOIN ({CENTROIDS_SQL}) c USING (i) GROUP BY v.vec_id, c.label"""


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean embedding (#labels x dim rows aggregated)."""
    v = tables.vectors(spark, sf_dir)
    per_dim = (v.select("label", F.posexplode("vector").alias("i", "e"))
                .groupBy("label", "i").agg(F.avg(F.col("e").cast("double")).alias("c")))
    return (per_dim.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "c"))).alias("_c"))
                   .select(F.col("label").cast("long").alias("query_id"),
                           F.transform("_c", lambda x: x["c"]).alias("query")))


@query("vector_search", operators=("F6",), sql=f"""
SELECT label AS query_id, CAST(rank AS INTEGER) AS rank, vec_id AS pk, round(d2, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY d2, vec_id) AS rank FROM ({DIST_SQL}) d) r
WHERE rank <= 10""")
def vector_search_q(spark, sf_dir):
    res = vectors.vector_search(tables.vectors(spark, sf_dir), label_centroids(spark, sf_dir), k=10)
    return res.select("query_id", F.col("rank").cast("int").alias("rank"), "pk",
                      F.round("score", 6).alias("score"))


@query("cosine_similarity", operators=("F7",), sql=f"""
SELECT vec_id AS pk, round(dotp / (nv * nc), 6) AS cosine, dotp / (nv * nc) > 0.98 AS golden
FROM ({DIST_SQL}) d JOIN embeddings e USING (vec_id) WHERE d.label = e.label""")
def cosine_similarity_q(spark, sf_dir):
    v = tables.vectors(spark, sf_dir)
    c = label_centroids(spark, sf_dir).withColumnRenamed("query_id", "label")
    cos = vectors.cosine_similarity("vector", "query")
    return (v.withColumn("label", F.col("label").cast("long")).join(c, "label")
             .select("pk", F.round(cos, 6).alias("cosine"), (cos > 0.98).alias("golden")))


STRUCTURED_SQL = """SELECT page_id AS job_id, page_id AS pos, 'structured' AS document_type,
  CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 4 = 1 THEN NULL ELSE url END AS table_content FROM pages"""


def structured_elements(spark, sf_dir):
    s = tables.structured(spark, sf_dir)
    return metadata.build_table_elements(s.withColumn("source_id", F.col("job_id").cast("string"))
                                         .withColumn("source_name", F.col("source_id")))


@query("select_embeddable", operators=("C7", "B10", "F8"), sql=f"""
SELECT job_id, document_type, length(rag_text) AS n_chars FROM (
  SELECT job_id, document_type, table_content AS rag_text FROM ({STRUCTURED_SQL}) s WHERE table_content <> ''
  UNION ALL
  SELECT job_id, 'text', content FROM ({JOBS_SQL}) j WHERE content <> '') t""")
def select_embeddable_q(spark, sf_dir):
    el = structured_elements(spark, sf_dir).unionByName(
        metadata.project_results(text_elements(spark, sf_dir)).withColumn("uuid", F.lit(None).cast("string")))
    r = vectors.select_rag_texts(filters.select_embeddable(el))
    return r.select("job_id", "document_type", F.length("rag_text").alias("n_chars"))


def _embedded_pieces(spark, sf_dir):
    el = text_elements(spark, sf_dir)
    pieces = filters.select_embeddable(chunk.split_documents(el, "word", 60, 10, 450))
    return embed.merge_embedded(embed.embed_text(pieces, embed.hashing_embedder(64), batch_size=100))


@query("embed_to_vector_rows", operators=("F1", "F3", "F5", "A13", "C8"), sql=f"""
SELECT job_id, CAST(idx - 1 AS INTEGER) AS piece, length(piece) AS text_len, 64 AS dim, true AS has_vector
FROM ({_pieces_sql('word', 60, 10, 450)}) t WHERE piece <> ''""")
def embed_to_vector_rows_q(spark, sf_dir):
    rows = vectors.to_vector_rows(_embedded_pieces(spark, sf_dir), drop_filtered=True)
    return rows.select("job_id", "piece", F.length("text").alias("text_len"), F.size("vector").alias("dim"),
                       F.col("vector").isNotNull().alias("has_vector"))


FILES_SQL = """SELECT concat(source, '/', CAST(doc_id AS VARCHAR), '.', CASE doc_id % 5 WHEN 0 THEN 'pdf'
       WHEN 1 THEN 'docx' WHEN 2 THEN 'PPTX' WHEN 3 THEN 'md' ELSE 'jpg' END) AS path, doc_id AS pos,
       n_chars AS size FROM documents"""
FILES_EXT_SQL = f"SELECT *, lower(regexp_extract(path, '\\.([^./]*)$', 1)) AS ext FROM ({FILES_SQL}) f"

SHARES = {"pdf": 30, "docx": 25, "pptx": 20, "md": 15, "jpg": 10}
TOTAL_BYTES = 1_000_000


@query("dataset_stats", operators=("H12",), sql=f"""
SELECT ext, n_files, n_unique, total_bytes, unique_bytes,
       round(total_bytes / sum(CASE WHEN ext IS NULL THEN total_bytes END) OVER (), 6) AS share
FROM (SELECT ext, sum(copies) AS n_files, count(*) AS n_unique, sum(bytes) AS total_bytes, sum(size1) AS unique_bytes
      FROM (SELECT ext, path, count(*) AS copies, max(size) AS size1, sum(size) AS bytes
            FROM ({FILES_EXT_SQL}) f GROUP BY ext, path) p GROUP BY ROLLUP (ext)) t""")
def dataset_stats_q(spark, sf_dir):
    s = sampling.dataset_stats(tables.files(spark, sf_dir))
    return s.select("ext", "n_files", "n_unique", "total_bytes", "unique_bytes", F.round("share", 6).alias("share"))


@query("scan_inventory", operators=("H15",), sql=f"""
SELECT ext, count(*) AS n_files, sum(size) AS total_bytes FROM ({FILES_EXT_SQL}) f GROUP BY ext""")
def scan_inventory_q(spark, sf_dir):
    return sampling.scan_inventory(tables.files(spark, sf_dir))


def _budget_sql():
    cases = " ".join(f"WHEN '{k}' THEN {v / 100 * TOTAL_BYTES}" for k, v in SHARES.items())
    return f"CASE ext {cases} END"


SAMPLE_SQL = f"""SELECT path, ext, size, cum_bytes FROM (
  SELECT *, sum(size) OVER (PARTITION BY ext ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum_bytes,
         {_budget_sql()} AS budget FROM ({FILES_EXT_SQL}) f) t WHERE cum_bytes <= budget"""


@query("sample_files", operators=("H13",), sql=f"SELECT path, cum_bytes FROM ({SAMPLE_SQL}) s")
def sample_files_q(spark, sf_dir):
    s = sampling.sample_files(tables.files(spark, sf_dir), SHARES, TOTAL_BYTES)
    return s.select("path", F.col("cum_bytes").cast("long").alias("cum_bytes"))


@query("check_sample", operators=("H14",), sql=f"""
SELECT ext, achieved_bytes, {TOTAL_BYTES} * pct / 100.0::DOUBLE AS target_bytes, round(ratio, 6) AS ratio, ratio BETWEEN 0.95 AND 1.05 AS ok
FROM (SELECT ext, pct, achieved_bytes, achieved_bytes / nullif(sum(achieved_bytes) OVER (), 0) / (pct / 100.0::DOUBLE) AS ratio
      FROM (SELECT w.ext, w.pct, CAST(coalesce(sum(s.size), 0) AS BIGINT) AS achieved_bytes
            FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in SHARES.items())}) w(ext, pct) LEFT JOIN ({SAMPLE_SQL}) s ON s.ext = w.ext
            GROUP BY w.ext, w.pct) a) t""")
def check_sample_q(spark, sf_dir):
    s = sampling.sample_files(tables.files(spark, sf_dir), SHARES, TOTAL_BYTES)
    c = sampling.check_sample(s, SHARES, TOTAL_BYTES)
    return c.select("ext", "achieved_bytes", "target_bytes", F.round("ratio", 6).alias("ratio"), "ok")


@query("build_responses", operators=("A9", "A17"), sql=f"""
SELECT job_id, CASE WHEN cm_failed THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN cm_failed THEN 'Failed to process the message.' ELSE 'Successfully processed the message.' END
         AS description,
       CASE WHEN cm_failed THEN NULL ELSE 1 END AS n_data,
       CASE WHEN cm_failed THEN NULL ELSE length(content) END AS data_chars
FROM ({JOBS_SQL}) j""")
def build_responses_q(spark, sf_dir):
    jobs = tables.jobs(spark, sf_dir)
    el = metadata.project_results(metadata.inject_metadata(jobs))
    r = responses.build_responses(jobs, el)
    return r.select("job_id", "status", "description", F.size("data").cast("int").alias("n_data"),
                    F.aggregate(F.col("data"), F.lit(0), lambda a, d: a + F.length(d["metadata"]["content"]))
                    .alias("data_chars")) \
        .withColumn("n_data", F.when(F.col("status") == "failed", F.lit(None)).otherwise(F.col("n_data")))


@query("store_objects", operators=("A12",), sql=f"""
SELECT pos, concat('s3://store/ingest/', url_encode(source_id), '/', CAST(pos AS VARCHAR), '.png') AS uploaded_url
FROM ({IMAGES_SQL.replace('FROM part', ', p_type AS source_id FROM part')}) i""")
def store_objects_q(spark, sf_dir):
    el = image_elements(spark, sf_dir)
    out = sinks.store_objects(el, "s3://store", bucket="ingest", structured=False, images=True)
    return out.select("pos", F.col("metadata.image_metadata.uploaded_image_url").alias("uploaded_url"))


@query("write_by_content_type", operators=("A16", "B13"), sql="""
SELECT 'text' AS type, concat(CAST(doc_id AS VARCHAR), '.metadata.json') AS doc_name, count(*) AS n_elements
FROM documents GROUP BY doc_id""")
def write_by_content_type_q(spark, sf_dir):
    return sinks.by_content_type(text_elements(spark, sf_dir))
