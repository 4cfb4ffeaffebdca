"""Registered queries: routing, validation, layout tokens, language, task runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import chunk, filters, language, layout, metadata
from folio.plans.pipeline import run_tasks
from folio.plans.q_text import JOBS_SQL, _pieces_sql, text_elements
from folio.plans.registry import query
from folio.sources import tables


@query("route_by_task", operators=("C1", "C4", "C10"), sql=f"""
SELECT job_id, count(*) AS n_rows FROM (
  SELECT j.job_id FROM ({JOBS_SQL}) j WHERE NOT has_split OR cm_failed
  UNION ALL
  SELECT job_id FROM ({_pieces_sql('word', 60, 10, 450)}) p
  WHERE job_id IN (SELECT job_id FROM ({JOBS_SQL}) j WHERE has_split AND NOT cm_failed)) t
GROUP BY job_id""")
def route_by_task_q(spark, sf_dir):
    el = text_elements(spark, sf_dir)

    def split_text(d):
        return filters.filter_by_document_type(d, "text", lambda t: chunk.split_documents(t, "word", 60, 10, 450))
    routed = filters.skip_failed(el, lambda d: filters.route_by_task(d, "split", split_text,
                                                                    task_col=F.col("has_split")))
    return routed.groupBy("job_id").agg(F.count("*").alias("n_rows"))


@query("validate_metadata", operators=("B3", "B7"), sql="""
SELECT doc_id AS job_id, 0 AS n_violations, 'en' AS language, -1 AS page_number, 1 AS access_level,
       -1 AS partition_id FROM documents""")
def validate_metadata_q(spark, sf_dir):
    j = metadata.build_source_metadata(tables.jobs(spark, sf_dir))
    el = metadata.inject_metadata(j).withColumn(
        "metadata", F.col("metadata").withField("source_metadata", F.col("source_metadata")))
    v = metadata.validate_metadata(el)
    return v.select("job_id", F.size("metadata_violations").alias("n_violations"),
                    F.col("metadata.text_metadata.language").alias("language"),
                    F.col("metadata.content_metadata.page_number").alias("page_number"),
                    F.col("metadata.source_metadata.access_level").alias("access_level"),
                    F.col("metadata.source_metadata.partition_id").alias("partition_id"))


LAYOUT_SRC_SQL = """SELECT o_orderkey AS page_id,
  concat('<x_', CAST(o_custkey % 900 AS VARCHAR), '><y_', CAST(o_orderkey % 1200 AS VARCHAR), '>',
         o_orderpriority, '<x_', CAST(o_custkey % 900 + 100 AS VARCHAR), '><y_',
         CAST(o_orderkey % 1200 + 40 AS VARCHAR), '><class_',
         CASE o_orderstatus WHEN 'F' THEN 'Text' WHEN 'O' THEN 'Page-header' ELSE 'Table' END, '>',
         '<x_1><y_2>', o_orderstatus, '<x_3><y_4><class_Title>') AS raw FROM orders"""

TOKEN_RE2 = "(?s)<x_(\\d+)><y_(\\d+)>(.*?)<x_(\\d+)><y_(\\d+)><class_([^>]+)>"


@query("parse_layout_tokens", operators=("D9", "C9"), sql=f"""
SELECT page_id, CAST(t.i - 1 AS INTEGER) AS token, t.cls AS class, CAST(t.x1 AS BIGINT) AS x1,
       CASE WHEN t.cls IN ('Text', 'Title', 'Section-header', 'List-item', 'TOC', 'Bibliography', 'Formula')
            THEN t.txt ELSE '' END AS text
FROM (SELECT page_id, regexp_extract_all(raw, '{TOKEN_RE2}', 6) AS c, regexp_extract_all(raw, '{TOKEN_RE2}', 1) AS x,
             regexp_extract_all(raw, '{TOKEN_RE2}', 3) AS tx FROM ({LAYOUT_SRC_SQL}) s) r,
     LATERAL (SELECT unnest(r.c) AS cls, unnest(r.x) AS x1, unnest(r.tx) AS txt,
                     generate_subscripts(r.c, 1) AS i) t""")
def parse_layout_tokens_q(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders")
    s = lambda c: F.col(c).cast("string")
    raw = F.concat(
        F.lit("<x_"), (F.col("o_custkey") % 900).cast("string"), F.lit("><y_"), (F.col("o_orderkey") % 1200).cast("string"),
        F.lit(">"), s("o_orderpriority"), F.lit("<x_"), (F.col("o_custkey") % 900 + 100).cast("string"), F.lit("><y_"),
        (F.col("o_orderkey") % 1200 + 40).cast("string"), F.lit("><class_"),
        F.when(F.col("o_orderstatus") == "F", "Text").when(F.col("o_orderstatus") == "O", "Page-header")
         .otherwise("Table"), F.lit(">"), F.lit("<x_1><y_2>"), s("o_orderstatus"), F.lit("<x_3><y_4><class_Title>"))
    t = layout.parse_layout_tokens(o.select(F.col("o_orderkey").alias("page_id"), raw.alias("raw")))
    t = filters.filter_by_class(t, "class", "text")
    return t.select("page_id", F.col("token").cast("int"), "class", "x1", "text")


@query("markdown_to_plain", operators=("D8",))
def markdown_to_plain_q(spark, sf_dir):
    """Cleanup chain over every document (no SQL oracle: it needs look-behind)."""
    d = tables.load(spark, sf_dir, "documents")
    return d.select("doc_id", F.length(layout.markdown_to_plain(F.col("text"))).alias("plain_chars"))


@query("detect_language", operators=("D6",), sql="""
SELECT doc_id, lang, CASE WHEN greatest(n_fr, greatest(n_es, greatest(n_en, n_de))) >= 2 THEN CASE WHEN n_fr > greatest(n_es, greatest(n_en, n_de)) THEN 'fr' ELSE CASE WHEN n_es > greatest(n_en, n_de) THEN 'es' ELSE CASE WHEN n_en > n_de THEN 'en' ELSE 'de' END END END ELSE 'unknown' END AS language FROM (
  SELECT doc_id, lang,
         len(list_filter(w, lambda x: x IN ('der', 'die', 'das', 'und', 'ist', 'nicht', 'ein', 'eine', 'zu', 'den', 'mit', 'von', 'sich', 'auf'))) AS n_de,
         len(list_filter(w, lambda x: x IN ('the', 'and', 'of', 'to', 'is', 'in', 'it', 'that', 'with', 'for', 'on', 'as', 'are', 'this', 'by'))) AS n_en,
         len(list_filter(w, lambda x: x IN ('el', 'los', 'las', 'y', 'es', 'un', 'una', 'por', 'con', 'para', 'del', 'que', 'se', 'como'))) AS n_es,
         len(list_filter(w, lambda x: x IN ('le', 'la', 'les', 'de', 'des', 'et', 'un', 'une', 'du', 'en', 'est', 'que', 'qui', 'pour', 'dans'))) AS n_fr
  FROM (SELECT doc_id, lang, regexp_split_to_array(lower(text), '[^\\pL]+') AS w FROM documents) d) t""")
def detect_language_q(spark, sf_dir):
    """Stop-word vote per document (the default detector; a pandas UDF can replace it)."""
    d = tables.load(spark, sf_dir, "documents")
    return chunk.detect_language(d, "text").select("doc_id", "lang", "language")


@query("ingest_text_jobs", operators=("C1", "C5", "C6", "D5", "A17"), sql=f"""
SELECT job_id, count(*) AS n_elements FROM ({_pieces_sql('sentence', 10, 0, 1024)}) p GROUP BY job_id""")
def ingest_text_jobs_q(spark, sf_dir):
    tasks = [{"type": "dedup", "task_properties": {"content_type": "image", "params": {"filter": True}}},
             {"type": "filter", "task_properties": {"content_type": "image", "params": {"min_size": 128}}},
             {"type": "split", "task_properties": {"split_by": "sentence", "split_length": 10, "split_overlap": 0,
                                                   "max_character_length": 1024}}]
    el = run_tasks(tables.jobs(spark, sf_dir).drop("cm_failed"), tasks)  # all jobs, whatever intake said of them
    return el.groupBy("job_id").agg(F.count("*").alias("n_elements"))


@query("ingest_accepted_jobs", operators=("C4", "C5", "C6", "D5"), sql=f"""
SELECT job_id, sum(n) AS n_elements FROM (
  SELECT p.job_id, 1 AS n FROM ({_pieces_sql('sentence', 10, 0, 1024)}) p JOIN (SELECT job_id FROM ({JOBS_SQL}) j WHERE NOT cm_failed) ok ON p.job_id = ok.job_id
  UNION ALL
  SELECT job_id, 1 FROM ({JOBS_SQL}) j WHERE cm_failed) t
GROUP BY job_id""")
def ingest_accepted_jobs_q(spark, sf_dir):
    """The same tasks where jobs that failed at intake skip every stage: their documents stay whole."""
    tasks = [{"type": "dedup", "task_properties": {}}, {"type": "filter", "task_properties": {}},
             {"type": "split", "task_properties": {"split_by": "sentence", "split_length": 10, "split_overlap": 0, "max_character_length": 1024}}]
    return run_tasks(tables.jobs(spark, sf_dir), tasks).groupBy("job_id").agg(F.count("*").alias("n_elements"))


@query("extract_text_jobs", operators=("G1", "D10", "C4"), sql="""
SELECT doc_id // 10 AS job_id, doc_id % 10 AS pos, length(t) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\\n\\s*\\n'),
         lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g')), lambda p: p <> ''), ' ') AS t
  FROM documents WHERE text IS NOT NULL) x WHERE t <> ''""")
def extract_text_jobs_q(spark, sf_dir):
    """Documents as Markdown files of jobs of ten, run through the extract task of the runner."""
    d = tables.load(spark, sf_dir, "documents").where("text IS NOT NULL")
    jobs = d.select(F.floor(F.col("doc_id") / 10).alias("job_id"), (F.col("doc_id") % 10).alias("pos"), F.lit("md").alias("document_type"),
                    F.col("text").alias("content"), F.col("source").alias("source_id"), F.col("source").alias("source_name"))
    el = run_tasks(jobs, [{"type": "extract", "task_properties": {"document_type": "md", "method": "plain", "params": {"extract_text": True}}}])
    text = F.col("metadata.content")
    return el.where("NOT cm_failed").select("job_id", "pos", F.char_length(text).cast("long").alias("n_chars"), F.md5(text).alias("text_md5"))


@query("detect_language_profiles", operators=("D6",))
def detect_language_profiles_q(spark, sf_dir):
    """Trigram profiles learned from three quarters of the documents, and every document's language by
    them (accuracy on the others, and the profiles, are checked in tests)."""
    d = tables.load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.learn_profiles(d.where(F.col("doc_id") % 4 != 0))
    return chunk.detect_language(d, "text", fn=language.detector(profiles)).select("doc_id", "lang", "language")
