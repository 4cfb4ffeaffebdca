"""Registered queries for the text path: metadata, chunking, text measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as TX
from folio.functions.predicates import doc_type_to_content_type
from folio.operators import chunk, filters, metadata
from folio.plans.registry import query
from folio.plans.sqltext import NON_BLANK_RE2, chunk_pieces_sql
from folio.sources import tables

JOBS_SQL = """SELECT doc_id AS job_id, doc_id AS pos, text AS content, source AS source_id,
       concat(source, '/', CAST(doc_id AS VARCHAR)) AS source_name, 'text' AS document_type, lang,
       (doc_id % 3 <> 0) AS has_split, (doc_id % 5 = 0) AS cm_failed FROM documents"""


def text_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> jobs -> element rows with injected metadata."""
    return metadata.inject_metadata(tables.jobs(spark, sf_dir))


def _chunks_by_source(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.col("metadata.source_metadata.source_id").alias("source_id"))
              .agg(F.count("*").alias("n_chunks"),
                   F.sum(F.length("metadata.content")).alias("n_chars")))


def _pieces_sql(split_by, n, overlap, max_len, source=JOBS_SQL):
    inner = chunk_pieces_sql(source, split_by, n, overlap, max_len, keep="job_id, source_id")
    return f"""SELECT job_id, source_id, p.piece, p.idx FROM ({inner}) c,
      LATERAL (SELECT unnest(c._pieces) AS piece, generate_subscripts(c._pieces, 1) AS idx) p
      WHERE regexp_matches(p.piece, '{NON_BLANK_RE2}')"""


@query("split_chunks_by_source", operators=("A5", "B1", "D1", "D2", "D3", "D5", "C7"), sql=f"""
SELECT source_id, count(*) AS n_chunks, sum(length(piece)) AS n_chars
FROM ({_pieces_sql('word', 60, 10, 450)}) t WHERE piece <> '' GROUP BY source_id""")
def split_chunks_by_source(spark, sf_dir):
    """Flagship: documents -> metadata -> word chunks (60/10, 450 chars) -> embeddable
    text -> chunk and character counts per source."""
    el = text_elements(spark, sf_dir)
    pieces = chunk.split_documents(el, "word", 60, 10, 450)
    return _chunks_by_source(filters.select_embeddable(pieces))


@query("split_sentence_pieces", operators=("D1", "D2", "D3", "D5"), sql=f"""
SELECT job_id, CAST(idx - 1 AS INTEGER) AS piece, length(piece) AS n_chars, md5(piece) AS piece_md5
FROM ({_pieces_sql('sentence', 10, 0, 1024)}) t""")
def split_sentence_pieces(spark, sf_dir):
    """Every sentence piece (10 sentences, no overlap, 1024 chars) with its hash."""
    el = text_elements(spark, sf_dir)
    p = chunk.split_documents(el, "sentence", 10, 0, 1024)
    return p.select("job_id", "piece", F.length("metadata.content").alias("n_chars"),
                    F.md5("metadata.content").alias("piece_md5"))


PASSAGES_SQL = """SELECT doc_id AS job_id, source AS source_id,
  replace(text, chr(10), chr(10) || chr(10)) AS content FROM documents"""


@query("split_passage_pieces", operators=("D1", "D2", "D3", "D5"), sql=f"""
SELECT job_id, CAST(idx - 1 AS INTEGER) AS piece, length(piece) AS n_chars, md5(piece) AS piece_md5
FROM ({_pieces_sql('passage', 1, 0, 450, PASSAGES_SQL)}) t""")
def split_passage_pieces(spark, sf_dir):
    """Passage split (one paragraph per piece, cut at 450 chars) on blank-line text."""
    p = tables.passages(spark, sf_dir).select(
        "job_id", F.col("job_id").alias("pos"), "content", "source_id",
        F.col("source_id").alias("source_name"), F.lit("text").alias("document_type"))
    el = metadata.inject_metadata(p)
    out = chunk.split_documents(el, "passage", 1, 0, 450)
    return out.select("job_id", "piece", F.length("metadata.content").alias("n_chars"),
                      F.md5("metadata.content").alias("piece_md5"))


def _window_sql():
    inner = chunk_pieces_sql(JOBS_SQL, "sentence", 3, 2, 100, keep="job_id")
    return f"""
SELECT job_id, CAST(idx - 1 AS INTEGER) AS piece, md5(piece) AS piece_md5, md5(win) AS window_md5
FROM (
  SELECT job_id, p.idx, p.piece,
         array_to_string(list_slice(c._pieces, greatest(p.idx - 2, 0) + 1, least(p.idx + 1, len(c._pieces))), '') AS win
  FROM ({inner}) c,
       LATERAL (SELECT unnest(c._pieces) AS piece, generate_subscripts(c._pieces, 1) AS idx) p
) t WHERE regexp_matches(piece, '{NON_BLANK_RE2}')"""


@query("sentence_window_pieces", operators=("D4", "D5"), sql=_window_sql())
def sentence_window_pieces(spark, sf_dir):
    """Sentence split 3/2/100 with a +-1 piece window around every piece."""
    el = text_elements(spark, sf_dir)
    p = chunk.split_documents(el, "sentence", 3, 2, 100, sentence_window_size=1)
    return p.select("job_id", "piece", F.md5("metadata.content").alias("piece_md5"),
                    F.md5("metadata.window").alias("window_md5"))


@query("inject_metadata", operators=("B1", "B2", "A17"), sql="""
SELECT doc_id AS job_id, 'text' AS document_type, 'text' AS content_type, 'document' AS text_type,
       source AS source_id, concat(source, '/', CAST(doc_id AS VARCHAR)) AS source_name,
       'text' AS source_type, length(text) AS n_chars, false AS has_image_metadata FROM documents""")
def inject_metadata_q(spark, sf_dir):
    el = metadata.project_results(text_elements(spark, sf_dir))
    m = F.col("metadata")
    return el.select(
        "job_id", "document_type", m["content_metadata"]["type"].alias("content_type"),
        m["text_metadata"]["text_type"].alias("text_type"),
        m["source_metadata"]["source_id"].alias("source_id"),
        m["source_metadata"]["source_name"].alias("source_name"),
        m["source_metadata"]["source_type"].alias("source_type"),
        F.length(m["content"]).alias("n_chars"),
        m["image_metadata"].isNotNull().alias("has_image_metadata"))


@query("doc_type_to_content_type", operators=("B2", "A5"), sql="""
SELECT path, CASE lower(regexp_extract(path, '\\.([^./]*)$', 1))
    WHEN 'pdf' THEN 'pdf' WHEN 'docx' THEN 'docx' WHEN 'pptx' THEN 'pptx' WHEN 'md' THEN 'text'
    WHEN 'jpg' THEN 'jpeg' END AS document_type,
  CASE lower(regexp_extract(path, '\\.([^./]*)$', 1))
    WHEN 'pdf' THEN 'structured' WHEN 'docx' THEN 'structured' WHEN 'pptx' THEN 'structured'
    WHEN 'md' THEN 'text' WHEN 'jpg' THEN 'image' END AS content_type
FROM (SELECT concat(source, '/', CAST(doc_id AS VARCHAR), '.', CASE doc_id % 5 WHEN 0 THEN 'pdf'
      WHEN 1 THEN 'docx' WHEN 2 THEN 'PPTX' WHEN 3 THEN 'md' ELSE 'jpg' END) AS path FROM documents) f""")
def doc_type_to_content_type_q(spark, sf_dir):
    from folio.sources.files import infer_document_type
    f = infer_document_type(tables.files(spark, sf_dir), "path")
    return f.select("path", "document_type",
                    doc_type_to_content_type(F.col("document_type")).alias("content_type"))


@query("estimate_pages", operators=("D19",), sql=f"""
SELECT doc_id AS job_id,
  CAST(round_even(len(list_filter(regexp_split_to_array(text, '[\\t\\n\\x{{0B}}\\f\\r \\x{{1C}}-\\x{{1F}}\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'), lambda w: w <> '')) / 300.0, 0) AS BIGINT) AS estimated_pages
FROM documents""")
def estimate_pages_q(spark, sf_dir):
    j = tables.jobs(spark, sf_dir)
    return chunk.estimate_pages(j, "document_type", "content").select("job_id", "estimated_pages")


@query("ascii_sanitize", operators=("D7",), sql="""
SELECT doc_id AS job_id, md5(regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g')) AS sanitized_md5,
       length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS n_replaced
FROM documents""")
def ascii_sanitize_q(spark, sf_dir):
    d = tables.load(spark, sf_dir, "documents")
    s = TX.ascii_sanitize(F.col("text"))
    return d.select(F.col("doc_id").alias("job_id"), F.md5(s).alias("sanitized_md5"),
                    (F.length("text") - F.length(F.regexp_replace("text", "[^\\x{00}-\\x{7F}]", "")))
                    .alias("n_replaced"))


@query("clean_filename", operators=("B13", "B14"), sql="""
SELECT page_id, CASE WHEN c IN ('', '.', '..') THEN NULL ELSE c END AS file_name, m AS metric_name
FROM (SELECT page_id,
        regexp_replace(replace(regexp_replace(url, '^\\s+|\\s+$', '', 'g'), ' ', '_'), '[^-\\pL\\pN_.]', '', 'g') AS c,
        left(regexp_replace(replace(url, ' ', '_'), '[^A-Za-z0-9_]', '', 'g'), 63) AS m FROM pages) t""")
def clean_filename_q(spark, sf_dir):
    p = tables.load(spark, sf_dir, "pages")
    return p.select("page_id", TX.clean_filename(F.col("url")).alias("file_name"),
                    TX.sanitize_metric_name(F.col("url")).alias("metric_name"))
