"""Registered queries for the remaining operators: payload unpacking, styled runs, chart
text, dates, CSV tables, box post-processing chain, fragments, hosted-service elements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.functions.dates import parse_pdf_date, validate_iso8601
from folio.operators import assemble, chunk, detect, responses
from folio.plans.q_text import text_elements
from folio.plans.registry import query
from folio.sources import files, tables


@query("unpack_payload", operators=("A2", "D20"), sql="""
SELECT doc_id // 10 AS job_id, doc_id % 10 AS pos, source AS source_id, 'text' AS document_type,
       length(text) AS n_chars FROM documents""")
def unpack_payload_q(spark, sf_dir):
    """Jobs of up to ten documents (parallel payload lists) unpacked to one row each."""
    d = tables.load(spark, sf_dir, "documents")
    grouped = d.groupBy((F.col("doc_id") / 10).cast("long").alias("job_id")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "text", "source"))).alias("_d"))
    jobs = grouped.select("job_id", F.struct(
        F.transform("_d", lambda x: x["text"]).alias("content"),
        F.transform("_d", lambda x: x["source"]).alias("source_name"),
        F.transform("_d", lambda x: x["source"]).alias("source_id"),
        F.transform("_d", lambda x: F.lit("TEXT")).alias("document_type")).alias("job_payload"))
    rows = files.unpack_payload(jobs)
    ex = chunk.explode_extractions(rows.select("job_id", F.array(F.struct(
        "pos", "source_id", "document_type", F.length("content").alias("n_chars"))).alias("extracted")))
    return ex.select("job_id", F.col("pos").cast("long"), "source_id", "document_type", "n_chars")


RUNS_SQL = """SELECT l_orderkey AS job_id, l_linenumber % 2 AS paragraph,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
  CASE WHEN l_partkey % 5 = 0 THEN ' ' ELSE concat(l_returnflag, CAST(l_partkey AS VARCHAR), ' ') END AS text,
  l_quantity > 25 AS bold, l_discount > 0.05 AS italic, false AS underline FROM lineitem"""


@query("merge_styled_runs", operators=("D15",), sql=f"""
WITH r AS (SELECT *, CASE WHEN regexp_matches(text, '\\S') THEN struct_pack(b := bold, i := italic, u := underline) END AS s
           FROM ({RUNS_SQL}) x),
e AS (SELECT *, last(s IGNORE NULLS) OVER (PARTITION BY job_id, paragraph ORDER BY pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS eff FROM r),
c AS (SELECT *, CASE WHEN lag(eff) OVER w <> eff THEN 1 ELSE 0 END AS chg
      FROM e WINDOW w AS (PARTITION BY job_id, paragraph ORDER BY pos)),
g AS (SELECT *, sum(chg) OVER (PARTITION BY job_id, paragraph ORDER BY pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_group FROM c)
SELECT job_id, paragraph, run_group, min(pos) AS pos, string_agg(text, '' ORDER BY pos) AS text,
       coalesce(arg_max(eff, pos).b, false) AS bold, coalesce(arg_max(eff, pos).i, false) AS italic
FROM g GROUP BY job_id, paragraph, run_group""")
def merge_styled_runs_q(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    runs = li.select(
        F.col("l_orderkey").alias("job_id"), (F.col("l_linenumber") % 2).alias("paragraph"),
        F.row_number().over(w).cast("long").alias("pos"),
        F.when(F.col("l_partkey") % 5 == 0, " ").otherwise(
            F.concat("l_returnflag", F.col("l_partkey").cast("string"), F.lit(" "))).alias("text"),
        (F.col("l_quantity") > 25).alias("bold"), (F.col("l_discount") > 0.05).alias("italic"),
        F.lit(False).alias("underline"))
    m = assemble.merge_styled_runs(runs)
    return m.select("job_id", "paragraph", F.col("run_group").cast("bigint"), "pos", "text", "bold", "italic")


@query("join_chart_text", operators=("D18",), sql="""
SELECT event_id, CASE WHEN user_id % 4 = 0 THEN ' ' || event_type
  ELSE coalesce(json_extract_string(props, '$.chart_title'), '') || ' ' || event_type || ' '
       || coalesce(json_extract_string(props, '$.caption'), '') || repeat(' ', 10) END AS chart_text
FROM events""")
def join_chart_text_q(spark, sf_dir):
    """Cached model JSON = the event props (no chart keys: empty fields), model text =
    the event type; every fourth user has no cached text."""
    e = tables.load(spark, sf_dir, "events")
    cached = F.when(F.col("user_id") % 4 != 0, F.col("props"))
    return e.select("event_id", assemble.join_chart_text(cached, F.col("event_type")).alias("chart_text"))


@query("parse_pdf_date", operators=("B5", "B6"), sql="""
SELECT event_id, strftime(ts - (INTERVAL 1 MINUTE) * ((user_id % 13 - 6) * 60 + user_id % 2 * 30), '%Y-%m-%dT%H:%M:%S') AS utc_iso,
       true AS valid_iso
FROM events""")
def parse_pdf_date_q(spark, sf_dir):
    """PDF dates built from event times with a zone derived from the user; parsed back to
    UTC ISO text, which must validate as ISO-8601."""
    e = tables.load(spark, sf_dir, "events")
    off_min = (F.col("user_id") % 13 - 6) * 60 + (F.col("user_id") % 2) * 30
    sign = F.when(off_min < 0, "-").otherwise("+")
    a = F.abs(off_min)
    zone = F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"), F.lit("'"),
                    F.lpad((a % 60).cast("string"), 2, "0"), F.lit("'"))
    pdf_date = F.concat(F.lit("D:"), F.date_format("ts", "yyyyMMddHHmmss"), zone)
    iso = parse_pdf_date(pdf_date)
    return e.select("event_id", iso.alias("utc_iso"), validate_iso8601(iso).alias("valid_iso"))


CELLS_SQL = """SELECT table_id, ridx, c.col, c.text FROM (
  SELECT l_orderkey AS table_id, l_returnflag, l_shipdate, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS ridx
  FROM lineitem) l,
  LATERAL (SELECT unnest([0, 1]) AS col,
                  unnest([l_returnflag || ',' || CAST(l_partkey AS VARCHAR), CAST(l_partkey % 7 AS VARCHAR)]) AS text) c"""


@query("render_table_csv", operators=("D17",), sql=f"""
SELECT table_id, md5(string_agg(r, chr(10) ORDER BY ridx) || chr(10)) AS table_md5 FROM (
  SELECT table_id, ridx, CASE WHEN ridx = 0 THEN ',' ELSE CAST(ridx - 1 AS VARCHAR) || ',' END
         || string_agg(CASE WHEN regexp_matches(text, '[,"\\n\\r]') THEN '"' || replace(text, '"', '""') || '"'
                            ELSE text END, ',' ORDER BY col) AS r
  FROM ({CELLS_SQL}) c GROUP BY table_id, ridx) t GROUP BY table_id""")
def render_table_csv_q(spark, sf_dir):
    li = assemble.spread(tables.load(spark, sf_dir, "lineitem"), ["l_orderkey"])
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = li.select(F.col("l_orderkey").alias("table_id"), (F.row_number().over(w) - 1).alias("row"),
                     F.array(F.concat("l_returnflag", F.lit(","), F.col("l_partkey").cast("string")),
                             (F.col("l_partkey") % 7).cast("string")).alias("_c"))
    cells = rows.select("table_id", "row", F.posexplode("_c").alias("col", "text"))
    return assemble.render_table(cells, "csv", scope=("table_id",)).select(
        "table_id", F.md5("table").alias("table_md5"))


@query("box_postprocess", operators=("E7", "E8", "E9", "E10"))
def box_postprocess_q(spark, sf_dir):
    """Suppression -> fusion -> title claiming -> expansion on every image of the
    detections view (sequential per image; rows-only check, brute force in tests)."""
    d = tables.detections(spark, sf_dir).withColumn("box_id", F.col("box_id").cast("long"))
    large = detect.large_images(d)
    out = detect.expand_boxes(detect.match_titles(detect.fuse_boxes(detect.nms(d, large=large), large=large), large=large))
    return out.select("image_id", "box_id", "label", F.round("x1", 6).alias("x1"), F.round("y2", 6).alias("y2"),
                      "titled")


FRAGMENT_BYTES = 65536


@query("fragment_responses", operators=("A10",), sql=f"""
WITH RECURSIVE
items AS (SELECT source, doc_id, coalesce(strlen(text), 0) + 49 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn,
                 sum(coalesce(strlen(text), 0) + 2) OVER (PARTITION BY source) + 49 AS total FROM documents),
walk AS (
  SELECT source, rn, 51 + s AS cur, CASE WHEN 51 + s > {FRAGMENT_BYTES} THEN 1 ELSE 0 END AS frag FROM items WHERE rn = 1 AND total > {FRAGMENT_BYTES}
  UNION ALL
  SELECT i.source, i.rn, CASE WHEN w.cur + i.s > {FRAGMENT_BYTES} THEN 51 + i.s ELSE w.cur + i.s END,
         w.frag + CASE WHEN w.cur + i.s > {FRAGMENT_BYTES} THEN 1 ELSE 0 END
  FROM walk w JOIN items i ON i.source IS NOT DISTINCT FROM w.source AND i.rn = w.rn + 1)
SELECT i.doc_id, CAST(coalesce(w.frag, 0) AS bigint) AS fragment,
       CAST(coalesce(max(w.frag) OVER (PARTITION BY i.source), 0) + 1 AS bigint) AS fragment_count
FROM items i LEFT JOIN walk w ON i.source IS NOT DISTINCT FROM w.source AND i.rn = w.rn""")
def fragment_responses_q(spark, sf_dir):
    """Every source's documents, sized by their text, packed into fragments of at most 64 KiB."""
    d = tables.load(spark, sf_dir, "documents").select(
        F.col("source").alias("job_id"), F.col("doc_id").alias("pos"), F.lit("text").alias("document_type"),
        F.struct(F.lit(None).cast("string").alias("content")).alias("metadata"), F.octet_length("text").alias("n_bytes"))
    packed = responses.fragment_responses(d, size_limit=FRAGMENT_BYTES, size_col="n_bytes")
    return packed.select(F.col("pos").alias("doc_id"), "fragment", "fragment_count")


@query("reassemble_responses", operators=("A9", "A10", "A11"), sql="""
SELECT source AS job_id, 'success' AS status, count(*) AS n_items, md5(string_agg(md5(coalesce(text, '')), '' ORDER BY doc_id)) AS data_md5
FROM documents WHERE source IS NOT NULL GROUP BY source""")
def reassemble_responses_q(spark, sf_dir):
    """Responses of every source in fragments of 64 KiB, the first ones delivered twice, put together again."""
    el = text_elements(spark, sf_dir).withColumn("job_id", F.col("metadata.source_metadata.source_id")).where(F.col("job_id").isNotNull())
    jobs = el.select("job_id", F.lit(False).alias("cm_failed")).distinct()
    sent = responses.build_responses(jobs, el, size_limit=FRAGMENT_BYTES)
    back = responses.reassemble_responses(sent.unionByName(sent.where("fragment = 0")))
    texts = F.transform("data", lambda e: F.md5(F.coalesce(e["metadata"]["content"], F.lit(""))))
    return back.select("job_id", "status", F.size("data").cast("long").alias("n_items"), F.md5(F.array_join(texts, "")).alias("data_md5"))


@query("layout_detections", operators=("E5", "E7", "E8", "E9", "E10"))
def layout_detections_q(spark, sf_dir):
    """The full detector post-processing chain on raw predictions (rows-only)."""
    from folio.plans.q_layout import _raw
    out = detect.layout_detections(_raw(spark, sf_dir))
    return out.select("image_id", "box_id", "label", F.round("score", 4).alias("score"))

