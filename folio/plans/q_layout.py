"""Registered queries: document assembly (roll-ups, order, captions, styling, tables)
and detection post-processing (scores, overlaps, expansion)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators import assemble, detect
from folio.plans.q_images import BLOCKS_SQL
from folio.plans.registry import query
from folio.sources import tables


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with their document (= order) as the assembly scope."""
    return tables.blocks(spark, sf_dir).withColumn("doc", F.floor(F.col("pos") / 100))


B_SQL = f"SELECT *, pos // 100 AS doc FROM ({BLOCKS_SQL}) b"


@query("rollup_text_page", operators=("D10",), sql=f"""
SELECT doc AS job_id, page, md5(string_agg(text, ' ' ORDER BY pos)) AS text_md5, count(*) AS n_pieces
FROM ({B_SQL}) b GROUP BY doc, page""")
def rollup_text_page_q(spark, sf_dir):
    """Pages of an order: their number grows with the table."""
    b = _blocks(spark, sf_dir).drop("job_id").withColumnRenamed("doc", "job_id")
    r = assemble.rollup_text(b, depth="page", sep=" ")
    return r.select("job_id", "page", F.md5("text").alias("text_md5"), "n_pieces")


@query("rollup_text_document", operators=("D10",), sql=f"""
SELECT doc AS job_id, md5(string_agg(text, '' ORDER BY pos)) AS text_md5, count(*) AS n_pieces
FROM ({B_SQL}) b GROUP BY doc""")
def rollup_text_document_q(spark, sf_dir):
    b = _blocks(spark, sf_dir).drop("job_id").withColumnRenamed("doc", "job_id")
    r = assemble.rollup_text(b, depth="document", sep="")
    return r.select("job_id", F.md5("text").alias("text_md5"), "n_pieces")


@query("order_shapes", operators=("D13",), sql=f"""
SELECT pos, row_number() OVER (PARTITION BY doc, page ORDER BY y1, x1, pos) AS reading_order FROM ({B_SQL}) b""")
def order_shapes_q(spark, sf_dir):
    b = _blocks(spark, sf_dir).withColumnRenamed("y1", "top").withColumnRenamed("x1", "left")
    return assemble.order_shapes(b, scope=("doc", "page")).select("pos", F.col("reading_order").cast("long"))


@query("nearby_blocks", operators=("D11",), sql=f"""
SELECT pos, n_nearby, last_text FROM (
  SELECT pos, text_type,
         count(CASE WHEN text_type = 'nearby_block' THEN 1 END) OVER w AS n_nearby,
         last(CASE WHEN text_type = 'nearby_block' THEN text END IGNORE NULLS) OVER w AS last_text
  FROM ({B_SQL}) b
  WINDOW w AS (PARTITION BY doc ORDER BY y1, x1, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) t
WHERE text_type = 'body'""")
def nearby_blocks_q(spark, sf_dir):
    b = (_blocks(spark, sf_dir)
         .withColumn("is_image", F.col("text_type") == "body")
         .withColumn("text", F.when(F.col("is_image"), F.lit("")).otherwise(F.col("text")))
         .withColumnRenamed("y1", "top").withColumnRenamed("x1", "left")
         .withColumn("x1", F.col("left")).withColumn("y1", F.col("top")))
    r = assemble.nearby_pointers(b, scope=("doc",), order_cols=("top", "left", "pos"))
    return r.where("is_image").select("pos", F.col("nearby_count").alias("n_nearby"), F.col("nearby_last").alias("last_text"))


@query("nearby_block_lists", operators=("D11",), sql=f"""
SELECT pos, len(t) AS n_nearby, md5(array_to_string(t, chr(10))) AS texts_md5 FROM (
  SELECT pos, text_type, coalesce(array_agg(text ORDER BY y1, x1, pos) FILTER (WHERE text_type = 'nearby_block') OVER (
           PARTITION BY doc, page ORDER BY y1, x1, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), []) AS t
  FROM ({B_SQL}) b) x
WHERE text_type = 'body'""")
def nearby_block_lists_q(spark, sf_dir):
    """The texts themselves, page by page of an order."""
    b = (_blocks(spark, sf_dir)
         .withColumn("is_image", F.col("text_type") == "body")
         .withColumn("text", F.when(F.col("is_image"), F.lit("")).otherwise(F.col("text")))
         .withColumnRenamed("y1", "top").withColumnRenamed("x1", "left")
         .withColumn("x1", F.col("left")).withColumn("y1", F.col("top")))
    r = assemble.nearby_blocks(b, scope=("doc", "page"))
    return r.where("is_image").select("pos", F.size("nearby_text").cast("long").alias("n_nearby"), F.md5(F.array_join("nearby_text", "\n")).alias("texts_md5"))


@query("caption_from_next_block", operators=("D12",), sql=f"""
SELECT pos, coalesce(first(CASE WHEN text_type = 'nearby_block' THEN text END IGNORE NULLS)
         OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS caption
FROM ({B_SQL}) b QUALIFY text_type = 'body'""")
def caption_from_next_block_q(spark, sf_dir):
    b = _blocks(spark, sf_dir).withColumn(
        "kind", F.when(F.col("text_type") == "body", "image").otherwise("paragraph"))
    r = assemble.caption_from_next_block(b, scope=("doc",))
    return r.where(F.col("kind") == "image").select("pos", "caption")


RUNS_SQL = f"""SELECT pos, concat(' ', text, '-', CAST(page AS VARCHAR), '.(x) ') AS text,
  pos % 2 = 0 AS bold, pos % 3 = 0 AS italic, pos % 5 = 0 AS underline FROM ({BLOCKS_SQL}) b"""


def _esc_sql(c):
    return f"regexp_replace({c}, '([\\\\*`!_{{}}\\[\\]()#+,\\-.])', '\\\\\\1', 'g')"


@query("render_markdown_text", operators=("D14",), sql=f"""
SELECT pos, concat(' ',
  CASE WHEN italic THEN concat('*', e, '*') WHEN bold THEN concat('**', e, '**')
       WHEN underline THEN concat('<u>', e, '</u>') ELSE e END, ' ') AS markdown
FROM (SELECT *, {_esc_sql("trim(text)")} AS e FROM ({RUNS_SQL}) r) t""")
def render_markdown_text_q(spark, sf_dir):
    b = tables.blocks(spark, sf_dir)
    runs = b.select("pos", F.concat(F.lit(" "), "text", F.lit("-"), F.col("page").cast("string"),
                                    F.lit(".(x) ")).alias("text"),
                    (F.col("pos") % 2 == 0).alias("bold"), (F.col("pos") % 3 == 0).alias("italic"),
                    (F.col("pos") % 5 == 0).alias("underline"))
    return assemble.render_markdown_text(runs, single_style=True).select("pos", "markdown")


@query("apply_text_style", operators=("D16",), sql=f"""
SELECT pos, concat(repeat(chr(9), CAST(page AS INTEGER) % 3),
  CASE page WHEN 0 THEN concat('# ', text) WHEN 1 THEN concat('### ', text) WHEN 2 THEN concat('- ', text)
            WHEN 3 THEN concat(text, chr(10), repeat('=', length(text)))
            ELSE concat(text, chr(10), repeat('-', length(text))) END) AS styled
FROM ({BLOCKS_SQL}) b""")
def apply_text_style_q(spark, sf_dir):
    b = tables.blocks(spark, sf_dir)
    style = (F.when(F.col("page") == 0, "Heading 1").when(F.col("page") == 1, "Heading 3")
             .when(F.col("page") == 2, "List Bullet").when(F.col("page") == 3, "Title").otherwise("Subtitle"))
    s = b.select("pos", "text", style.alias("style"), (F.col("page") % 3).cast("int").alias("level"))
    return assemble.apply_text_style(s).select("pos", "styled")


CELLS_SQL = """SELECT table_id, ridx, c.col, c.text FROM (
  SELECT l_orderkey AS table_id, l_returnflag, l_linestatus, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS ridx
  FROM lineitem) l,
  LATERAL (SELECT unnest([0, 1, 2]) AS col,
                  unnest([l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR)]) AS text) c"""


@query("render_table_markdown", operators=("D17",), sql=f"""
SELECT table_id, md5(string_agg(r, chr(10) ORDER BY ridx)) AS table_md5 FROM (
  SELECT table_id, CAST(ridx AS DOUBLE) AS ridx, concat('| ', string_agg(text, ' | ' ORDER BY col), ' |') AS r
  FROM ({CELLS_SQL}) c GROUP BY table_id, ridx
  UNION ALL
  SELECT DISTINCT table_id, 0.5, '|---|---|---|' FROM ({CELLS_SQL}) c) t
GROUP BY table_id""")
def render_table_markdown_q(spark, sf_dir):
    li = assemble.spread(tables.load(spark, sf_dir, "lineitem"), ["l_orderkey"])
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = li.select(F.col("l_orderkey").alias("table_id"), (F.row_number().over(w) - 1).alias("row"),
                     F.array("l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias("_c"))
    cells = rows.select("table_id", "row", F.posexplode("_c").alias("col", "text"))
    r = assemble.render_table(cells, "markdown", scope=("table_id",))
    return r.select("table_id", F.md5("table").alias("table_md5"))


RAW_SQL = """SELECT l_orderkey AS image_id, l_linenumber AS box_id,
  l_quantity * 20 AS cx, l_tax * 9000 + 100 AS cy, l_extendedprice / 400 + 10 AS w, l_quantity * 7 + 5 AS h,
  l_discount * 9 + 0.1 AS obj, [l_tax * 10, l_discount * 10, 0.35] AS cls,
  1000 + (l_orderkey % 7) * 40 AS img_h, 800 + (l_partkey % 5) * 50 AS img_w FROM lineitem"""


def _raw(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").cast("long").alias("box_id"),
        (F.col("l_quantity") * 20).alias("cx"), (F.col("l_tax") * 9000 + 100).alias("cy"),
        (F.col("l_extendedprice") / 400 + 10).alias("w"), (F.col("l_quantity") * 7 + 5).alias("h"),
        (F.col("l_discount") * 9 + 0.1).alias("obj"),
        F.array(F.col("l_tax") * 10, F.col("l_discount") * 10, F.lit(0.35)).alias("cls"),
        (1000 + (F.col("l_orderkey") % 7) * 40).alias("img_h"), (800 + (F.col("l_partkey") % 5) * 50).alias("img_w"))


def _norm_sql():
    ratio = "least(CAST(1024 AS DOUBLE) / img_h, CAST(1024 AS DOUBLE) / img_w)"
    cl = "least(greatest({}, 0.0), 1.0)"
    x1 = cl.format(f"(cx - w / 2) / {ratio} / img_w")
    y1 = cl.format(f"(cy - h / 2) / {ratio} / img_h")
    x2 = cl.format(f"(cx + w / 2) / {ratio} / img_w")
    y2 = cl.format(f"(cy + h / 2) / {ratio} / img_h")
    def r4(e):
        return f"round(({e}) * 10000.0::DOUBLE) / 10000.0::DOUBLE"
    y1r = r4("CASE WHEN label = 'table' THEN least(greatest(y1 - (y2 - y1) * 0.2, 0.0), 1.0) ELSE y1 END")
    return f"""SELECT image_id, box_id, label, {r4('x1')} AS x1, {y1r} AS y1,
  {r4('x2')} AS x2, {r4('y2')} AS y2, {r4('score')} AS score FROM (
  SELECT image_id, box_id, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2, obj * list_max(cls) AS score,
         ['table', 'chart', 'title'][list_position(cls, list_max(cls))] AS label
  FROM ({RAW_SQL}) r) t WHERE score >= 0.01 AND score > 0.1"""


@query("score_detections", operators=("E5",), sql=_norm_sql())
def score_detections_q(spark, sf_dir):
    return detect.score_detections(_raw(spark, sf_dir))


DET_SQL = """SELECT l_orderkey AS image_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS box_id,
       CASE l_linenumber % 3 WHEN 0 THEN 'table' WHEN 1 THEN 'chart' ELSE 'title' END AS label,
       l_quantity / 100 AS x1, l_tax AS y1, l_quantity / 100 + 0.2 AS x2, l_tax + 0.3 AS y2,
       l_discount * 10 AS score FROM lineitem"""


@query("iou_pairs", operators=("E6",), sql=f"""
SELECT a.image_id, a.box_id AS box_a, b.box_id AS box_b,
  round(greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)
   / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
      - greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)), 6)
   AS iou
FROM ({DET_SQL}) a JOIN ({DET_SQL}) b ON a.image_id = b.image_id AND a.box_id < b.box_id
WHERE least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1)""")
def iou_pairs_q(spark, sf_dir):
    p = detect.iou_pairs(tables.detections(spark, sf_dir))
    return p.select("image_id", F.col("box_a").cast("long"), F.col("box_b").cast("long"),
                    F.round("iou", 6).alias("iou"))


@query("nms", operators=("E7",), sql=f"""
WITH RECURSIVE
d AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, box_id) AS r FROM ({DET_SQL}) x),
walk AS (
  SELECT image_id, r, [struct_pack(i := box_id, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] AS kept FROM d WHERE r = 1
  UNION ALL
  SELECT d.image_id, d.r,
    CASE WHEN list_bool_or(list_transform(w.kept, lambda k:
      greatest(least(k.x2, d.x2) - greatest(k.x1, d.x1), 0) * greatest(least(k.y2, d.y2) - greatest(k.y1, d.y1), 0)
      > 0.5 * ((k.x2 - k.x1) * (k.y2 - k.y1) + (d.x2 - d.x1) * (d.y2 - d.y1)
               - greatest(least(k.x2, d.x2) - greatest(k.x1, d.x1), 0) * greatest(least(k.y2, d.y2) - greatest(k.y1, d.y1), 0))))
    THEN w.kept ELSE list_append(w.kept, struct_pack(i := d.box_id, x1 := d.x1, y1 := d.y1, x2 := d.x2, y2 := d.y2)) END
  FROM walk w JOIN d ON d.image_id = w.image_id AND d.r = w.r + 1),
ends AS (SELECT image_id, arg_max(kept, r) AS kept FROM walk GROUP BY image_id)
SELECT image_id, unnest(kept).i AS box_id FROM ends""")
def nms_q(spark, sf_dir):
    return detect.nms(tables.detections(spark, sf_dir)).select("image_id", F.col("box_id").cast("long"))


@query("expand_boxes", operators=("E10",), sql=f"""
SELECT image_id, box_id, label,
  round(CASE WHEN label = 'chart' THEN greatest(x1 - (x2 - x1) / 2 * (rx - 1), 0.0) ELSE x1 END, 6) AS x1,
  round(CASE WHEN label = 'chart' THEN least(y2 + (y2 - y1) / 2 * (ry - 1), 1.0) ELSE y2 END, 6) AS y2
FROM (SELECT *, CASE WHEN titled THEN 1.05 ELSE 1.1 END AS rx, CASE WHEN titled THEN 1.1 ELSE 1.25 END AS ry
      FROM (SELECT *, box_id % 2 = 0 AS titled FROM ({DET_SQL}) d) d1) d2
WHERE label NOT IN ('table', 'chart') OR score >= 0.48""")
def expand_boxes_q(spark, sf_dir):
    d = tables.detections(spark, sf_dir).withColumn("titled", F.col("box_id") % 2 == 0)
    e = detect.expand_boxes(d)
    return e.select("image_id", F.col("box_id").cast("long"), "label", F.round("x1", 6).alias("x1"),
                    F.round("y2", 6).alias("y2"))
