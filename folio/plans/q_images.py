"""Registered queries for images and page layout: filters, dedup, proximity, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import geometry as G
from folio.operators import dedup, filters, metadata, spatial
from folio.plans.registry import query
from folio.sources import tables

IMAGES_SQL = """SELECT p_partkey % 50 AS job_id, p_size % 5 AS page, p_partkey AS pos,
       concat(p_brand, '|', CAST(p_size AS VARCHAR)) AS content,
       p_size * 20 AS width, CAST((p_partkey * 37) % 900 AS INTEGER) AS height,
       CAST(p_partkey * 13 % 500 AS DOUBLE) AS x1, CAST(p_partkey * 7 % 700 AS DOUBLE) AS y1,
       CAST(p_partkey * 13 % 500 + p_size AS DOUBLE) AS x2,
       CAST(p_partkey * 7 % 700 + p_size AS DOUBLE) AS y2 FROM part"""

BLOCKS_SQL = """SELECT l_orderkey % 50 AS job_id, l_linenumber % 5 AS page,
       l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
       concat(l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR)) AS text,
       CAST(l_partkey * 11 % 500 AS DOUBLE) AS x1, CAST(l_suppkey * 17 % 700 AS DOUBLE) AS y1,
       CAST(l_partkey * 11 % 500 + 40 AS DOUBLE) AS x2, CAST(l_suppkey * 17 % 700 + 10 AS DOUBLE) AS y2,
       CASE WHEN l_linenumber % 2 = 0 THEN 'nearby_block' ELSE 'body' END AS text_type
FROM lineitem"""


def image_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.build_image_elements(tables.images(spark, sf_dir))


def block_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.build_text_elements(tables.blocks(spark, sf_dir))


FAILS_SQL = "NOT ((width + height) / 2 > 128 AND width / greatest(height, 1e-9) > 0.2 AND width / greatest(height, 1e-9) < 5.0)"


@query("filter_images", operators=("C5", "B9", "B11"), sql=f"""
SELECT job_id, pos, CASE WHEN {FAILS_SQL} THEN 'info_message' ELSE 'image' END AS document_type,
       CASE WHEN {FAILS_SQL} THEN 'Filtered due to image size.' END AS info_message,
       CASE WHEN {FAILS_SQL} THEN 'filter' END AS info_task
FROM ({IMAGES_SQL}) i""")
def filter_images_q(spark, sf_dir):
    out = filters.filter_images(image_elements(spark, sf_dir))
    im = F.col("metadata.info_message_metadata")
    return out.select("job_id", "pos", "document_type", im["message"].alias("info_message"),
                      im["task"].alias("info_task"))


@query("filter_images_drop", operators=("C5",), sql=f"""
SELECT job_id, count(*) AS n_kept, sum(width) AS sum_width FROM ({IMAGES_SQL}) i
WHERE NOT {FAILS_SQL} GROUP BY job_id""")
def filter_images_drop_q(spark, sf_dir):
    out = filters.filter_images(image_elements(spark, sf_dir), drop=True)
    return out.groupBy("job_id").agg(F.count("*").alias("n_kept"),
                                     F.sum("metadata.image_metadata.width").alias("sum_width"))


@query("dedup_images", operators=("C6", "B11"), sql=f"""
SELECT job_id, pos, CASE WHEN rn > 1 THEN 'info_message' ELSE 'image' END AS document_type,
       CASE WHEN rn > 1 THEN 'Filtered duplicate image.' END AS info_message
FROM (SELECT *, row_number() OVER (PARTITION BY job_id, md5(content) ORDER BY pos) AS rn
      FROM ({IMAGES_SQL}) i) t""")
def dedup_images_q(spark, sf_dir):
    out = dedup.dedup_images(image_elements(spark, sf_dir))
    return out.select("job_id", "pos", "document_type",
                      F.col("metadata.info_message_metadata.message").alias("info_message"))


@query("dedup_images_corpus_drop", operators=("C6",), sql=f"""
SELECT content, min(pos) AS first_pos FROM ({IMAGES_SQL}) i GROUP BY content""")
def dedup_images_corpus_drop_q(spark, sf_dir):
    out = dedup.dedup_images(image_elements(spark, sf_dir), drop=True, scope=())
    return out.select(F.col("metadata.content").alias("content"), F.col("pos").alias("first_pos"))


KNN_SQL = f"""
SELECT job_id, image_pos, rank, near_text, near_x1, near_y1 FROM (
  SELECT i.job_id, i.pos AS image_pos, t.text AS near_text, t.x1 AS near_x1, t.y1 AS near_y1,
         row_number() OVER (PARTITION BY i.job_id, i.pos
           ORDER BY ((i.x1 + i.x2) / 2 - (t.x1 + t.x2) / 2) ^ 2 + ((i.y1 + i.y2) / 2 - (t.y1 + t.y2) / 2) ^ 2,
                    t.pos) AS rank
  FROM ({IMAGES_SQL}) i JOIN ({BLOCKS_SQL}) t ON i.job_id = t.job_id AND i.page = t.page
  WHERE t.text_type = 'nearby_block') r
WHERE rank <= 5"""


def _associated(spark, sf_dir):
    el = image_elements(spark, sf_dir).unionByName(block_elements(spark, sf_dir))
    return spatial.associate_nearby_text(el, k=5)


@query("associate_nearby_text", operators=("E1", "E2", "B8", "B9"), sql=KNN_SQL)
def associate_nearby_text_q(spark, sf_dir):
    a = _associated(spark, sf_dir).where(F.col("document_type") == "image")
    near = F.col("metadata.content_metadata.hierarchy.nearby_objects.text")
    z = F.arrays_zip(near["content"].alias("c"), near["bbox"].alias("b"))
    return a.select(F.col("job_id"), F.col("pos").alias("image_pos"), F.posexplode(z).alias("i", "e")) \
        .select("job_id", "image_pos", (F.col("i") + 1).cast("long").alias("rank"),
                F.col("e.c").alias("near_text"), F.col("e.b")[0].alias("near_x1"),
                F.col("e.b")[1].alias("near_y1"))


CAPTIONS_SQL = f"""
SELECT i.job_id, i.pos, s.i AS cand_idx, coalesce(k.near_text, '') AS candidate
FROM ({IMAGES_SQL}) i CROSS JOIN (SELECT unnest(range(0, 5)) AS i) s
LEFT JOIN ({KNN_SQL}) k ON k.job_id = i.job_id AND k.image_pos = i.pos AND k.rank = s.i + 1"""


def _captions(spark, sf_dir):
    a = _associated(spark, sf_dir).where(F.col("document_type") == "image")
    c = spatial.nearest_captions(a, k=5)
    return c.select("job_id", "pos", F.posexplode("caption_candidates").alias("cand_idx", "candidate"))


@query("nearest_captions", operators=("E3",), sql=CAPTIONS_SQL)
def nearest_captions_q(spark, sf_dir):
    return _captions(spark, sf_dir).withColumn("cand_idx", F.col("cand_idx").cast("long"))


@query("choose_caption", operators=("E4",), sql=f"""
SELECT job_id, pos, CASE WHEN max(score) > 0.5 THEN arg_min(candidate, -score * 10 + cand_idx / 100.0) ELSE '' END AS caption
FROM (SELECT *, (length(candidate) % 7) / 6.0 AS score FROM ({CAPTIONS_SQL}) c) t GROUP BY job_id, pos""")
def choose_caption_q(spark, sf_dir):
    c = _captions(spark, sf_dir).withColumn("score", (F.length("candidate") % 7) / 6.0)
    return spatial.choose_caption(c)


@query("bbox_geometry", operators=("E1", "E11", "E12"), sql=f"""
SELECT pos, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy,
  CAST(trunc((x1 - (pos % 7)) / ((1024 - 2 * (pos % 7)) / 1024)) AS BIGINT) AS rx1,
  CAST(trunc((y2 - (pos % 5)) / ((1280 - 2 * (pos % 5)) / 1280)) AS BIGINT) AS ry2,
  CASE WHEN least(ceil(x2), width) - greatest(floor(x1), 0) >= 1
        AND least(ceil(y2), height) - greatest(floor(y1), 0) >= 1
       THEN CAST(least(ceil(x2), width) - greatest(floor(x1), 0) AS BIGINT) END AS crop_w
FROM ({IMAGES_SQL}) i""")
def bbox_geometry_q(spark, sf_dir):
    i = tables.images(spark, sf_dir)
    b = F.array("x1", "y1", "x2", "y2")
    c = G.bbox_center(b)
    r = G.reverse_transform_bbox(b, F.col("pos") % 7, F.col("pos") % 5)
    cl = G.clip_bbox(b, F.col("width"), F.col("height"))
    return i.select("pos", c["x"].alias("cx"), c["y"].alias("cy"), r[0].alias("rx1"), r[3].alias("ry2"),
                    (cl[2] - cl[0]).cast("long").alias("crop_w"))
