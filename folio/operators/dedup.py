"""Duplicate images: the first row of each content hash, by ``(pos, job, piece, uuid)``, wins inside a scope.

Plan: hash the content in place (narrow), aggregate the *thin* key table
``(scope, hash) -> first place`` (partial aggregation before the shuffle, so one image
repeated in a third of all rows still costs one row per map task), and join it back to
the image rows only. AQE's skew join splits a hot hash on the big side. Non-image rows and
images without content never enter a shuffle: they are unioned back untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.filters import MSG_FILTER_DUPLICATE
from folio.operators.metadata import tag_info_message
from folio.session import cut_lineage


def content_hash(c, algorithm: str = "md5"):
    if algorithm == "md5":
        return F.md5(c)
    if algorithm in ("sha256", "sha2"):
        return F.sha2(c, 256)
    if algorithm == "sha1":
        return F.sha1(c)
    raise ValueError(f"unknown hash algorithm {algorithm!r}")


def dedup_images(df: DataFrame, drop: bool = False, scope=("job_id",), algorithm: str = "md5",
                 content_type: str = "image") -> DataFrame:
    """Later copies of an image are dropped (``drop``) or become info messages
    "Filtered duplicate image.".

    ``scope=("job_id",)`` looks at each job by itself (a null job is one); ``scope=()`` dedups
    across the whole corpus. An image without content is no copy of another.
    """
    scope = list(scope)
    is_img = F.coalesce(F.col("document_type") == content_type, F.lit(False)) & F.col("metadata.content").isNotNull()
    imgs = df.where(is_img).withColumn("_h", content_hash(F.col("metadata.content"), algorithm))
    # pos orders rows inside a job only: across jobs the job decides between equal positions
    order = [F.col(c).alias(c) for c in ("pos", "job_id", "piece", "uuid") if c in df.columns and c not in scope]
    keys = [*scope, "_h"]

    def first_places(place: Column) -> DataFrame:
        """Each key's first place, and how many rows are there."""
        places = imgs.groupBy(*keys, place.alias("_place")).agg(F.count("*").alias("_n"))
        firsts = places.groupBy(*keys).agg(F.min(F.struct("_place", "_n")).alias("_first"))
        return cut_lineage(firsts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_first"), "table")

    place = F.struct(*order) if order else F.struct(F.lit(0).alias("_none"))
    firsts = first_places(place)
    tied = not firsts.where(F.col("_first._n") > 1).isEmpty()
    if tied:  # several images of one document share its place: what is known of them decides, then nothing tells them apart
        md = imgs.schema["metadata"].dataType
        about = [f for f in ("content_metadata", "image_metadata") if f in md.names]
        known = F.to_json(F.struct(*[F.col(f"metadata.{f}") for f in about])) if about else F.lit("")
        place = F.struct(*order, F.xxhash64(known).alias("_about"))
        firsts = first_places(place)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    joined = imgs.join(firsts, same)
    at_first = place == F.col("_first._place")
    if not tied:
        out = joined.select(*df.columns, (~at_first).alias("_dup"))
        kept = out.where(~F.col("_dup")) if drop else tag_info_message(out, F.col("_dup"), "filter", MSG_FILTER_DUPLICATE)
        return kept.drop("_dup").unionByName(df.where(~is_img))
    alike = joined.where(at_first & (F.col("_first._n") > 1))
    row = F.first(F.struct(*df.columns, F.col("_first._n").alias("_n"))).alias("_r")
    alike = alike.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(row).select("_r.*")
    rest = joined.where(~(at_first & (F.col("_first._n") > 1)))
    out = rest.select(*df.columns, (~at_first).alias("_dup"))
    out = out.unionByName(alike.select(*df.columns, F.lit(False).alias("_dup")))
    if drop:
        kept = out.where(~F.col("_dup"))
    else:
        copies = alike.withColumn("_copy", F.explode(F.sequence(F.lit(2).cast("long"), F.col("_n"))))
        kept = tag_info_message(out.unionByName(copies.select(*df.columns, F.lit(True).alias("_dup"))), F.col("_dup"), "filter", MSG_FILTER_DUPLICATE)
    return kept.drop("_dup").unionByName(df.where(~is_img))
