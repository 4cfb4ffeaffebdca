"""Filters, routing and predicates over element rows: all single-pass projections."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.predicates import is_subset
from folio.operators.metadata import tag_info_message

# Messages the reference writes into info_message_metadata.
MSG_FILTER_SIZE = "Filtered due to image size."
MSG_FILTER_DUPLICATE = "Filtered duplicate image."

# Layout classes whose text is kept by the layout extractor.
ACCEPTED_LAYOUT_CLASSES = ["Text", "Title", "Section-header", "List-item", "TOC", "Bibliography", "Formula"]


def image_fails_size(width: Column, height: Column, min_size=128, max_aspect_ratio=5.0,
                     min_aspect_ratio=0.2) -> Column:
    """NOT(avg > min_size AND ratio > min_ar AND ratio < max_ar), all comparisons strict."""
    w, h = width.cast("double"), height.cast("double")
    avg = (w + h) / 2
    ratio = w / F.greatest(h, F.lit(1e-9))
    ok = (avg > F.lit(float(min_size))) & (ratio > F.lit(float(min_aspect_ratio))) \
        & (ratio < F.lit(float(max_aspect_ratio)))
    return ~F.coalesce(ok, F.lit(False))


def filter_images(df: DataFrame, min_size=128, max_aspect_ratio=5.0, min_aspect_ratio=0.2,
                  drop: bool = False) -> DataFrame:
    """Image rows failing the size/aspect rule are dropped (``drop``) or turned into
    info messages "Filtered due to image size."; other rows pass."""
    im = F.col("metadata.image_metadata")
    fails = (F.col("document_type") == "image") & image_fails_size(
        im.getField("width"), im.getField("height"), min_size, max_aspect_ratio, min_aspect_ratio)
    fails = F.coalesce(fails, F.lit(False))
    if drop:
        return df.where(~fails)
    return tag_info_message(df, fails, "filter", MSG_FILTER_SIZE)


def select_embeddable(df: DataFrame, text: bool = True, tables: bool = True) -> DataFrame:
    """Text rows with content != "" and structured rows with table_content != "";
    null never qualifies."""
    cond = F.lit(False)
    if text:
        cond = cond | ((F.col("document_type") == "text")
                       & F.coalesce(F.col("metadata.content") != "", F.lit(False)))
    if tables:
        cond = cond | ((F.col("document_type") == "structured")
                       & F.coalesce(F.col("metadata.table_metadata.table_content") != "", F.lit(False)))
    return df.where(F.coalesce(cond, F.lit(False)))


def filter_errors(df: DataFrame) -> DataFrame:
    """Drop rows whose info message says ``filter=true`` (null-safe)."""
    return df.where(~F.coalesce(F.col("metadata.info_message_metadata.filter"), F.lit(False)))


def filter_by_class(df: DataFrame, class_col: str = "class", text_col: str = "text",
                    accepted=None) -> DataFrame:
    """Text of accepted layout classes is kept, other classes get ""."""
    accepted = accepted or ACCEPTED_LAYOUT_CLASSES
    return df.withColumn(text_col, F.when(F.col(class_col).isin(*accepted), F.col(text_col))
                         .otherwise(F.lit("")))


def filter_by_document_type(df: DataFrame, doc_type: str, op: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``op`` to rows of one document type; union the rest back unchanged."""
    sel = F.coalesce(F.col("document_type") == doc_type, F.lit(False))
    return op(df.where(sel)).unionByName(df.where(~sel), allowMissingColumns=True)


def has_task(task: str, props: dict | None = None) -> Column:
    """Row predicate: the job's ``tasks`` hold ``task`` (and, optionally, matching props)."""
    if props:
        return F.exists(F.col("tasks"), lambda t: (F.lower(t["type"]) == task.lower())
                        & is_subset(t["task_properties"], props))
    return F.exists(F.col("tasks"), lambda t: F.lower(t["type"]) == task.lower())


def route_by_task(df: DataFrame, task: str, op: Callable[[DataFrame], DataFrame],
                  props: dict | None = None, task_col: Column | None = None) -> DataFrame:
    """Run ``op`` only on jobs holding the task; others pass unchanged.

    ``task_col`` may give the routing predicate directly (e.g. a boolean column)."""
    sel = F.coalesce(task_col if task_col is not None else has_task(task, props), F.lit(False))
    return op(df.where(sel)).unionByName(df.where(~sel), allowMissingColumns=True)


def skip_failed(df: DataFrame, op: Callable[[DataFrame], DataFrame],
                failed_col: str = "cm_failed") -> DataFrame:
    """Failed jobs skip ``op`` and pass through as they are."""
    bad = F.coalesce(F.col(failed_col), F.lit(False))
    return op(df.where(~bad)).unionByName(df.where(bad), allowMissingColumns=True)


def result_failed(df: DataFrame, status_col: str = "status") -> DataFrame:
    """``failed`` = status is a substring of "failed" (so null and "" count as failed);
    with ``annotations`` (array of struct(key, task_result, message)) the description
    becomes the first FAILURE annotation."""
    s = F.col(status_col)
    failed = s.isNull() | (F.instr(F.lit("failed"), s) > 0)
    out = df.withColumn("failed", failed)
    if "annotations" in df.columns:
        first_fail = F.filter(F.col("annotations"), lambda a: a["task_result"] == "FAILURE")[0]
        msg = F.concat(F.lit("\n↪ Event that caused this failure: "), first_fail["key"], F.lit(" -> "),
                       F.coalesce(first_fail["message"], F.lit("Unknown")))
        desc = F.col("description") if "description" in df.columns else F.lit("")
        out = out.withColumn("description", F.when(failed & first_fail.isNotNull(), msg).otherwise(desc))
    return out
