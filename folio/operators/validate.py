"""Job validation as data: every job gets a list of violations instead of an exception.

Task properties travel as JSON text; each rule reads it with ``get_json_object`` /
``json_object_keys`` so validation is one projection over the job table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.schema import DOCUMENT_TYPES, JOB_TASK_TYPES

# Allowed / required property keys per task type.
TASK_KEYS = {
    "split": (["split_by", "split_length", "split_overlap", "max_character_length", "sentence_window_size"],
              ["split_by", "split_length", "split_overlap"]),
    "extract": (["document_type", "method", "params"], ["document_type", "method", "params"]),
    "store": (["structured", "images", "method", "params"], ["method", "params"]),
    "caption": (["content_type", "n_neighbors"], []),
    "filter": (["content_type", "params"], []),
    "dedup": (["content_type", "params"], []),
    "embed": (["text", "tables", "filter_errors"], []),
    "vdb_upload": (["filter_errors"], []),
}
FILTER_PARAM_KEYS = ["min_size", "max_aspect_ratio", "min_aspect_ratio", "filter"]
DEDUP_PARAM_KEYS = ["filter"]
EXTRACT_DOCUMENT_TYPES = ["pdf", "text", "docx", "pptx", "jpeg", "bmp", "png", "svg", "html"]


def _j(props: Column, key: str) -> Column:
    return F.get_json_object(props, f"$.{key}")


def task_violations(task: Column) -> Column:
    """Array of violation messages for one task struct (type, task_properties)."""
    t = F.lower(task["type"])
    p = task["task_properties"]
    keys = F.json_object_keys(p)
    msgs = [F.when(~t.isin(*JOB_TASK_TYPES), F.concat(F.lit("unknown task type "), task["type"]))]
    def unknown_key(allowed):
        return F.exists(keys, lambda k: ~k.isin(*allowed))

    for name, (allowed, required) in TASK_KEYS.items():
        is_t = t == name
        msgs.append(F.when(is_t & unknown_key(allowed), F.lit(f"{name}: unknown property")))
        for r in required:
            msgs.append(F.when(is_t & _j(p, r).isNull(), F.lit(f"{name}: missing {r}")))
    sp = t == "split"
    msgs += [
        F.when(sp & ~F.coalesce(_j(p, "split_by").isin("word", "sentence", "passage"), F.lit(False)),
               F.lit("split: split_by must be word, sentence or passage")),
        F.when(sp & ~F.coalesce(_j(p, "split_length").try_cast("int") > 0, F.lit(False)),
               F.lit("split: split_length must be > 0")),
        F.when(sp & ~F.coalesce(_j(p, "split_overlap").try_cast("int") >= 0, F.lit(False)),
               F.lit("split: split_overlap must be >= 0")),
        F.when(sp & (_j(p, "split_overlap").try_cast("int") >= _j(p, "split_length").try_cast("int")),
               F.lit("split: split_overlap must be < split_length")),
        F.when(sp & (_j(p, "max_character_length").try_cast("int") <= 0),
               F.lit("split: max_character_length must be > 0")),
        F.when(sp & (_j(p, "sentence_window_size").try_cast("int") < 0),
               F.lit("split: sentence_window_size must be >= 0")),
        F.when(sp & (_j(p, "sentence_window_size").try_cast("int") > 0) & (_j(p, "split_by") != "sentence"),
               F.lit("split: sentence_window_size needs split_by sentence")),
        F.when((t == "extract") & ~F.coalesce(F.lower(_j(p, "document_type")).isin(*EXTRACT_DOCUMENT_TYPES),
                                              F.lit(False)),
               F.lit("extract: invalid document_type")),
        F.when((t == "filter") & F.exists(F.json_object_keys(_j(p, "params")),
                                          lambda k: ~k.isin(*FILTER_PARAM_KEYS)),
               F.lit("filter: unknown params key")),
        F.when((t == "dedup") & F.exists(F.json_object_keys(_j(p, "params")),
                                         lambda k: ~k.isin(*DEDUP_PARAM_KEYS)),
               F.lit("dedup: unknown params key")),
    ]
    return F.array_compact(F.array(*msgs))


def validate_jobs(df: DataFrame) -> DataFrame:
    """Adds ``violations`` (array) and ``valid``; payload document types are checked
    case-insensitively. Split good / bad with ``where(valid)``."""
    per_task = F.flatten(F.transform(F.coalesce(F.col("tasks"), F.array()), task_violations))
    doc_ok = F.forall(F.coalesce(F.col("job_payload.document_type"), F.array()),
                      lambda d: F.lower(d).isin(*DOCUMENT_TYPES, "text"))
    v = F.concat(per_task, F.when(~doc_ok, F.array(F.lit("payload: invalid document_type")))
                 .otherwise(F.array().cast("array<string>")))
    return df.withColumn("violations", v).withColumn("valid", F.size("violations") == 0)
