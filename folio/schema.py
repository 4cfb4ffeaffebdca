"""The element table: ``document_type``, one nested ``metadata`` struct, ``uuid``.

Scope columns ``job_id`` (one submitted document) and ``pos`` (row order inside a job)
travel next to it, because Spark has no message boundaries: every window orders by
``pos`` and every per-job rule partitions by ``job_id``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
CONTENT_TYPES = ["text", "image", "structured", "info_message"]
TEXT_TYPES = ["header", "body", "span", "line", "block", "page", "document", "nearby_block", "other"]
LANGUAGES = [
    "af", "ar", "bg", "bn", "ca", "cs", "cy", "da", "de", "el", "en", "es", "et", "fa", "fi", "fr",
    "gu", "he", "hi", "hr", "hu", "id", "it", "ja", "kn", "ko", "lt", "lv", "mk", "ml", "mr", "ne",
    "nl", "no", "pa", "pl", "pt", "ro", "ru", "sk", "sl", "so", "sq", "sv", "sw", "ta", "te", "th",
    "tl", "tr", "uk", "ur", "vi", "zh-cn", "zh-tw", "unknown",
]
IMAGE_TYPES = ["jpeg", "png", "bmp", "gif", "tiff", "image_type_1", "image_type_2"]
TABLE_FORMATS = ["html", "markdown", "latex", "image"]
TASK_TYPES = ["caption", "embed", "extract", "filter", "split", "transform"]
STATUSES = ["error", "success"]
CONTENT_SUBTYPES = ["table", "chart"]
SOURCE_TYPES = ["pdf", "docx", "pptx", "source_type_1", "source_type_2"]
ACCESS_LEVELS = [1, 2, 3]
DOCUMENT_TYPES = ["bmp", "docx", "html", "jpeg", "pdf", "png", "pptx", "svg", "txt"]
JOB_TASK_TYPES = ["caption", "dedup", "embed", "extract", "filter", "split", "store", "vdb_upload"]
# document type -> content type
DOC_TO_CONTENT = {
    "bmp": "image", "docx": "structured", "html": "structured", "jpeg": "image",
    "pdf": "structured", "png": "image", "pptx": "structured", "svg": "image", "txt": "text",
    "text": "text",
}
STD_DESCRIPTIONS = [
    "Unstructured text from PDF document.",
    "Image extracted from PDF document.",
    "Structured table extracted from PDF document.",
    "Structured chart extracted from PDF document.",
    "Unstructured text from DOCX document.",
    "Image extracted from DOCX document.",
    "Structured table extracted from DOCX document.",
    "Unstructured text from PPTX presentation.",
    "Image extracted from PPTX presentation.",
    "Structured table extracted from PPTX presentation.",
]
# ---------------------------------------------------------------------------

BBOX = T.ArrayType(T.DoubleType())

NEARBY_LIST = T.StructType([
    T.StructField("content", T.ArrayType(T.StringType())),
    T.StructField("bbox", T.ArrayType(BBOX)),
])

NEARBY_OBJECTS = T.StructType([
    T.StructField("text", NEARBY_LIST),
    T.StructField("images", NEARBY_LIST),
    T.StructField("structured", NEARBY_LIST),
])

HIERARCHY = T.StructType([
    T.StructField("page_count", T.IntegerType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("span", T.IntegerType()),
    T.StructField("nearby_objects", NEARBY_OBJECTS),
])

SOURCE_METADATA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_location", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("collection_id", T.StringType()),
    T.StructField("date_created", T.StringType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("access_level", T.IntegerType()),
])

CONTENT_METADATA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("hierarchy", HIERARCHY),
    T.StructField("subtype", T.StringType()),
])

TEXT_METADATA = T.StructType([
    T.StructField("text_type", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("language", T.StringType()),
    T.StructField("text_location", BBOX),
])

IMAGE_METADATA = T.StructType([
    T.StructField("image_type", T.StringType()),
    T.StructField("structured_image_type", T.StringType()),
    T.StructField("caption", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("image_location", BBOX),
    T.StructField("image_location_max_dimensions", T.ArrayType(T.IntegerType())),
    T.StructField("uploaded_image_url", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
])

TABLE_METADATA = T.StructType([
    T.StructField("caption", T.StringType()),
    T.StructField("table_format", T.StringType()),
    T.StructField("table_content", T.StringType()),
    T.StructField("table_location", BBOX),
    T.StructField("table_location_max_dimensions", T.ArrayType(T.IntegerType())),
    T.StructField("uploaded_image_uri", T.StringType()),
])

ERROR_METADATA = T.StructType([
    T.StructField("task", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("error_msg", T.StringType()),
])

INFO_MESSAGE_METADATA = T.StructType([
    T.StructField("task", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("filter", T.BooleanType()),
])

METADATA = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("source_metadata", SOURCE_METADATA),
    T.StructField("content_metadata", CONTENT_METADATA),
    T.StructField("text_metadata", TEXT_METADATA),
    T.StructField("image_metadata", IMAGE_METADATA),
    T.StructField("table_metadata", TABLE_METADATA),
    T.StructField("error_metadata", ERROR_METADATA),
    T.StructField("info_message_metadata", INFO_MESSAGE_METADATA),
    T.StructField("debug_metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("raise_on_failure", T.BooleanType()),
    # added by the sentence-window splitter
    T.StructField("window", T.StringType()),
    T.StructField("original_text", T.StringType()),
])

TASK = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("task_properties", T.StringType()),  # JSON text
])

JOB = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("job_payload", T.StructType([
        T.StructField("content", T.ArrayType(T.StringType())),
        T.StructField("source_name", T.ArrayType(T.StringType())),
        T.StructField("source_id", T.ArrayType(T.StringType())),
        T.StructField("document_type", T.ArrayType(T.StringType())),
    ])),
    T.StructField("tasks", T.ArrayType(TASK)),
    T.StructField("tracing_options", T.StructType([
        T.StructField("trace", T.BooleanType()),
        T.StructField("ts_send", T.LongType()),
        T.StructField("trace_id", T.StringType()),
    ])),
])

ELEMENT_COLUMNS = ["job_id", "pos", "document_type", "metadata", "uuid"]
