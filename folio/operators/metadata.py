"""Element construction and validation: the nested ``metadata`` struct.

Operators here are projections only (no shuffle). They keep ``job_id``/``pos`` and any
other scope columns the input carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio import schema as S
from folio.functions.predicates import doc_type_to_content_type
from folio.functions.dates import validate_iso8601
from folio.functions.structs import build_struct, typed_null


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def _opt(df: DataFrame, name: str, dtype="string") -> Column:
    return F.col(name) if _has(df, name) else F.lit(None).cast(dtype)


def new_uuid(*cols) -> Column:
    """Deterministic element id (``uuid()`` would differ between task retries)."""
    h1 = F.xxhash64(*cols)
    h2 = F.xxhash64(F.lit("folio"), *cols)
    return F.format_string("%016x%016x", h1, h2)


def inject_metadata(df: DataFrame) -> DataFrame:
    """Build ``metadata`` for rows that lack it (or lack its content); keep the rest.

    Input: ``document_type, content, source_id, source_name`` [+ ``metadata``].
    Content type = lower-case content-type name of the document type; image rows get
    ``image_metadata{image_type}``, text rows ``text_metadata{text_type: document}``.
    """
    ctype = doc_type_to_content_type(F.col("document_type"))
    built = build_struct(
        S.METADATA,
        content=F.col("content"),
        content_metadata=build_struct(S.CONTENT_METADATA, type=ctype),
        image_metadata=F.when(ctype == "image", build_struct(
            S.IMAGE_METADATA, image_type=F.col("document_type"))),
        source_metadata=build_struct(
            S.SOURCE_METADATA, source_id=F.col("source_id"), source_name=F.col("source_name"),
            source_type=F.col("document_type")),
        text_metadata=F.when(ctype == "text", build_struct(S.TEXT_METADATA, text_type=F.lit("document"))),
    )
    if _has(df, "metadata"):
        m = F.col("metadata")
        built = F.when(m.isNull() | m.getField("content").isNull(), built).otherwise(m.cast(S.METADATA))
    out = df.withColumn("metadata", built)
    if not _has(df, "uuid"):
        out = out.withColumn("uuid", new_uuid(*[F.col(c) for c in ("job_id", "pos") if _has(df, c)]
                                                or [F.col("source_id")]))
    return out


def validate_metadata(df: DataFrame) -> DataFrame:
    """Apply the schema rules as data: fill defaults, null sub-structs that do not match
    the content type, and list violations in ``metadata_violations`` (never raise)."""
    m = F.col("metadata")
    cm = m.getField("content_metadata")
    t = cm.getField("type")
    tm, im, tb = m.getField("text_metadata"), m.getField("image_metadata"), m.getField("table_metadata")
    sm, em, nm = m.getField("source_metadata"), m.getField("error_metadata"), m.getField("info_message_metadata")
    violations = F.array_compact(F.array(
        F.when(t.isNull() | ~t.isin(*S.CONTENT_TYPES), F.lit("content_metadata.type")),
        F.when(tm.isNotNull() & ~F.coalesce(tm.getField("text_type"), F.lit("")).isin(*S.TEXT_TYPES),
               F.lit("text_metadata.text_type")),
        F.when(tm.isNotNull() & ~F.coalesce(tm.getField("language"), F.lit("en")).isin(*S.LANGUAGES),
               F.lit("text_metadata.language")),
        F.when(im.isNotNull() & im.getField("image_type").isNotNull()
               & ~im.getField("image_type").isin(*S.IMAGE_TYPES, *S.DOCUMENT_TYPES),
               F.lit("image_metadata.image_type")),
        F.when(tb.isNotNull() & tb.getField("table_format").isNotNull()
               & ~tb.getField("table_format").isin(*S.TABLE_FORMATS), F.lit("table_metadata.table_format")),
        F.when(cm.getField("subtype").isNotNull() & (cm.getField("subtype") != "")
               & ~cm.getField("subtype").isin(*S.CONTENT_SUBTYPES), F.lit("content_metadata.subtype")),
        F.when(sm.isNull() | sm.getField("source_id").isNull(), F.lit("source_metadata.source_id")),
        *[F.when(sm.getField(f).isNotNull() & (sm.getField(f) != "") & ~validate_iso8601(sm.getField(f)), F.lit(f"source_metadata.{f}")) for f in ("date_created", "last_modified")],
        F.when(em.isNotNull() & ~F.coalesce(em.getField("task"), F.lit("")).isin(*S.TASK_TYPES), F.lit("error_metadata.task")),
        F.when(em.isNotNull() & ~F.coalesce(em.getField("status"), F.lit("")).isin(*S.STATUSES), F.lit("error_metadata.status")),
        F.when(nm.isNotNull() & ~F.coalesce(nm.getField("task"), F.lit("")).isin(*S.TASK_TYPES), F.lit("info_message_metadata.task")),
        F.when(nm.isNotNull() & ~F.coalesce(nm.getField("status"), F.lit("")).isin(*S.STATUSES), F.lit("info_message_metadata.status")),
    ))
    fixed = (
        m.withField("content", F.coalesce(m.getField("content"), F.lit("")))
         .withField("content_metadata.description", F.coalesce(cm.getField("description"), F.lit("")))
         .withField("content_metadata.page_number", F.coalesce(cm.getField("page_number"), F.lit(-1)))
         .withField("content_metadata.subtype", F.coalesce(cm.getField("subtype"), F.lit("")))
         .withField("raise_on_failure", F.coalesce(m.getField("raise_on_failure"), F.lit(False)))
         .withField("text_metadata", F.when(t == "text", tm.withField(
             "language", F.coalesce(tm.getField("language"), F.lit("en")))
             .withField("summary", F.coalesce(tm.getField("summary"), F.lit("")))
             .withField("text_location", F.coalesce(tm.getField("text_location"),
                                                    F.array(*[F.lit(0.0)] * 4))))
             .otherwise(typed_null(S.TEXT_METADATA)))
         .withField("image_metadata", F.when(t == "image", im).otherwise(typed_null(S.IMAGE_METADATA)))
         .withField("table_metadata", F.when(t == "structured", tb).otherwise(typed_null(S.TABLE_METADATA)))
    )
    return df.withColumn("metadata", fixed).withColumn("metadata_violations", violations)


def build_source_metadata(df: DataFrame) -> DataFrame:
    """``source_metadata`` from document columns; location/collection "" and
    partition -1 when not given, access level 1."""
    return df.withColumn("source_metadata", build_struct(
        S.SOURCE_METADATA,
        source_name=F.col("source_name"), source_id=F.col("source_id"),
        source_location=F.coalesce(_opt(df, "source_location"), F.lit("")),
        source_type=F.col("source_type") if _has(df, "source_type") else F.col("document_type"),
        collection_id=F.coalesce(_opt(df, "collection_id"), F.lit("")),
        date_created=_opt(df, "date_created"), last_modified=_opt(df, "last_modified"),
        summary=F.coalesce(_opt(df, "summary"), F.lit("")),
        partition_id=F.coalesce(_opt(df, "partition_id", "int"), F.lit(-1)),
        access_level=F.coalesce(_opt(df, "access_level", "int"), F.lit(1)),
    ))


def _hierarchy(df: DataFrame) -> Column:
    return build_struct(
        S.HIERARCHY,
        page_count=F.coalesce(_opt(df, "page_count", "int"), F.lit(-1)),
        page=F.coalesce(_opt(df, "page", "int"), F.lit(-1)),
        block=F.coalesce(_opt(df, "block", "int"), F.lit(-1)),
        line=F.coalesce(_opt(df, "line", "int"), F.lit(-1)),
        span=F.coalesce(_opt(df, "span", "int"), F.lit(-1)),
        nearby_objects=build_struct(S.NEARBY_OBJECTS, **{
            k: build_struct(S.NEARBY_LIST, content=F.array().cast("array<string>"),
                            bbox=F.array().cast("array<array<double>>"))
            for k in ("text", "images", "structured")}),
    )


def _bbox(df: DataFrame) -> Column:
    if all(_has(df, c) for c in ("x1", "y1", "x2", "y2")):
        return F.array(*[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")])
    return F.array(*[F.lit(-1.0)] * 4)


def _source(df: DataFrame) -> Column:
    if _has(df, "source_metadata"):
        return F.col("source_metadata")
    return build_struct(S.SOURCE_METADATA, source_id=_opt(df, "source_id"),
                        source_name=_opt(df, "source_name"), source_type=_opt(df, "source_type"))


def _element(df: DataFrame, doc_type: str, metadata: Column) -> DataFrame:
    keep = [c for c in ("job_id", "pos") if _has(df, c)]
    return df.select(*keep, F.lit(doc_type).alias("document_type"), metadata.alias("metadata"),
                     new_uuid(*[F.col(c) for c in keep], F.lit(doc_type)).alias("uuid"))


def build_text_elements(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Text element rows: text, page numbers, language, text type, location.

    Input: ``text`` [+ page, page_count, block, line, span, text_type, language, x1..y2,
    keywords, source columns]. Location defaults to (-1,-1,-1,-1)."""
    md = build_struct(
        S.METADATA,
        content=F.col(text_col),
        source_metadata=_source(df),
        content_metadata=build_struct(
            S.CONTENT_METADATA, type=F.lit("text"),
            description=F.coalesce(_opt(df, "description"), F.lit("")),
            page_number=F.coalesce(_opt(df, "page", "int"), F.lit(-1)),
            hierarchy=_hierarchy(df), subtype=F.lit("")),
        text_metadata=build_struct(
            S.TEXT_METADATA, text_type=F.coalesce(_opt(df, "text_type"), F.lit("document")),
            summary=F.lit(""), keywords=_opt(df, "keywords", "array<string>"),
            language=F.coalesce(_opt(df, "language"), F.lit("en")), text_location=_bbox(df)),
        raise_on_failure=F.lit(False),
    )
    return _element(df, "text", md)


def build_image_elements(df: DataFrame, compat_zero_width: bool = False) -> DataFrame:
    """Image element rows with box, caption and size. ``compat_zero_width`` writes width 0
    like the PDF path of the reference (which makes every such image fail C5)."""
    width = F.lit(0) if compat_zero_width else F.coalesce(_opt(df, "width", "int"), F.lit(0))
    md = build_struct(
        S.METADATA,
        content=F.col("content"),
        source_metadata=_source(df),
        content_metadata=build_struct(
            S.CONTENT_METADATA, type=F.lit("image"),
            description=F.coalesce(_opt(df, "description"), F.lit("")),
            page_number=F.coalesce(_opt(df, "page", "int"), F.lit(-1)),
            hierarchy=_hierarchy(df), subtype=F.lit("")),
        image_metadata=build_struct(
            S.IMAGE_METADATA, image_type=F.coalesce(_opt(df, "image_type"), F.lit("png")),
            structured_image_type=F.lit("image_type_1"),
            caption=F.coalesce(_opt(df, "caption"), F.lit("")), text=F.lit(""),
            image_location=_bbox(df),
            image_location_max_dimensions=F.array(F.coalesce(_opt(df, "max_width", "int"), F.lit(0)),
                                                  F.coalesce(_opt(df, "max_height", "int"), F.lit(0))),
            width=width, height=F.coalesce(_opt(df, "height", "int"), F.lit(0))),
        raise_on_failure=F.lit(False),
    )
    return _element(df, "image", md)


def build_table_elements(df: DataFrame, table_format: str = "image") -> DataFrame:
    """Table / chart element rows (``subtype`` column: table or chart)."""
    md = build_struct(
        S.METADATA,
        content=F.coalesce(_opt(df, "content"), F.lit("")),
        source_metadata=_source(df),
        content_metadata=build_struct(
            S.CONTENT_METADATA, type=F.lit("structured"),
            description=F.coalesce(_opt(df, "description"), F.lit("")),
            page_number=F.coalesce(_opt(df, "page", "int"), F.lit(-1)),
            hierarchy=_hierarchy(df), subtype=F.coalesce(_opt(df, "subtype"), F.lit("table"))),
        table_metadata=build_struct(
            S.TABLE_METADATA, caption=F.coalesce(_opt(df, "caption"), F.lit("")),
            table_format=F.lit(table_format),
            table_content=F.coalesce(_opt(df, "table_content"), F.lit("")),
            table_location=_bbox(df),
            table_location_max_dimensions=F.array(F.coalesce(_opt(df, "max_width", "int"), F.lit(0)),
                                                  F.coalesce(_opt(df, "max_height", "int"), F.lit(0)))),
        raise_on_failure=F.lit(False),
    )
    return _element(df, "structured", md)


def tag_info_message(df: DataFrame, cond: Column, task: str, message: str,
                     status: str = "success", filter_flag: bool = True) -> DataFrame:
    """Where ``cond`` holds: set ``info_message_metadata`` and type ``info_message``."""
    info = build_struct(S.INFO_MESSAGE_METADATA, task=F.lit(task), status=F.lit(status),
                        message=F.lit(message), filter=F.lit(filter_flag))
    c = F.coalesce(cond, F.lit(False))
    return (df.withColumn("metadata", F.when(c, F.col("metadata").withField("info_message_metadata", info))
                          .otherwise(F.col("metadata")))
              .withColumn("document_type", F.when(c, F.lit("info_message")).otherwise(F.col("document_type"))))


def tag_error(df: DataFrame, cond: Column, message, task: str = "extract") -> DataFrame:
    """Where ``cond`` holds: error row with ``error_metadata`` and null document type."""
    msg = message if isinstance(message, Column) else F.lit(message)
    c = F.coalesce(cond, F.lit(False))
    src = F.col("metadata.source_metadata.source_id")
    err = build_struct(S.ERROR_METADATA, task=F.lit(task), status=F.lit("error"),
                       source_id=F.coalesce(src, F.lit("")), error_msg=msg)
    return (df.withColumn("metadata", F.when(c, F.col("metadata").withField("error_metadata", err))
                          .otherwise(F.col("metadata")))
              .withColumn("document_type", F.when(c, F.lit(None).cast("string"))
                          .otherwise(F.col("document_type"))))


def project_results(df: DataFrame) -> DataFrame:
    """Keep only ``document_type, metadata`` (plus scope columns, if present)."""
    keep = [c for c in ("job_id", "pos") if _has(df, c)]
    return df.select(*keep, "document_type", "metadata")
