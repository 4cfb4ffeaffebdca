"""Extraction jobs around user-given parsers, and hosted-service element tables.

No PDF / DOCX / PPTX parser ships with this library (none is installed here). A parser
is a plain Python function ``parse(content: str, params: dict) -> list[dict]`` returning
raw pieces (kind, text, page, block, line, span, x1..y2, ...). ``extract_documents``
runs the parser registered for each document type inside ``mapInArrow`` on the
executors; failures become error rows, never task failures. Everything after the
parser (roll-ups, element building) is Spark: :mod:`folio.operators.assemble`.
"""

from __future__ import annotations

import html as _html
import re
from typing import Callable, Iterator

from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import runs_by_size
from folio.operators.assemble import DEPTH_KEYS, _sorted_join
from folio.operators.metadata import build_image_elements, build_table_elements, build_text_elements, tag_error
from folio.session import cut_lineage

Parser = Callable[[str, dict], list]

TAKEN = 1 << 22  # bytes of documents that are parsed at a time: their pieces go out before the next ones

RAW_FIELDS = ("piece long, kind string, text string, page int, block int, line int, span int, "
              "x1 double, y1 double, x2 double, y2 double, error string")


def parse_plain_text(content: str, params: dict) -> list:
    """Default parser for text-like documents: one text piece per paragraph; HTML tags
    are dropped and entities unescaped."""
    if params.get("document_type") == "html":
        content = _html.unescape(re.sub(r"<[^>]+>", " ", content))
    out = []
    for i, para in enumerate(p for p in re.split(r"\n\s*\n", content) if p.strip()):
        out.append({"kind": "text", "text": para.strip(), "page": 0, "block": i, "line": -1, "span": -1})
    return out


DEFAULT_REGISTRY: dict[str, Parser] = {"text": parse_plain_text, "txt": parse_plain_text,
                                       "md": parse_plain_text, "html": parse_plain_text}


def _run_parsers(registry: dict, params: dict, method: str | None = None, keep: tuple = ()):
    cols = ["kind", "text", "page", "block", "line", "span", "x1", "y1", "x2", "y2"]
    numbers = {**dict.fromkeys(("page", "block", "line", "span"), pa.int32()), **dict.fromkeys(("x1", "y1", "x2", "y2"), pa.float64())}
    types = {"piece": pa.int64(), "kind": pa.string(), "text": pa.string(), **numbers, "error": pa.string()}

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Schema, pd.DataFrame]]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("content")), 0).to_pylist()
            for lo, hi in runs_by_size(sizes, TAKEN):
                yield batch.schema, batch.slice(lo, hi - lo).to_pandas(integer_object_nulls=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given, pdf in taken(batches):
            rows = []
            for job_id, dtype, content, *kept in zip(pdf["job_id"], pdf["document_type"], pdf["content"], *[pdf[f"_{c}"] for c in keep]):
                own = dict(zip(keep, kept))
                kind = str(dtype).lower()
                fn = registry.get((kind, method), registry.get(kind))  # a method that nobody registered: the type's default
                try:
                    if fn is None:
                        raise ValueError(f"no extractor registered for document type {dtype!r}")
                    pieces = fn(content, {**params, "document_type": str(dtype).lower()})
                    for i, p in enumerate(pieces):
                        rows.append({"job_id": job_id, **own, "piece": i, **{c: p.get(c) for c in cols}, "error": None})
                except Exception as e:  # noqa: BLE001 - failures become rows
                    rows.append({"job_id": job_id, **own, "piece": -1, "kind": None, "error": f"{type(e).__name__}: {e}"})
            out = pd.DataFrame(rows, columns=["job_id", *keep, "piece", *cols, "error"])
            # explicit dtypes: all-null object columns do not convert to Arrow numbers
            for c in ("page", "block", "line", "span", "x1", "y1", "x2", "y2"):
                out[c] = pd.to_numeric(out[c], errors="coerce").astype("float64")
            out["piece"] = out["piece"].astype("int64")
            for c in ("kind", "text", "error"):
                out[c] = out[c].astype(object)
            yield pa.RecordBatch.from_pandas(out, schema=pa.schema([
                pa.field("job_id", given.field("job_id").type), *[pa.field(c, given.field(f"_{c}").type) for c in keep],
                *[pa.field(c, t) for c, t in types.items()]]), preserve_index=False)
    return run


def extract_documents(jobs: DataFrame, registry: dict | None = None, text: bool = True, images: bool = False,
                      tables: bool = False, charts: bool | None = None, text_depth: str = "document",
                      method: str | None = None, keep: tuple = (), **params) -> DataFrame:
    """jobs (job_id of any type, document_type, content) -> raw pieces (RAW_FIELDS) by the parser of
    each document type; ``kind`` filtered by the extract flags (charts default to the
    tables flag). The registry's keys are types, or (type, method): the parser of ``method`` where the type has
    one, else the type's. ``keep`` names columns of a job that its pieces carry. Repartition jobs by size before this when documents are skewed."""
    reg = {**DEFAULT_REGISTRY, **(registry or {})}
    charts = tables if charts is None else charts
    kept = "".join(f"`{c}` {jobs.schema[c].dataType.simpleString()}, " for c in keep)
    raw = jobs.select("job_id", "document_type", "content", *[F.col(c).alias(f"_{c}") for c in keep]).mapInArrow(
        _run_parsers(reg, {"text_depth": text_depth, **params}, method, keep),
        f"job_id {jobs.schema['job_id'].dataType.simpleString()}, {kept}{RAW_FIELDS}")
    kinds = (["text"] if text else []) + (["image"] if images else []) + (["table"] if tables else []) \
        + (["chart"] if charts else [])
    return raw.where(F.col("error").isNotNull() | F.col("kind").isin(*kinds))




def extract_elements(jobs: DataFrame, registry: dict | None = None, method: str | None = None, failing: tuple = ("pdf",), **params) -> DataFrame:
    """jobs (job_id, pos, document_type, content, source_id, source_name) -> elements with ``cm_failed``.

    Texts are rolled up to ``text_depth``, images and tables become elements of their own. A document that its
    parser rejects is an error row; if its type is in ``failing``, its whole job fails: ``cm_failed`` is true
    for all rows of that job, so that later stages skip it. The parsers run once: their pieces are staged."""
    keep = tuple(c for c in ("pos", "document_type", "source_id", "source_name") if c in jobs.columns)
    depth = params.get("text_depth", "document")
    raw = cut_lineage(extract_documents(jobs, registry, method=method, keep=keep, **params), "table")
    own = [c for c in ("job_id", "pos", "source_id", "source_name") if c in raw.columns]
    texts = raw.where("kind = 'text' AND error IS NULL").groupBy(*own, *DEPTH_KEYS[depth]).agg(_sorted_join("text", " ", ["piece"]).alias("text"))
    parts = [build_text_elements(texts.where(F.length("text") > 0).withColumn("text_type", F.lit(depth)))]
    of_kind = raw.where("error IS NULL").withColumn("content", F.col("text"))
    parts.append(build_image_elements(of_kind.where("kind = 'image'").drop("text")))
    parts.append(build_table_elements(of_kind.where("kind IN ('table', 'chart')").withColumn("subtype", F.col("kind")).drop("text")))
    errors = raw.where(F.col("error").isNotNull())
    rows = build_text_elements(errors.select(*own, F.lit("").alias("text"), F.col("error").alias("description")))
    parts.append(tag_error(rows, F.lit(True), F.col("metadata.content_metadata.description"), task="extract"))
    elements = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    failed = errors.where(F.lower("document_type").isin(*failing)).select(F.col("job_id").alias("_failed")).distinct() if "document_type" in keep else errors.select(F.col("job_id").alias("_failed")).limit(0)
    joined = elements.join(failed.withColumn("_hit", F.lit(True)), F.col("job_id").eqNullSafe(F.col("_failed")), "left")
    return joined.withColumn("cm_failed", F.coalesce("_hit", F.lit(False))).drop("_failed", "_hit")


def cloud_elements(df: DataFrame, json_col: str = "elements") -> DataFrame:
    """Hosted-service output (JSON array of {Path, Text, Page, Bounds}) -> raw pieces:
    a path that ends in ``/Figure`` is an image, one under a table a table, one that names
    neither a text; anything else inside a figure is dropped. Page and box are kept."""
    schema = "array<struct<Path:string,Text:string,Page:int,Bounds:array<double>>>"
    e = df.select("job_id", F.posexplode(F.from_json(F.col(json_col), schema)).alias("piece", "e"))
    path = F.col("e.Path")
    kind = (F.when(path.endswith("/Figure"), "image").when(path.contains("Table"), "table")
            .when(path.isNull() | ~path.contains("Figure"), "text"))
    b = F.col("e.Bounds")
    return e.select("job_id", "piece", kind.alias("kind"), F.col("e.Text").alias("text"),
                    F.col("e.Page").alias("page"), b[0].alias("x1"), b[1].alias("y1"), b[2].alias("x2"),
                    b[3].alias("y2")).where(F.col("kind").isNotNull())
