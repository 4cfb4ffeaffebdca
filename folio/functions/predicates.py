"""Lookups and predicates as column expressions (map literals, not joins)."""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.schema import DOC_TO_CONTENT

# File extension -> document type. md, sh, json read as text; jpg as jpeg.
EXTENSION_TO_DOCUMENT_TYPE = {
    "bmp": "bmp", "docx": "docx", "html": "html", "jpeg": "jpeg", "jpg": "jpeg", "json": "text",
    "md": "text", "pdf": "pdf", "png": "png", "pptx": "pptx", "sh": "text", "svg": "svg",
    "txt": "text",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def doc_type_to_content_type(c) -> Column:
    """bmp/jpeg/png/svg -> image; docx/html/pdf/pptx -> structured; txt/text -> text."""
    return F.element_at(map_literal(DOC_TO_CONTENT), F.lower(_col(c)))


def extension(path) -> Column:
    return F.lower(F.regexp_extract(_col(path), "\\.([^./\\\\]*)$", 1))


def infer_document_type_col(path) -> Column:
    """Lower-cased extension -> document type; unknown -> null (caller flags it)."""
    return F.element_at(map_literal(EXTENSION_TO_DOCUMENT_TYPE), extension(path))


def is_subset(col, subset, _path: str = "$") -> Column:
    """Column predicate: the JSON text in ``col`` contains ``subset`` recursively.

    ``"*"`` matches anything; a dict matches when every key matches; a list matches when
    every item of ``subset`` is matched by some item at that path; scalars compare equal.
    The literal is compiled to ``get_json_object`` paths on the driver (it is a literal,
    not data).
    """
    col = _col(col)
    if subset == "*":
        return F.lit(True)
    if isinstance(subset, dict):
        conds = [is_subset(col, v, f"{_path}.{k}") for k, v in subset.items()]
        return F.get_json_object(col, _path).isNotNull() & _all(conds)
    if isinstance(subset, list):
        arr = F.from_json(F.get_json_object(col, _path), "array<string>")
        conds = []
        for item in subset:
            if item == "*":
                conds.append(F.size(arr) > 0)
            elif isinstance(item, (dict, list)):
                conds.append(F.exists(arr, _nested_match(item)))
            else:
                conds.append(F.exists(arr, _scalar_match(item)))
        return arr.isNotNull() & _all(conds)
    return _scalar_eq(F.get_json_object(col, _path), subset)


def _nested_match(item):
    # one-argument lambdas only: Spark reads a second parameter as the element index
    return lambda e: is_subset(e, item, "$")


def _scalar_match(item):
    return lambda e: _scalar_eq(e, item)


def _scalar_eq(c: Column, v) -> Column:
    if isinstance(v, bool):
        return F.lower(c) == F.lit(json.dumps(v))
    if isinstance(v, (int, float)):
        return c.try_cast("double") == F.lit(float(v))
    if v is None:
        return c.isNull()
    return c == F.lit(str(v))


def _all(conds) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out
