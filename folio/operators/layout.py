"""Layout-model text: token parsing, class filtering, box un-padding, markdown cleanup.

A layout model returns one string per page with runs of
``<x_n><y_n>text<x_n><y_n><class_c>``. Parsing is ``regexp_extract_all`` per group and
``arrays_zip`` + ``inline``; cleanup is a fixed chain of ``regexp_replace`` calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.geometry import reverse_transform_bbox
from folio.operators.filters import filter_by_class

# The layout token pattern (DOTALL) and the markdown-to-plain rewrite chain,
# in order, as (Java regex, replacement). The inline-math rule has two forms.
LAYOUT_TOKEN = "(?s)<x_(\\d+)><y_(\\d+)>(.*?)<x_(\\d+)><y_(\\d+)><class_([^>]+)>"
MD_REWRITES_HEAD = [
    ("\\(\\[https?://[^\\s\\]]+\\]\\((https?://[^\\s\\]]+)\\)\\)", "($1)"),
    ("(?U)#+\\s", ""),
    ("\\*\\*", ""),
    ("(?d)\\*(.*?)\\*", "$1"),
    ("(?U)(?<!\\w)_([^_]+)_", "$1"),
    ("</?su[pb]>", ""),
]
MD_INLINE_MATH_KEEP = ("(?d)\\\\\\((.*?)\\\\\\)", "$1")
MD_INLINE_MATH_DROP = ("(?d)\\\\\\((.*?)\\\\\\)", "")
MD_REWRITES_TAIL = [
    ("(?mdU)^\\*\\s", ""),
    ("(?s)\\\\begin\\{table\\}(.*?)\\\\end\\{table\\}", ""),
    ("(?s)\\\\begin\\{tabular\\}(.*?)\\\\end\\{tabular\\}", "<table>"),
    ("(?s)```.*?```", ""),
    ("(?s)\\\\\\[(.*?)\\\\\\]", ""),
    ("(?d)\\$(.*?)\\$", ""),
    ("(?s)\\|.*?\\|", ""),
    ("\\\\", ""),
]


def markdown_to_plain(c, remove_inline_math: bool = False) -> Column:
    """Markdown / LaTeX-ish model output -> plain text (the fixed rewrite chain, then
    Unicode-aware strip)."""
    out = F.col(c) if isinstance(c, str) else c
    chain = MD_REWRITES_HEAD + [MD_INLINE_MATH_DROP if remove_inline_math else MD_INLINE_MATH_KEEP] \
        + MD_REWRITES_TAIL
    for pat, rep in chain:
        out = F.regexp_replace(out, pat, rep)
    return F.regexp_replace(out, "^(?U)\\s+|(?U)\\s+$", "")


def parse_layout_tokens(df: DataFrame, text_col: str = "raw") -> DataFrame:
    """One row per layout token: token (0-based), class, x1, y1, x2, y2, text."""
    keep = [c for c in df.columns if c != text_col]
    groups = [F.regexp_extract_all(F.col(text_col), F.lit(LAYOUT_TOKEN), i) for i in range(1, 7)]
    z = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ["x1", "y1", "text", "x2", "y2", "class"])])
    return (df.select(*keep, F.posexplode(z).alias("token", "_t"))
              .select(*keep, "token", F.col("_t.class").alias("class"),
                      *[F.col(f"_t.{k}").cast("long").alias(k) for k in ("x1", "y1", "x2", "y2")],
                      F.col("_t.text").alias("text")))


def layout_elements(df: DataFrame, text_col: str = "raw", offset_x_col: str = "pad_x",
                    offset_y_col: str = "pad_y", width: int = 1024, height: int = 1280) -> DataFrame:
    """Raw layout output -> tokens -> class filter (rejected classes keep no text) ->
    un-padded boxes -> cleaned text; ``kind`` = text / table / picture by class.
    Tables and pictures are kept independently of the text flag."""
    t = parse_layout_tokens(df, text_col)
    kind = (F.when(F.col("class") == "Table", "table").when(F.col("class") == "Picture", "picture")
            .otherwise("text"))
    t = t.withColumn("kind", kind)
    texts = filter_by_class(t.where(F.col("kind") == "text"), "class", "text")
    t = texts.unionByName(t.where(F.col("kind") != "text"))
    ox = F.col(offset_x_col) if offset_x_col in df.columns else F.lit(0)
    oy = F.col(offset_y_col) if offset_y_col in df.columns else F.lit(0)
    bb = reverse_transform_bbox(F.array("x1", "y1", "x2", "y2"), ox, oy, width, height)
    return (t.withColumn("bbox", bb)
             .withColumn("text", F.when(F.col("kind") == "text", markdown_to_plain(F.replace(F.col("text"), F.lit("<tbc>"), F.lit(""))))
                         .otherwise(F.col("text"))))
