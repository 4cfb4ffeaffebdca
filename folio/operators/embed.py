"""Embedding of text and table rows with a user-given function, in Arrow batches.

The model call is the user's ``embed(list[str]) -> list[list[float]]``. It runs inside
a pandas UDF on the executors, in batches of ``batch_size`` prompts; a failing batch
does not fail the task: its rows become ``info_message`` rows with an ``embed`` error
(``filter`` = ``filter_errors``) and no vector. Only the text column enters Python; vectors come back
beside their rows, so nothing is joined or shuffled: one Python hop per pipeline.
"""

from __future__ import annotations

import hashlib
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio import schema as S
from folio.functions.structs import build_struct

EmbedFn = Callable[[list], list]


def hashing_embedder(dim: int = 64) -> EmbedFn:
    """Deterministic test embedder: signed token hashing into ``dim`` buckets, L2-normalised."""
    def embed(texts: list) -> list:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for tok in str(t).lower().split():
                h = int.from_bytes(hashlib.blake2b(tok.encode(), digest_size=8).digest(), "little")
                out[i, h % dim] += 1.0 if (h >> 63) & 1 else -1.0
            n = np.linalg.norm(out[i])
            if n > 0:
                out[i] /= n
        return out.tolist()
    return embed


def batch_prompts(items: list, batch_size: int = 100) -> list[list]:
    """Consecutive batches of ``batch_size``; the last one may be shorter."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    return [items[i:i + batch_size] for i in range(0, len(items), batch_size)]


def _embed_column(fn: EmbedFn, batch_size: int):
    """Vector and error of every text, batch by batch; a null text has neither."""
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            vecs: list = [None] * len(texts)
            errs: list = [None] * len(texts)
            there = [i for i, t in enumerate(texts) if t is not None]
            for rows in batch_prompts(there, batch_size):
                try:
                    out = fn([texts.iloc[i] for i in rows])
                    if len(out) != len(rows):
                        raise ValueError(f"{len(out)} vectors for {len(rows)} texts")
                    for i, v in zip(rows, out):
                        vecs[i] = [float(x) for x in v]
                except Exception as e:  # noqa: BLE001 - a failed batch becomes data
                    for i in rows:
                        errs[i] = f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"vec": pd.Series(vecs, dtype=object), "err": pd.Series(errs, dtype=object)})
    return F.pandas_udf(run, "vec array<float>, err string")


def embed_elements(df: DataFrame, fn: EmbedFn | None = None, text: bool = True, tables: bool = True,
                   batch_size: int = 100, filter_errors: bool = False) -> DataFrame:
    """Embed embeddable text content and table content; set ``metadata.embedding``,
    ``_contains_embeddings`` and ``_content``. Other rows pass with no embedding."""
    fn = fn or hashing_embedder()
    t = F.col("document_type")
    src = F.lit(None).cast("string")
    if tables:
        src = F.when((t == "structured") & F.coalesce(F.col("metadata.table_metadata.table_content") != "",
                                                      F.lit(False)),
                     F.col("metadata.table_metadata.table_content")).otherwise(src)
    if text:
        src = F.when((t == "text") & F.coalesce(F.col("metadata.content") != "", F.lit(False)),
                     F.col("metadata.content")).otherwise(src)
    # one column goes to Python and back beside its row: no join, no shuffle, no id to agree on
    done = df.withColumn("_text", src).withColumn("_e", _embed_column(fn, batch_size)(F.col("_text")))
    md, err = F.col("metadata"), F.col("_e.err").isNotNull()
    info = build_struct(S.INFO_MESSAGE_METADATA, task=F.lit("embed"), status=F.lit("error"),
                        message=F.col("_e.err"), filter=F.lit(bool(filter_errors)))
    new_md = F.when(F.col("_text").isNull(), md).when(err, md.withField("info_message_metadata", info)).otherwise(
        md.withField("embedding", F.col("_e.vec")))
    return (done.withColumn("metadata", new_md)
                .withColumn("document_type", F.when(err, F.lit("info_message")).otherwise(t))
                .withColumn("_contains_embeddings", F.col("_e.vec").isNotNull())
                .withColumn("_content", F.col("_text"))
                .drop("_text", "_e"))


def embed_text(df: DataFrame, fn: EmbedFn | None = None, **kw) -> DataFrame:
    return embed_elements(df, fn, text=True, tables=False, **kw)


def embed_tables(df: DataFrame, fn: EmbedFn | None = None, **kw) -> DataFrame:
    return embed_elements(df, fn, text=False, tables=True, **kw)


def merge_embedded(df: DataFrame) -> DataFrame:
    """Embedded and untouched rows in one table: rows never embedded get
    ``_contains_embeddings = false`` (a projection, no union)."""
    has = F.col("_contains_embeddings") if "_contains_embeddings" in df.columns else F.lit(None)
    return df.withColumn("_contains_embeddings", F.coalesce(has, F.lit(False)))
