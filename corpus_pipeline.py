"""A corpus pipeline of five stages, each one operator of ``folio.llm`` on all that the stage before kept.

Every stage is written as Parquet to the shared folder and read again as the next one's documents,
so a lost executor costs no more than the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm import minhash, mixing, pieces, quality, rules
from folio.llm.queries import PIECES, tokenizer
from folio.llm.shared import load, stage


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.filter_documents(docs, load(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the adaptive limits of their language and source."""
    return rules.filter_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the weighted mix of sources, repeated ones twice."""
    return mixing.mix_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document, with lang and source."""
    return pieces.encode_documents(docs, tokenizer(spark, PIECES), keep=("lang", "source"))


STAGES = [
    ("quality classifier", accept_quality),
    ("quality rules", apply_rules),
    ("near-duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode_pieces),
]
ORACLE_SQL = None  # trained trees, minima and seeded dropout are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
