"""The registered queries of this package: each runs one operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import align, chat, lm, manifest, minhash, mixing, oracles, page_diff, pieces, quality, rules, token_files, topk, warc
from folio.llm.shared import load, shared_path, stage

# Tokenizer files that every machine has; another path can be set in the session.
BYTE_BPE = ("folio.llm.byteBpe", "byte_bpe_50k.json")
PIECES = ("folio.llm.pieces", "piece_bpe_32k.model")


def tokenizer(spark: SparkSession, which: tuple[str, str]) -> str:
    key, name = which
    return spark.conf.get(key, None) or public_tokenizers.path(name)


def op1_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under merge-dropout, and whether they decode to its text."""
    return pieces.encode_documents(load(spark, sf_dir, "documents"), tokenizer(spark, PIECES), seed=7, dropout=0.1)


def op2_warc_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC; for the drill, a damaged replica is written as an archive of its own, read back and audited."""
    path, replica = shared_path(spark, "warc"), shared_path(spark, "warc-replica")
    warc.write_warc(load(spark, sf_dir, "pages"), path)
    warc.write_records(warc.damaged(warc.read_warc(spark, path), warc.header_field("X-Key")), replica)
    index = warc.index(warc.catalog(spark, path))
    report = warc.fixity_report(index, warc.placed(warc.catalog(spark, replica), index))
    return report.select(F.expr("try_cast(key AS bigint)").alias("page_id"), F.col("offset").alias("archive_offset"),
                         F.col("bytes").alias("record_bytes"), F.col("hash").alias("record_sha256"), "status")


def op3_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, load(spark, sf_dir, "labels")))


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -1, whose texts look like the marks of a template."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    formatted = stage(chat.format_conversations(turns.unionByName(extra), tokenizer(spark, BYTE_BPE)), "chat")
    return chat.read_back(formatted)


def op6_topk_branch_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, scale=64.0)


def op7_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_files.write_tokens(load(spark, sf_dir, "documents"), path, tokenizer(spark, BYTE_BPE), end_id=0)
    return token_files.read_tokens(spark, path)


def op9_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_verdicts(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_held_out(load(spark, sf_dir, "documents"), order=3)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.array_join("lines", " ")
    return page_diff.extract_pages(load(spark, sf_dir, "pages")).select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer(spark, BYTE_BPE), tokenizer(spark, PIECES)
    aligned = align.align_documents(load(spark, sf_dir, "documents"), a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    thin = stage(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "pairs", "times"), "alignment")
    return align.score_links(thin, align.vocabulary_size(b)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, audited against texts that lost their line ends where crc32(doc_id) is even."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = {"text": F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    return manifest.audit(manifest.manifest(load(spark, sf_dir, "documents"), found=found)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece_dropout, op2_warc_merkle, op3_weighted_mix, op4_quality_gbt, op5_chat_windows, op6_topk_branch_bound,
    op7_minhash_components, op8_rans_tokens, op9_adaptive_rules, op10_kneser_ney, op11_page_differences,
    op12_token_alignment, op13_merkle_manifest)}
SQL = {"op2_warc_merkle": oracles.WARC, "op3_weighted_mix": oracles.MIX, "op6_topk_branch_bound": oracles.TOP_K,
       "op9_adaptive_rules": oracles.RULES, "op13_merkle_manifest": oracles.MANIFEST}
