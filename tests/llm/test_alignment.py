"""Alignment of two tokenizers against whole texts, token by token."""

import hashlib
import random
from collections import defaultdict

import public_tokenizers
from brute import HARD_TEXTS
from pyspark.sql import functions as F

from folio.llm import align
from folio.llm.shared import stage

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
HARD = [None, "", " ", "  ", "a", " a", "a ", "  a  b  ", "a\n b", "a \n\n  b\t c", "é 漢字 😀😀 ｆｕｌｌ", "<|endoftext|> x <s> </s> [INST]", "▁", "a ▁b", "a b   c",
        "don't we'll I'M", "=" * 700, "-- -- --", "x\x00y \x1c z", "ab" * 900, "word " * 400, "漢" * 300, "é ​ q﻿", "1234567 89,000.50", "\r\n\r\n a\r b", "  \n 　 x"]


def plain(a, b, names, decode, text):
    """(A ids, B ids, groups) of one whole text, ends from decoded bytes only."""
    if not text:
        return [], [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    x_raw = [decode(i) for i in x]
    y_raw = [bytes([int(names[i][3:5], 16)]) if b.is_byte(i) else names[i].replace("▁", " ").encode() for i in y]
    whole = (" " + text).encode()
    if b"".join(x_raw) != whole or b"".join(y_raw) != whole:
        return [], [], []
    groups, one, other, p, q, j = [], [], [], 0, 0, 0
    for i, raw in zip(x, x_raw):
        one.append(i)
        p += len(raw)
        while j < len(y) and q < p:
            other.append(y[j])
            q += len(y_raw[j])
            j += 1
        if p == q:
            groups.append((one, other))
            one, other = [], []
    return x, y, groups


def brute(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    names = [b.id_to_piece(i) for i in range(b.vocab_size())]
    shown = [chr(c) if 33 <= c < 127 or 161 <= c < 173 or 174 <= c < 256 else None for c in range(256)]
    extra = iter(range(256, 512))
    back = {c or chr(next(extra)): i for i, c in enumerate(shown)}
    vocabulary = {i: e for e, i in a.get_vocab().items()}
    found = [plain(a, b, names, lambda i: bytes(back[c] for c in vocabulary[i]), t) for _, t in rows]
    docs = defaultdict(int)
    for _, _, groups in found:
        for pair in {(x, y) for g, h in groups for x in g for y in h}:
            docs[pair] += 1
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), (x, y, groups) in zip(rows, found):
        links = [docs[p, q] for g, h in groups for p in g for q in h]
        tops = [docs[p, q] == best[p] for g, h in groups for p in g for q in h]
        shape = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, len(x), len(y), len(groups), len(links), sum(tops), sum(links), hashlib.sha256(shape.encode()).hexdigest() if x else ""))
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, pairs string, n_a int").repartition(3)
    aligned = align.align_documents(docs, A, B)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("sha")
    thin = stage(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"), "alignment")
    return [tuple(r) for r in align.score_links(thin, align.vocabulary_size(B)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha").collect()]


def random_texts(rng, n):
    parts = ["the", "of", " ", "  ", "\n", "\t", "é", "ß", "漢字", "😀", "'s", "12", ".", ",", "==", "▁", " ", "Wörter", "ing", "tion", "<s>", "a", "\x85"]
    weights = [9, 9, 30, 4, 3, 1, 3, 2, 2, 2, 2, 3, 4, 4, 1, 0.05, 1, 3, 5, 5, 0.3, 5, 0.5]
    return ["".join(rng.choices(parts, weights, k=rng.randrange(0, 60))) for _ in range(n)]


def test_alignment_equals_whole_texts(spark):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(HARD + list(HARD_TEXTS) + random_texts(rng, 400))] + [(3, "a"), (3, "a b"), (None, "the end")] + [(900 + i, "again and again") for i in range(200)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_alignment_of_the_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(run(spark, rows)) == sorted(brute(rows))


def test_pieces_are_forgotten_without_change(monkeypatch):
    rng = random.Random(9)
    texts = random_texts(rng, 300)
    whole = align.Aligned(align.Tokenizers(A, B)).documents(texts, True)
    monkeypatch.setattr(align, "KEPT", 20)
    small = align.Aligned(align.Tokenizers(A, B))
    found = [small.documents(texts[lo:lo + 7], True) for lo in range(0, 300, 7)]
    assert [g for f in found for g in f[1]] == whole[1] and [e for f in found for e in f[2]] == whole[2]
    assert [r for f in found for r in f[0].tolist()] == whole[0].tolist()
    assert [p for f in found for p in f[3].to_pylist()] == whole[3].to_pylist() and [p for f in found for p in f[4].to_pylist()] == whole[4].to_pylist()


def test_ends_are_bytes_where_both_end():
    aligned = align.Aligned(align.Tokenizers(A, B))
    text = "naïve 漢字 =====  x"
    _, groups, ends, _, _ = aligned.documents([text], True)
    assert len(ends[0]) == groups[0].count(";") + 1 and ends[0][-1] == len((" " + text).encode()) and ends[0] == sorted(set(ends[0]))


def test_no_documents(spark):
    assert run(spark, []) == []
