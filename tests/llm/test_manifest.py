"""Merkle manifests against a plain tree in Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from folio.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, node string, path int, key string, n int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(nodes):
    """(root, for each node the siblings before and after it on each level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, p in enumerate(at):
            run = level[p - p % 3:p - p % 3 + 3]
            paths[k].append(("".join(run[:p % 3]), "".join(run[p % 3 + 1:])))
        level = [digest(*level[i:i + 3]) for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return level[0], paths


def brute(rows, change):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    subs, out = {}, []
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        subs[s] = tree([leaf(r, r[4]) for r in own])
    root, above = tree([subs[s][0] for s in order])
    for s, own in by.items():
        for r, path in zip(own, subs[s][1]):
            path = path + above[order.index(s)]
            node = leaf(r, change(r))
            for left, right in path:
                node = digest(left, node, right)
            out.append((r[0], leaf(r, r[4]), subs[s][0], root, digest(*(left + right for left, right in path)), node, node == root))
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "k", 2) for r in rows], SCHEMA).repartition(5)
    found = {"text": F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    got = manifest.audit(manifest.manifest(docs, found=found))
    return [tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def change(r):
    return r[4].replace("\n", "") if r[4] is not None and r[0] is not None and r[0] % 2 == 0 else r[4]


def key(r):
    return r[0] is None, r[0] or 0, r[1:]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "SPAN", 3 ** levels)
    rng = random.Random(levels)
    sources = ["hot"] * 8 + ["b", "B", "é", None, "", "z", "ab"] + [f"s{i}" for i in range(11)]
    rows = [(i, rng.choice(sources), rng.choice(["en", None, "Ω"]), rng.choice([None, 5, -7]), rng.choice([None, "", "a\nb", "x" * 3000, "\n", "é\n"])) for i in range(240)]
    rows += [(7, "hot", "en", 1, "same\nrow")] * 90 + [(None, "hot", None, None, None)] * 2 + [(8, "b", "en", 1, "t1"), (8, "b", "en", 1, "t2")] + [(999, "alone", "en", 1, "a\nb")]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows, change), key=key)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "s", "en", 1, "a\nb") for i in range(n)]
    assert sorted(run(spark, rows), key=key) == (sorted(brute(rows, change), key=key) if n else [])
