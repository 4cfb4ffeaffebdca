"""Mixing, rules, chat windows, top-k and archives against plain statements."""

import hashlib
import random

import pytest
from brute import HARD_TEXTS, dup_lines, repeat_words, words
from pyspark.sql import functions as F

import public_tokenizers
from folio.llm import chat, mixing, rules, topk, warc
from folio.llm.shared import shared_path, stage

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, size string, target int, kept int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS).repartition(3)


# ---- mixing -----------------------------------------------------------------------------------

def shared_out(sizes: dict) -> dict:
    """Targets by sharing the excess of full sources again and again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def corpus(rng, sources, n):
    return [(i, " ".join(["w"] * rng.randrange(1, 60)), "en", rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sources", [["b", "a", "é", None, "a b", "z", "Z"], ["hot"] * 30 + ["x", "y"], ["only"]])
def test_mix_reaches_its_targets(spark, sources):
    rng = random.Random(len(sources))
    rows = corpus(rng, sources, 700) + [(5000 + i, t, "en", "hard") for i, t in enumerate(HARD_TEXTS[:12])] + [(7, "again w w", "en", "a")] * 3
    got = mixing.plan_mix(frame(spark, rows)).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = shared_out(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - want[s]) <= largest + 1 for s in sizes) and sum(taken.values()) <= sum(want.values()) + 1e-6
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.plan_mix(frame(spark, rows).repartition(7)).collect()))


def test_mixed_documents_are_the_plan_s_copies(spark):
    rows = corpus(random.Random(2), ["a", "b", None, "c"], 400) + [(900, "", "en", "a"), (901, None, "en", "b")]
    docs = frame(spark, rows)
    plan = {r.doc_id: r.copies for r in mixing.plan_mix(docs).collect()}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: c for i, c in plan.items() if c}


def test_mix_of_nothing(spark):
    assert mixing.plan_mix(frame(spark, [])).collect() == []
    got = mixing.plan_mix(frame(spark, [(1, "", "en", "a"), (2, None, None, None), (None, " ", "en", "b")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3
    assert mixing.mix_documents(frame(spark, [(1, "", "en", "a")])).collect() == []


# ---- rules --------------------------------------------------------------------------------------

def test_counts_of_texts(spark):
    texts = [*HARD_TEXTS, "a b c a b c a b c d", "a a a a", "x y z\nx y z\n\n \nX y z", "p q r s p q r t q r s"]
    got = rules.measured(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), keep=("doc_id",)).collect()
    for r in got:
        t = texts[r.doc_id] or ""
        w = words(t)
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), repeat_words(t), dup_lines(t)), t[:40]
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t) and r.n_capitals == sum("A" <= c <= "Z" for c in t)
    assert len(got) == len(texts)


def good(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(3, 8))) for _ in range(n)) + ".\nMore here."


def test_limits_adapt_to_their_cell(spark):
    """A share of symbols that is usual in one source fails in another."""
    rng = random.Random(8)
    prose = [(i, good(rng, 80), "en", "prose") for i in range(150)]
    tables = [(1000 + i, good(rng, 60) + " |" * 30, "en", "tables") for i in range(150)]
    odd = [(2000, good(rng, 60) + " |" * 30, "en", "prose"), (2001, good(rng, 80), "en", "tables"), (2002, good(rng, 20), "en", "prose"), (2003, "x y z " * 40, "en", "prose"),
           (2004, good(rng, 80).upper(), "en", "prose"), (2005, good(rng, 80), None, None), (None, None, "en", "prose"), (2006, good(rng, 80), "xx", "tiny")]
    got = {r.doc_id: r for r in rules.quality_verdicts(frame(spark, [*prose, *tables, *odd])).collect()}
    assert all(got[i].kept for i, *_ in [*prose, *tables])
    assert "symbols" in got[2000].outside and not got[2000].kept
    assert got[2002].base_failed and got[2003].base_failed and not got[2003].kept and got[None].base_failed
    assert "capitals" in got[2004].outside and got[2005].kept and got[2006].kept


def test_filtered_documents_are_those_kept(spark):
    rng = random.Random(9)
    rows = [(i, good(rng, 60) + (" #" * 40 if i % 9 == 0 else ""), rng.choice(["en", None]), rng.choice(["a", "b", None])) for i in range(300)]
    docs = frame(spark, rows).withColumn("n_words", F.lit("clash"))
    kept = rules.filter_documents(docs)
    assert kept.columns == docs.columns and {r.n_words for r in kept.collect()} == {"clash"}
    want = {r.doc_id for r in rules.quality_verdicts(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and 200 < len(want) < 300
    assert rules.quality_verdicts(frame(spark, [])).collect() == [] and rules.filter_documents(frame(spark, [])).collect() == []


def test_sketches_merge_in_any_order(spark):
    values = [(v,) for v in [0, 1, 63, 64, 65, 127, 128, 1000, 1023, 1024, 10**6, 10**12]]
    got = spark.createDataFrame(values, "v long").select("v", rules.bucket("v").alias("b")).collect()
    assert all(r.b <= r.v < r.b + max(1, r.b / 32) + 1e-9 or r.v == r.b for r in got)


# ---- chat -----------------------------------------------------------------------------------------

CONTROL = ["</s>", "[INST]", "<|im_end|>\n", "\\", "<\\s>", "<|im_start|>user\n", "<<SYS>>[/INST]", "<<s>", "[[INST]", "\\<s>"]


def conversations(rng):
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 14)):
            role = "system" if t == 0 and c % 3 == 0 else "user" if t % 2 else "assistant"
            body = "".join(rng.choice([*CONTROL, "word ", "é ", "\n"]) for _ in range(rng.randrange(0, 40))) * rng.choice([1, 1, 1, 8])
            rows.append((c, t, role, body))
    rows += [(100, 0, None, None), (100, None, "user", "x"), (None, 1, "assistant", "of null"), (None, 0, "user", ""), (101, 1, "assistant", "twice"), (101, 1, "assistant", "twice"),
             (102, 0, "ro\nle\\", "odd role"), (103, 0, "assistant", "long " * 3000), (104, 0, "system", "s " * 500), (104, 1, "system", "t " * 500), (104, 2, "assistant", "a")]
    return rows


def digest(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2] is not None, r[2] or ""))
        learned = "".join(t or "" for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(60, 20), (200, 100), (100000, 10), (40, 0)])
def test_windows_hold_every_turn_and_learn_each_answer_once(spark, budget, history):
    rows = conversations(random.Random(budget))
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, window string").repartition(4)
    formatted = stage(chat.format_conversations(df, BYTE_BPE, budget, history), "chat")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == digest(rows)
    for w in formatted.collect():
        turns = chat.parse(w.text)
        new = len(turns) - w.n_repeated
        assert new >= 1 and (w.n_tokens <= budget or len(turns) == 1), (w.n_tokens, new)
        assert [chat.unescape(w.text[a:b]) for a, b in zip(w.loss_starts, w.loss_ends)] == [t for r, t in turns[w.n_repeated:] if r == "assistant"]
    sums = {r.conv_id: r for r in formatted.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("w")).collect()}
    assert all(r.formatted_chars == sums[r.conv_id].n and r.n_windows == sums[r.conv_id].w for r in chat.read_back(formatted).collect())


def test_windows_repeat_system_turn_and_history():
    turns = [("system", "S", 10), *[("user" if i % 2 == 0 else "assistant", f"t{i}", 10) for i in range(8)]]
    out = list(chat.windows(iter(turns), 50, 20))
    texts = [[t for _, t in chat.parse(w["text"])] for w in out]
    assert texts == [["S", "t0", "t1", "t2", "t3"], ["S", "t2", "t3", "t4", "t5"], ["S", "t4", "t5", "t6", "t7"]]
    assert [w["n_repeated"] for w in out] == [0, 3, 3]


def test_many_system_turns_cost_no_more_than_others():
    turns = [("system", f"s{i}", 100) for i in range(10_000)] + [("user" if i % 2 == 0 else "assistant", f"t{i}", 10) for i in range(400)]
    out = list(chat.windows(iter(turns), 1024, 256))
    assert all(w["n_tokens"] <= 1024 for w in out) and len(out) < 4 * 10_000 * 100 / 1024
    assert sum(w["n_tokens"] for w in out) < 4 * sum(t[2] for t in turns)
    new = [t for w in out for t in chat.parse(w["text"])[w["n_repeated"]:]]
    assert new == [(r, t) for r, t, _ in turns]
    assert all(chat.parse(w["text"])[0] == ("system", "s0") for w in out)
    huge = list(chat.windows(iter([("system", "S", 900), ("user", "u", 100), ("assistant", "a", 200), ("user", "v", 50)]), 1024, 0))
    assert [[t for _, t in chat.parse(w["text"])] for w in huge] == [["S", "u"], ["a", "v"]]


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice([*CONTROL, "<", "|", "s", "/", ">", "[", "\\", "im_end"]) for _ in range(rng.randrange(12)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df, BYTE_BPE)).collect() == []


# ---- top-k ------------------------------------------------------------------------------------------

def brute_top(rows, k, scale=64):
    import math

    whole = {}
    clean = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in clean:
        if q % 20 == 0:
            scored = sorted(((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), c) for c, w in clean if c != q))[:k]
            whole[q] = [(n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return whole


@pytest.mark.parametrize("kind", ["normal", "ties", "huge", "skewed"])
def test_top_k_equals_all_products(spark, kind):
    import numpy as np

    rng = np.random.default_rng(len(kind))
    n, d = 600, 21
    x = {"normal": lambda: rng.normal(size=(n, d)), "ties": lambda: rng.integers(0, 2, (n, d)).astype(float), "huge": lambda: rng.normal(size=(n, d)) * 1e12,
         "skewed": lambda: rng.normal(size=(n, d)) * (0.5 ** np.arange(d))}[kind]()
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(700, None), (701, []), (702, [1.0, None]), (703, [float("nan")] * d), (704, [float("inf")] * d), (None, [1.0] * d), (705, [1.0] * 5), (720, [2.0] * 30), (706, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 20 = 0"), k=7, shard=150).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute_top(rows, 7)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 2, 64 * 192), (0, 2, 1, 64 * 128)]
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []
    one = df.where("vec_id = 0")
    assert topk.top_k(one, one).collect() == []


# ---- archives -----------------------------------------------------------------------------------------

def pages(spark, n):
    rows = [(i, f"http://h{i % 3}/p{i}", ("<html>é " + "x" * (i * 37 % 900) + "\r\n\r\nWARC/1.1\r\n") if i % 11 else t) for i, t in zip(range(n), HARD_TEXTS * (n // len(HARD_TEXTS) + 1))]
    rows += [(None, None, None), (3, "http://h/again", "a"), (3, "http://h/again", "a")]
    return rows, spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, hash string").repartition(4)


def test_archives_hold_every_page(spark):
    rows, df = pages(spark, 300)
    path = shared_path(spark, "warc")
    warc.write_warc(df, path)
    got = warc.read_warc(spark, path).withColumn("key", warc.header_field("X-Key")).withColumn("url", warc.header_field("WARC-Target-URI")).collect()
    assert sorted((r.key, r.url, bytes(r.body)) for r in got) == sorted((str(i) if i is not None else "", u or "", (h or "").encode()) for i, u, h in rows)
    assert all(r.header.startswith("WARC/1.1\r\n") and f"Content-Length: {len(r.body)}\r\n" in r.header for r in got)


@pytest.mark.parametrize("bad", [set(), {0}, {17, 18, 250}, set(range(0, 303, 2)), set(range(303))])
def test_audit_finds_exactly_the_damage(spark, bad):
    rng = random.Random(6)
    offsets, at = [], 0
    for _ in range(303):
        offsets.append(at)
        at += rng.randrange(100, 400_000)
    first = spark.createDataFrame([(o, f"h{i}") for i, o in enumerate(offsets)], "offset long, hash string")
    kinds = {i: ("corrupt", "missing", "extra")[i % 3] for i in bad}
    second = [(o, f"h{i}" if i not in bad else "other") for i, o in enumerate(offsets) if kinds.get(i) != "missing"]
    want = {(offsets[i], k) for i, k in kinds.items() if k != "extra"}
    second += [(offsets[i] + 1, "new") for i, k in kinds.items() if k == "extra"]
    second = [(o, h if kinds.get(offsets.index(o) if o in offsets else -1) != "extra" else f"h{offsets.index(o)}") for o, h in second]
    want |= {(offsets[i] + 1, "extra") for i, k in kinds.items() if k == "extra"}
    got = warc.audit(first, spark.createDataFrame(second, "offset long, hash string"))
    assert {(r.offset, r.status) for r in got.collect()} == want


def replica(spark, records):
    path = shared_path(spark, "replica")
    warc.write_records(records, path)
    return warc.catalog(spark, path)


def test_report_covers_all_records(spark):
    rows, df = pages(spark, 400)
    path = shared_path(spark, "warc")
    warc.write_warc(df, path)
    index = warc.index(warc.catalog(spark, path))
    broken = replica(spark, warc.damaged(warc.read_warc(spark, path), warc.header_field("X-Key")))
    report = warc.fixity_report(index, warc.placed(broken, index)).collect()
    mark = {r.key: hashlib.md5(r.key.encode()).hexdigest()[:2] for r in report}
    assert len(report) == len(rows)
    assert all(r.status == {"00": "corrupt", "01": "missing"}.get(mark[r.key], "ok") for r in report)
    ends = sorted((r.offset, r.bytes) for r in report)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))


def test_a_replica_s_shifted_records_keep_their_places(spark):
    rows, df = pages(spark, 200)
    path = shared_path(spark, "warc")
    warc.write_warc(df, path)
    records = stage(warc.read_warc(spark, path), "records")
    index = stage(warc.index(warc.catalog(spark, path)), "index")
    key = warc.header_field("X-Key")

    def statuses(changed):
        got = warc.fixity_report(index, warc.placed(replica(spark, changed), index)).collect()
        return sorted((r.key, r.status) for r in got if r.status != "ok"), len(got)

    assert statuses(records) == ([], len(rows))
    assert statuses(records.where(key != "3")) == ([("3", "missing")] * 3, len(rows))
    assert statuses(records.where(key != "50").orderBy(F.desc("at"))) == ([("50", "missing")], len(rows))  # lost and moved
    added = records.limit(1).withColumn("header", F.regexp_replace(F.regexp_replace("header", "urn:uuid:....", "urn:uuid:ffff"), "X-Key: .*?\r", "X-Key: 999\r"))
    assert statuses(records.unionByName(added)) == ([("999", "extra")], len(rows) + 1)
    longer = records.withColumn("body", F.when(key == "60", F.concat("body", F.lit(b"more \xff"))).otherwise(F.col("body")))
    assert statuses(longer) == ([("60", "corrupt")], len(rows))  # its length is wrong, too
    cut = records.withColumn("header", F.when(key == "61", F.regexp_replace("header", "Content-Length: .*?\r", "Content-Length: x\r")).otherwise(F.col("header")))
    assert ("61", "corrupt") in statuses(cut)[0]


def test_empty_archive(spark):
    _, df = pages(spark, 30)
    path = shared_path(spark, "warc")
    warc.write_warc(df.limit(0), path)
    records = warc.read_warc(spark, path)
    assert records.collect() == []
    none = spark.createDataFrame([], "offset long, hash string")
    assert warc.audit(none, none).collect() == []
