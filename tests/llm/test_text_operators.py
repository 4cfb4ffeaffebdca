"""Tokens, pieces, the language model, near-duplicates and quality against plain statements."""

import json
import math
import os
import random
import resource
import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from brute import HARD_TEXTS, KneserNey, lower, near_components, words
from pyspark.sql import functions as F

import public_tokenizers
from folio.llm import components, lm, minhash, pieces, quality, rans, shared, textnum, token_files
from folio.llm.shared import shared_path

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, score double, kept string"


def frame(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame([(i, t, "en", "s", 0.5, "x") for i, t in rows], DOCS).repartition(3)


def hard(extra=()):
    return [*enumerate(HARD_TEXTS), (5, HARD_TEXTS[5]), (None, "null id"), (None, None), *extra]


# ---- word hashes ----------------------------------------------------------------------------

def test_words_of_bytes_are_the_words_of_the_pattern():
    import pyarrow as pa

    texts = [t or "" for t in HARD_TEXTS]
    for limit in (1, 100, 1 << 20):
        got = []
        for _, _, buf, offs in textnum.chunks(pa.array(texts), limit):
            starts, ends, first = textnum.word_bounds(buf, offs)
            low = bytes(textnum._LOWER[buf])
            got += [[low[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
        assert got == [words(lower(t)) for t in texts]


def test_equal_words_have_equal_hashes_and_others_do_not():
    import pyarrow as pa

    texts = ["Ab ab aB b a", "ab", "x ab y " * 50, "ba abab aba ab"]
    seen = {}
    for limit in (1, 1 << 20):
        for lo, _, buf, offs in textnum.chunks(pa.array(texts), limit):
            starts, ends, _ = textnum.word_bounds(buf, offs)
            low = bytes(textnum._LOWER[buf])
            for s, e, h in zip(starts, ends, textnum.word_hashes(buf, starts, ends)):
                assert seen.setdefault(low[s:e], h) == h
    assert len(set(seen.values())) == len(seen)


# ---- range coder and token files --------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 65535, 65536, 65537, 81925, 200_000])
def test_range_coder_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.2, n) % 50_000).astype(np.uint32)
    assert np.array_equal(rans.decode(rans.encode(ids)), ids)


def test_range_coder_shrinks_and_detects_damage():
    ids = (np.random.default_rng(1).zipf(1.5, 100_000) % 50_000).astype(np.uint32)
    coded = rans.encode(ids)
    assert len(coded) < 1.2 * len(ids)
    for at in (0, 30, len(coded) // 2, len(coded) - 1):
        bad = bytearray(coded)
        bad[at] ^= 0x55
        with pytest.raises(rans.CorruptSegment):
            rans.decode(bytes(bad))


def test_frequencies_add_up_however_rare_the_symbols():
    for counts in ([1], [10**9, *[1] * 60_000], [1] * 200_000, np.arange(1, 3000)):
        f = rans.frequencies(np.array(counts))
        assert f.sum() == 1 << rans.SCALE and f.min() >= 1


@pytest.mark.parametrize("cached", [900_000, 40])
def test_cached_tokenizer_gives_the_ids_of_whole_texts(monkeypatch, cached):
    monkeypatch.setattr(token_files, "_CACHED", cached)
    t = token_files.WholeTexts(BYTE_BPE, 0)
    texts = [x or "" for x in HARD_TEXTS] + ["a b", "a  b", "b ", " b", "a \u00a0b", "a \u3000 b", "a \x1cb", "a \x85b", "don't, stop. <|endoftext|> x", "word. word, word! word", "", " "]
    for _ in range(3):
        ids, sizes = t.encode(pa.array(texts))
        want = [[*e.ids, 0] for e in t.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_token_files(spark):
    rows = hard([(100 + i, f"text {i} of some") for i in range(300)])
    path = shared_path(spark, "tokens")
    token_files.write_tokens(frame(spark, rows), path, BYTE_BPE, segment_tokens=500)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    ids = {r.doc_id: r.ids for r in token_files.read_ids(spark, path).where("doc_id >= 100").collect()}
    assert ids[101] == [*t.encode("text 1 of some", add_special_tokens=False).ids, 0]


def test_an_id_held_by_a_third_of_the_rows_is_dealt_out(spark):
    rows = [(5, f"text {i}") for i in range(400)] + [(None, "same")] * 400 + [(i, f"other {i}") for i in range(400)]
    path = shared_path(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_tokens(frame(spark, rows), path, BYTE_BPE)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(path).select("part", F.size("doc_ids").alias("n")).collect()
    assert sum(r.n for r in parts) == 1200 and max(r.n for r in parts) < 400
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))


def test_token_files_of_no_documents(spark):
    path = shared_path(spark, "tokens")
    token_files.write_tokens(frame(spark, []), path, BYTE_BPE)
    assert token_files.read_tokens(spark, path).collect() == []


# ---- pieces -----------------------------------------------------------------------------------

def test_pieces_without_dropout_are_the_library_s():
    from sentencepiece import SentencePieceProcessor

    sp, table = SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES)
    texts = [t or "" for t in HARD_TEXTS if "▁" not in (t or "")]
    ids, counts = pieces.encode(table, texts, np.arange(len(texts)), dropout=0.0)
    assert [ids[e - c:e].tolist() for e, c in zip(np.cumsum(counts), counts)] == [sp.encode(t) for t in texts]


def by_agenda(table, text, key, seed, dropout):
    """Merges one by one: the best candidate that dropout leaves, leftmost among equals."""
    sym = [int(table.char[ord(c)]) for c in " " + text] if text else []
    at = list(range(len(sym)))
    below = int(dropout * 2.0 ** 64)
    k = int(textnum.mix(np.array([key], np.int64).view(np.uint64) ^ textnum.mix(np.array([seed], np.uint64) + np.uint64(1)))[0])
    while True:
        best = None
        for i in range(len(sym) - 1):
            if sym[i] < 0 or sym[i + 1] < 0:
                continue
            new = int(table.merged(np.array([sym[i]]), np.array([sym[i + 1]]))[0])
            if new < 0:
                continue
            end = at[i + 2] if i + 2 < len(at) else len(text) + 1
            h = (k + sum(int(a) * int(b) for a, b in zip((at[i], at[i + 1], end), pieces._KEYS))) % (1 << 64)
            if int(textnum.mix(np.array([h], np.uint64))[0]) < below:
                continue
            cand = (int(table.rank[new]), i, new)
            best = min(best, cand) if best else cand
        if best is None:
            break
        _, i, new = best
        sym[i:i + 2], at[i:i + 2] = [new], [at[i]]
    out = []
    for s, a in zip(sym, at):
        out += [s] if 0 <= s < table.n else [int(table.byte_id[b]) for b in (" " + text)[a].encode()]
    return out


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_dropout_is_the_agenda_without_the_skipped_merges(dropout):
    table = pieces.load(PIECES)
    texts = [t[:120] for t in HARD_TEXTS if t] + ["Therhean nouons edereatiin, the of andthing."]
    keys = np.arange(len(texts)) * 7 - 3
    ids, counts = pieces.encode(table, texts, keys, 11, dropout)
    got = [ids[e - c:e].tolist() for e, c in zip(np.cumsum(counts), counts)]
    assert got == [by_agenda(table, t, k, 11, dropout) for t, k in zip(texts, keys.tolist())]


def test_long_chunks_by_heap_equal_lockstep(monkeypatch):
    table = pieces.load(PIECES)
    texts = ["thereandthing" * 30, "a" * 500, "x y z " * 10]
    want = pieces.encode(table, texts, np.arange(3), 3, 0.2)
    monkeypatch.setattr(pieces, "LONG", 2)
    got = pieces.encode(table, texts, np.arange(3), 3, 0.2)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))


def test_documents_decode_to_their_texts_and_segmentations_vary(spark):
    docs = frame(spark, hard())
    got = {s: pieces.encode_documents(docs, PIECES, keep=("score",), seed=s, dropout=0.3).collect() for s in (1, 2)}
    assert all(r.lossless for rows in got.values() for r in rows) and got[1][0].score == 0.5
    assert sorted(r.ids for r in got[1]) != sorted(r.ids for r in got[2])
    again = pieces.encode_documents(docs.repartition(5), PIECES, seed=1, dropout=0.3).collect()
    assert sorted((r.ids, r.ids_crc32) for r in again) == sorted((r.ids, r.ids_crc32) for r in got[1])
    back = pieces.decode_documents(pieces.encode_documents(docs, PIECES, dropout=0.3), PIECES).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in hard())
    assert pieces.encode_documents(frame(spark, []), PIECES).collect() == []


# ---- language model -----------------------------------------------------------------------------

@pytest.mark.parametrize("order", [2, 3])
def test_model_equals_dictionaries(spark, order):
    rng = random.Random(order)
    vocabulary = ["the", "of", "and", *(f"w{i}" for i in range(40))]
    texts = [" ".join(rng.choices(vocabulary, [60, 30, 20, *[1] * 40], k=rng.randrange(60))) for _ in range(150)]
    rows = hard([(1000 + i, t) for i, t in enumerate(texts)])
    docs = frame(spark, rows)
    got = lm.score_held_out(docs, order=order).collect()
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    model = KneserNey([t for i, t in rows if not out[i]], order)
    want = sorted((str(i), out[i], len(words(t)) + 1, sum(w in model.raw for w in [*words(lower(t or "")), "</s>"]), round(model.score(t), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {model.tokens}


def test_many_shards_give_the_same_model(spark):
    rows = [(i, f"the cat {i % 7} saw the dog {i % 5} of x{i}") for i in range(400)]
    docs = frame(spark, rows)
    one, many = lm.train(docs), lm.train(docs, shard_tokens=100)
    assert one.shard_bits == 0 and many.shard_bits > 3
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in lm.score(docs, m).collect()) for m in (one, many))
    assert a == b
    model = KneserNey([t for _, t in rows], 2)
    assert all(abs(s - model.score(dict(rows)[i])) < 1e-6 for i, s in a)


def test_packed_ngrams_lose_nothing():
    rng = np.random.default_rng(3)
    codes = lm.Codes(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    words_ = np.concatenate((codes.words, rng.integers(0, 1 << 63, 500, dtype=np.uint64)))
    for k, bits in ((1, 0), (2, 3), (3, 0), (3, 5), (4, 2)):
        columns = [rng.choice(words_, 2000) for _ in range(k)]
        count, raw = rng.integers(1, 1000, 2000), rng.integers(1, 1 << 40, 2000)
        sent = [(b.column(1)[0].as_py(), lm.unpack(b.column(2)[0].as_py(), codes)) for b in lm._send(k, columns, count, raw, np.empty(0, np.uint64), codes, bits)]
        assert len({shard for shard, _ in sent}) == len(sent) == 1 << bits
        got = sorted(zip(*(np.concatenate([s[1][0][j] for s in sent]).tolist() for j in range(k)), *(np.concatenate([s[1][i] for s in sent]).tolist() for i in (1, 2))))
        assert got == sorted(zip(*(c.tolist() for c in columns), count.tolist(), raw.tolist()))


def test_contexts_with_large_totals(spark):
    rows = [(i, f"a b x{i % 3} a c") for i in range(900)]
    model = KneserNey([t for _, t in rows], 3)
    got = lm.score(frame(spark, rows), lm.train(frame(spark, rows), order=3)).collect()
    assert all(abs(r.score - model.score(dict(rows)[r.doc_id])) < 1e-6 for r in got)


def test_sorted_keys_take_less_than_hashes_and_lose_nothing():
    rng = np.random.default_rng(5)
    for n, bits in ((0, 0), (1, 0), (1, 5), (300, 0), (5000, 3), (200_000, 7)):
        keys = rng.integers(0, (1 << (64 - bits)) - 1, n, np.uint64, True)
        if n > 1000:  # many keys in one place
            keys = np.concatenate((keys, keys[:1] + np.arange(40, dtype=np.uint64), (keys[1] >> np.uint64(16) << np.uint64(16)) + rng.integers(0, 1 << 16, 900, np.uint64)))
        keys = np.unique(keys & np.uint64((1 << (64 - bits)) - 1))
        notes = rng.integers(0, 1 << lm.Keys.room(len(keys), bits), len(keys)) if n else np.empty(0, np.int64)
        shard = np.uint64(5 % (1 << bits) << (64 - bits)) if bits else np.uint64(0)
        start, kept = lm.Keys.pack(keys | shard, notes, bits)
        assert n < 200_000 or start.nbytes + kept.nbytes < 6.5 * len(keys)
        asked = np.unique(np.concatenate((keys, keys + np.uint64(1), rng.integers(0, 1 << 57, 500, np.uint64))) & np.uint64((1 << (64 - bits)) - 1)) | shard
        which, found = lm.Keys(start, kept, bits).find(asked)
        assert dict(zip(asked[which].tolist(), found.tolist())) == dict(zip((keys | shard).tolist(), notes.tolist()))


def test_arrays_take_few_bytes_for_an_ngram(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(20_000)}" for _ in range(400))) for i in range(400)]
    model = lm.train(frame(spark, rows), order=3, path=str(tmp_path))
    size = sum(f.stat().st_size for f in tmp_path.iterdir() if not f.name.startswith("1-"))
    assert size < 26 * model.tokens  # both orders and the contexts of the higher: 30 bytes with whole hashes


def test_ngrams_of_one_order_are_on_disk_at_a_time(spark, monkeypatch):
    folders = [Path(d) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]
    shuffles = lambda: {f.name.split("_")[1] for d in folders for f in d.rglob("shuffle_*.data")}
    staged = []

    def stage(df, name, **how):
        before, out = shuffles(), shared.stage(df, name, **how)
        until = time.time() + 10
        while shuffles() - before and time.time() < until:  # they go in the background
            time.sleep(0.1)
        staged.append((name, shuffles() - before))
        return out

    monkeypatch.setattr(lm, "stage", stage)
    rows = [(i, f"the cat {i % 7} saw the dog {i % 5} of x{i}") for i in range(400)]
    model = lm.train(frame(spark, rows), order=3, shard_tokens=500)
    assert model.shard_bits > 0
    assert staged == [("lm-survey", set()), ("lm-3", set()), ("lm-2", set()), ("lm-1", set())]
    brute = KneserNey([t for _, t in rows], 3)
    assert all(abs(r.score - brute.score(dict(rows)[r.doc_id])) < 1e-6 for r in lm.score(frame(spark, rows), model).collect())


def test_open_files_do_not_grow_with_the_shards(spark):
    for n, shard_tokens in ((400, 30), (30, 2)):  # all shards have n-grams; some have none
        rows = [(i, f"the cat {i % 7} saw the dog {i % 5} of x{i} the x{i % 90} cat") for i in range(n)]
        model = lm.train(frame(spark, rows), order=3, shard_tokens=shard_tokens)
        assert model.shard_bits > 6 and len(model.heavy_ctx[3][0])
        names = os.listdir(model.path)
        assert len(names) <= 64 * 23 and not [f for f in names if f.startswith((".", "shards"))]
        limit = resource.getrlimit(resource.RLIMIT_NOFILE)
        resource.setrlimit(resource.RLIMIT_NOFILE, (len(os.listdir("/proc/self/fd")) + 64 * 23 + 10, limit[1]))
        try:  # 23 files a shard before
            texts = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows]), pa.array([i for i, _ in rows])], names=["_text", "doc_id"])
            got = pa.Table.from_batches(lm._score_task(model)(iter([texts]))).to_pylist()
        finally:
            resource.setrlimit(resource.RLIMIT_NOFILE, limit)
        brute = KneserNey([t for _, t in rows], 3)
        assert len(got) == n and all(abs(r["score"] - brute.score(dict(rows)[r["doc_id"]])) < 1e-6 for r in got)


def test_shards_merged_in_turns_are_the_same(tmp_path, monkeypatch):
    rng = np.random.default_rng(9)
    codes, heavy = lm.Codes(rng.integers(0, 1 << 63, 40, dtype=np.uint64)), np.array([lm.BOS])
    sent = []
    for _ in range(12):
        columns = [rng.choice(codes.words, 300) for _ in range(2)]
        sent += lm._send(2, columns, rng.integers(1, 4, 300), rng.integers(1, 9, 300), heavy, codes, 0)
    out = []
    for name, rows in (("whole", 1 << 30), ("turns", 200)):
        monkeypatch.setattr(lm, "MERGE_ROWS", rows)
        (tmp_path / name).mkdir()
        made = pa.Table.from_batches(lm._merge_task(2, str(tmp_path / name), heavy, codes, 0)(iter(sent))).to_pylist()
        grams = [(r["level"], lm.unpack(r["payload"], codes)) for r in made if r["payload"]]
        sums = [r for r in made if not r["payload"]]
        out.append(([(k, sorted(zip(*(c.tolist() for c in g[0]), g[1].tolist(), g[2].tolist()))) for k, g in grams], sums,
                    {f.name: f.read_bytes() for f in (tmp_path / name).iterdir()}))
    assert out[0] == out[1] and len(out[0][2]) == 9


def test_words_are_found_among_those_that_share_leading_bits():
    rng = np.random.default_rng(11)
    near = (np.uint64(7) << np.uint64(44)) + np.arange(9, dtype=np.uint64)  # one place in the index
    words_ = np.unique(np.concatenate((near, rng.integers(0, (1 << 64) - 1, 3000, np.uint64, True), [np.uint64(0), np.uint64((1 << 64) - 1)])))
    rng.shuffle(words_)
    held, asked = words_[:2000], np.concatenate((words_, near + np.uint64(9)))
    for table in (held, held[:0]):
        code = {w: i for i, w in enumerate(table.tolist())}
        assert lm.Codes(table).of(asked).tolist() == [code.get(w, lm.CODES) for w in asked.tolist()]
        assert lm._is_in(asked, np.sort(table)).tolist() == [w in code for w in asked.tolist()]


def test_freed_shuffles_are_a_matter_of_one_write(spark):
    docs = spark.range(100).repartition(3)
    for value in (None, "false", "true"):
        if value:
            spark.conf.set(shared.FREE_SHUFFLES, value)
        try:
            before = spark.conf.get(shared.FREE_SHUFFLES, None)
            assert sorted(r.id for r in shared.stage(docs, "freed", free=True).collect()) == list(range(100))
            with pytest.raises(Exception, match="mended"):
                shared.stage(docs.select(F.raise_error(F.lit("mended"))), "failed", free=True)
            assert spark.conf.get(shared.FREE_SHUFFLES, None) == before
        finally:
            spark.conf.unset(shared.FREE_SHUFFLES)


def test_sending_leaves_its_columns_as_they_are():
    rng = np.random.default_rng(4)
    codes = lm.Codes(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    for k, bits in ((1, 0), (1, 3), (2, 3), (3, 0)):
        columns, count = [rng.choice(codes.words, 2000) for _ in range(k)], rng.integers(1, 9, 2000)
        kept = [c.copy() for c in columns]
        sent = [lm.unpack(b.column(2)[0].as_py(), codes) for b in lm._send(k, columns, count, count, np.empty(0, np.uint64), codes, bits)]
        assert all(np.array_equal(a, b) for a, b in zip(columns, kept))
        assert sorted(np.concatenate([s[0][0] for s in sent]).tolist()) == sorted(kept[0].tolist())


def test_counting_takes_few_bytes_for_a_token():
    rng = np.random.default_rng(6)
    texts = [" ".join(map(str, rng.integers(0, 50_000, 1000))) for _ in range(2000)]
    codes = lm.Codes(np.append(lm.BOS, rng.integers(0, 1 << 63, 1000, dtype=np.uint64)))
    tracemalloc.start()
    for _ in lm._count_task(3, np.array([lm.BOS]), codes, 4)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 130 * 2_002_000  # 158 with whole arrays of all that comes in between


def test_model_without_training_texts(spark):
    got = lm.score_held_out(frame(spark, [])).collect()
    assert got == []
    model = lm.train(frame(spark, []))
    r = lm.score(frame(spark, [(1, "a b")]), model).first()
    assert (r.n_tokens, r.n_known, r.score) == (3, 0, 0.0)


# ---- near-duplicates ------------------------------------------------------------------------------

def copies():
    """A group of near copies that only chain together, exact copies, shared passages, and hard texts."""
    rng = random.Random(5)

    def text(n):
        return [f"{rng.choice('abcdef')}{rng.randrange(4000)}" for _ in range(n)]

    rows, base = [], text(120)
    for i in range(60):  # each differs from the one before in one word: the ends are unlike
        rows.append((200 + i, " ".join(base)))
        base = base.copy()
        base[rng.randrange(120)] = f"new{i}"
    passage = text(60)
    rows += [(400 + i, " ".join([*text(60), *passage])) for i in range(30)]
    rows += [(500 + i, "an exact copy of a text with some words") for i in range(40)]
    rows += [(600 + i, "An Exact copy of a\ntext with SOME words") for i in range(3)]
    rows += [(700 + i, " ".join(text(n))) for i, n in enumerate((1, 2, 3, 4, 5, 30, 300))]
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_groups_equal_those_of_all_pairs(spark, k):
    rows = hard(copies())
    got = minhash.near_duplicates(frame(spark, rows), shingle=k).collect()
    want = near_components(rows, k, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_one_document_of_each_group_stays(spark):
    rows = hard(copies())
    kept = minhash.keep_one(frame(spark, rows), shingle=5)
    want = near_components(rows, 5, 80)
    assert kept.columns == frame(spark, rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if i == c) and ids.count(None) == 2


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    rng = random.Random(11)

    def text():
        return [f"s{rng.randrange(10 ** 6)}" for _ in range(120)]

    x, y, z, v = text(), text(), text(), text()
    near = " ".join([*z[:-1], "other"])
    x, y, z, v = (" ".join(t) for t in (x, y, z, v))
    clean = [(7, " ".join(text())) for _ in range(40)]
    rows = [(5, x), (5, y), (13, near), (15, z), (15, v), *clean, *clean[:3], (None, x), (None, y), (20, ""), (20, None), (20, "one"), (21, v)]
    got = sorted((r.doc_id or -1, r.text or "") for r in minhash.keep_one(frame(spark, rows)).collect())
    assert got == sorted([(5, x), (5, y), (13, near), (15, v), *clean, (-1, x), (-1, y), (20, ""), (20, "one")])
    found = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect() if r.doc_id in (5, 13, 15, 21))
    assert found == [(5, 5, True), (5, 5, True), (13, 13, True), (15, 13, False), (15, 15, True), (21, 15, False)]


def test_shared_ids_lose_no_link(spark):
    """The groups of hard texts stay the same when unlike texts come under shared ids."""
    rows = copies()
    got = minhash.keep_one(frame(spark, [(i % 7, t) for i, t in rows]), shingle=4).collect()
    alone = {i: c for i, (_, c) in near_components(rows, 4, 80).items()}
    first: dict = {}
    for i, t in rows:
        first.setdefault(alone[i], set()).add((i % 7, t))
    assert len(got) == len(first) and all(len(members & {(r.doc_id, r.text) for r in got}) == 1 for members in first.values())


def test_pairs_at_the_threshold_are_hardly_missed():
    """At similarity 0.8, as few as with the 32 bands of 4 and the check at 70 of 128 of the first form."""
    hashes, bands = minhash.HASHES, minhash.BANDS
    least = int(hashes * 0.8 - minhash.DEVIATIONS * (hashes * 0.16) ** 0.5)
    rejected = sum(math.comb(hashes, i) * 0.8 ** i * 0.2 ** (hashes - i) for i in range(least))
    assert hashes % bands == 0 and (1 - 0.8 ** (hashes // bands)) ** bands + rejected < 4.8e-8


def test_blocks_of_open_buckets_lose_no_link(spark, monkeypatch):
    """Without any hub's help, blocks alone must find all links."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = copies()
    got = minhash.near_duplicates(frame(spark, rows), shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_components(rows, 4, 80)


def test_no_documents_have_no_groups(spark):
    assert minhash.near_duplicates(frame(spark, [])).collect() == []
    assert minhash.keep_one(frame(spark, [(1, ""), (2, "")])).count() == 2


def test_star_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (1, 50), (50, 2), (2, 9), (9, 1)] + [(1000, 1000 + rng.randrange(1, 80)) for _ in range(90)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in (1, 2, 9, 50)}, **{n: 1000 for e in edges if e[0] == 1000 for n in e}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- quality classifier -----------------------------------------------------------------------------

def test_trees_walk_as_grown():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    t = quality.grow(x, y, trees=40)
    assert ((t.score(x) > 0.5) == (y == 1)).mean() > 0.9
    slow = []
    for row in x[:50]:
        total = t.bias
        for f, c, v in zip(t.feature, t.threshold, t.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += v[node - len(f)]
        slow.append(1 / (1 + np.exp(-total)))
    assert np.allclose(slow, t.score(x[:50]))
    assert quality.grow(x, np.ones(3000)).score(x[:2]).tolist() == [3001 / 3002] * 2


def test_statistics_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = [t or "" for t in HARD_TEXTS]
    whole = np.concatenate([quality.statistics(b, o) for _, _, b, o in textnum.chunks(pa.array(texts))])
    alone = np.concatenate([quality.statistics(b, o) for _, _, b, o in textnum.chunks(pa.array(texts), 1)])
    assert np.allclose(whole, alone) and np.isfinite(whole).all()


def test_classifier_separates_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    # the held-out rows' labels play no part
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score(docs, quality.train(docs, flipped))
    assert sorted((r.doc_id, r.score) for r in again.collect()) == sorted((r.doc_id, r.score) for r in quality.score(docs, quality.train(docs, labels)).collect())


def test_classifier_on_hard_rows(spark):
    labels = spark.createDataFrame([(5, 1), (5, 1), (6, 1), (6, 0), (7, None), (None, 1), (17, 0), (900, 0)], "doc_id long, quality int")
    docs = frame(spark, hard())
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(hard()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    none = quality.train(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(frame(spark, []), none).collect() == []


def test_documents_keep_any_column_type(spark):
    docs = frame(spark, hard()).withColumn("extra", F.array(F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))))
    kept = quality.filter_documents(docs, spark.createDataFrame([(5, 1)], "doc_id long, quality int"))
    assert kept.schema["extra"].dataType.simpleString() == docs.schema["extra"].dataType.simpleString()
    assert json.loads(docs.select(F.to_json(F.struct("extra"))).first()[0])["extra"][0]["a"] == 1
