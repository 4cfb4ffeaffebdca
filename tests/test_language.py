"""Languages by trigram profiles, and encodings of files."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folio.functions.charset import decode_text, detect_charset
from folio.operators import chunk, language
from folio.sources import files


def grams(text):
    t = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
    return [t[i:i + 3] for i in range(len(t) - 2)]


def test_profiles_are_plain_counts(spark):
    rows = [("en", "The cat, the hat!"), ("en", "x"), ("de", "Über den Fluß 😀"), (None, "no label"), ("fr", None), ("de", "")]
    got = language.learn_profiles(spark.createDataFrame(rows, "lang string, text string").repartition(3), grams=10_000).collect()
    want = {lang: Counter(g for own, t in rows if own == lang and t is not None for g in grams(t)) for lang in ("en", "de")}
    key = lambda g: (ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2])
    assert {(r.language, r.gram): (r.n, r.total) for r in got} == {(lang, key(g)): (n, c.total()) for lang, c in want.items() for g, n in c.items()}


def test_profiles_beat_the_vote_on_held_out_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    fn = language.detector(language.learn_profiles(d.where(F.col("doc_id") % 4 != 0)))
    out = d.where((F.col("doc_id") % 4 == 0) & (F.length("text") > 40))
    out = chunk.detect_language(chunk.detect_language(out, "text", fn=fn, out_col="profile"), "text", out_col="vote").collect()
    assert len(out) > 150
    right = {c: sum(r[c] == r.lang for r in out) / len(out) for c in ("profile", "vote")}
    assert right["profile"] >= 0.97 and right["profile"] >= right["vote"], right
    for lang in {r.lang for r in out}:
        own = [r for r in out if r.lang == lang]
        assert sum(r.profile == lang for r in own) >= 0.9 * len(own), lang


def test_unknown_without_evidence(spark):
    rows = [("en", "the cat and the dog in the house " * 20), ("de", "der Hund und die Katze in dem Haus " * 20)]
    fn = language.detector(language.learn_profiles(spark.createDataFrame(rows, "lang string, text string")))
    texts = spark.createDataFrame([("the dog",), ("die Katze",), ("",), (None,), ("12345 !!",), ("日本語の文章です",)], "text string")
    got = [r.language for r in chunk.detect_language(texts, "text", fn=fn).collect()]
    assert got[:6] == ["en", "de", "unknown", "unknown", "unknown", "unknown"]
    nothing = language.detector(language.learn_profiles(spark.createDataFrame([], "lang string, text string")))
    assert nothing(texts.toPandas()["text"]).tolist() == ["unknown"] * 6


RUSSIAN = "Съешь же ещё этих мягких французских булок, да выпей чаю. Мы пошли по дороге и увидели большой дом. "
FRENCH = "Voilà un café où l’été dure; déjà vu à la fenêtre, naïf garçon. "
SAMPLES = [
    ("plain ascii text\n", "utf-8"), ("naïve café 漢字 😀 ", "utf-8"), ("with a mark é ", "utf-8-sig"), ("UTF-16 text with é ", "utf-16"), ("no mark, still UTF-16 ", "utf-16-le"),
    ("no mark, big end ", "utf-16-be"), ("thirty-two bits ", "utf-32"), ("thirty-two, no mark ", "utf-32-le"), ("déjà vu, fenêtre, garçon, été ", "latin-1"), (FRENCH, "cp1252"),
    (RUSSIAN, "cp1251"), (RUSSIAN, "koi8_r"), (RUSSIAN, "cp866"), (RUSSIAN, "iso8859_5"),
    ("我们的祖国是花园，花园里花朵真鲜艳。中国人民站起来了。", "gb18030"), ("我們的學校在山上，學生們每天都走路去上學。", "big5"),
    ("吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。", "shift_jis"), ("吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。", "euc_jp"),
    ("우리는 학교에 갑니다. 나라의 말이 중국과 달라 서로 통하지 아니한다.", "euc_kr"),
]


@pytest.mark.parametrize("text, charset", SAMPLES, ids=[c + str(i) for i, (_, c) in enumerate(SAMPLES)])
@pytest.mark.parametrize("times", [1, 3, 3000])
def test_encodings(text, charset, times):
    data = (text * times).encode(charset)
    assert decode_text(data) == text * times, detect_charset(data)


def test_heads_may_cut_a_character(spark):
    data = ("a" + "é" * 40_000).encode()
    assert decode_text(data) == "a" + "é" * 40_000
    assert decode_text(b"") == "" and decode_text(None) is None
    rows = [(t.encode(c), "txt") for t, c in SAMPLES] + [(b"\x89PNG", "png"), (None, "txt"), (b"", "md")]
    got = files.encode_content(spark.createDataFrame(rows, "raw binary, document_type string")).collect()
    assert [r.content for r in got] == [t for t, _ in SAMPLES] + ["iVBORw==", None, ""]
    assert files.encode_content(spark.createDataFrame([("é".encode("latin-1"), "md")], "raw binary, document_type string"), charset="ISO-8859-1").first().content == "é"


def test_trigrams_do_not_cross_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab .é😀", k=rng.randrange(0, 9))) for _ in range(50)] + [None]
    flat, size = language.trigrams(texts)
    names = ["".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in flat.tolist()]
    at = 0
    for t, n in zip(texts, size.tolist()):
        assert names[at:at + n] == grams(t) or (n == 0 and not math.isnan(n) and grams(t) == [])
        at += n
