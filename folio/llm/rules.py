"""Quality rules whose thresholds adapt to each language and source. DataFrame functions only.

Each document gets integer measures of its whole text. Quantile sketches of the measures are
kept per (language, source): counts of buckets that hold six leading binary digits, so a
quantile is off by at most a 32nd, and sketches merge by adding counts, in any order and with
the same result. A cell's limits are fences around its quartiles; cells with few documents
take those of their language's merged sketch, or of all documents'. Documents are then joined
with their cell's limits and fail outside them.

Defined cases: null text is empty; a document without words fails the base rules; null
language or source is a value of its own; no rows give no rows; repeated rows are judged one by
one; columns other than the named ones play no part.
Three-word windows are compared by the leading bits of a 64-bit hash, all but as many as number the
document's words (false matches: under 1e-6 in a text of 20,000 words).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import WORD, small_side, stage

# measure: (numerator, factor, denominator, smallest spread, whether a lower fence holds too)
MEASURES = {
    "symbols": ("n_symbols", 1000, "word_chars", 10, False),
    "capitals": ("n_capitals", 1000, "word_chars", 40, False),
    "word_length": ("word_chars", 100, "n_words", 50, True),
    "copied_lines": ("n_dup_lines", 1000, "n_lines", 150, False),
    "repeats": ("n_repeat_words", 1000, "n_words", 100, False),
}
SPREADS = 3          # a fence is this many quartile distances out
LEAST_CELL = 100     # documents that a sketch needs to be relied upon
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def measured(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns and the counts of each text: n_words, word_chars, n_symbols, n_capitals,
    n_lines (with a word), n_dup_lines, n_repeat_words.

    One row at a time, in n log n of its words: a window's key is its hash above its position,
    so that in the sorted keys equal windows stand side by side.
    """
    worded = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t")).select(
        *keep, "_t", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_w"))
    bits = F.length(F.bin(F.size("_w").cast("long")))
    none = F.array().cast("array<bigint>")

    def key(i: Column) -> Column:
        window = F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
        return F.call_function("shiftleft", window, F.col("_b")).bitwiseOR(i.cast("long"))

    keyed = worded.select("*", bits.alias("_b")).select(
        *keep, "_b", F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), F.regexp_count("_t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_l"),
        F.when(F.size("_w") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_w") - 3), key))).otherwise(none).alias("_k"))

    def same(i: Column) -> Column:
        return F.call_function("shiftright", F.get("_k", i).bitwiseXOR(F.get("_k", i - 1)), F.col("_b")) == 0

    paired = keyed.select(
        *keep, "_b", "n_words", "word_chars", "n_symbols", "n_capitals", F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), "_k",
        F.when(F.size("_k") >= 2, F.filter(F.sequence(F.lit(1), F.size("_k") - 1), same)).otherwise(F.array().cast("array<int>")).alias("_i"))

    def place(i: Column) -> Column:
        return F.get("_k", i).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1)

    found = paired.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines",
        F.sort_array(F.array_distinct(F.flatten(F.transform("_i", lambda i: F.array(place(i), place(i - 1)))))).alias("_p"))
    # windows overlap: each adds the words past the one before it, three at most
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("at"))
    covered = F.aggregate("_p", start, lambda a, p: F.struct((a["n"] + F.least(F.lit(3).cast("long"), p - a["at"])).alias("n"), p.alias("at")), lambda a: a["n"])
    return found.select(*keep, "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def measure(name: str) -> Column:
    """An integer measure; 0 where its denominator is."""
    num, factor, den, _, _ = MEASURES[name]
    return F.when(F.col(den) > 0, F.expr(f"{num} * {factor} div {den}")).otherwise(F.lit(0).cast("long"))


def bucket(value: str) -> Column:
    """The least value of a sketch bucket: the value with all but its leading six digits zero."""
    return F.expr(f"CASE WHEN {value} < 64 THEN {value} ELSE shiftleft(shiftright({value}, length(bin({value})) - 6), length(bin({value})) - 6) END")


def sketches(counts: DataFrame) -> DataFrame:
    """Sketches (lang, source, measure, bucket, n) of the documents that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), measure(m).alias("value")) for m in MEASURES]))
    values = counts.where(~base_failed()).select("lang", "source", each.alias("v")).select("lang", "source", "v.measure", "v.value")
    return values.groupBy("lang", "source", "measure", bucket("value").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def fences(cells: DataFrame) -> DataFrame:
    """(lang, source, docs, <measure>_low, <measure>_high) of each cell: limits from its own sketch,
    else its language's, else that of all."""
    def limits(by: list[str]) -> DataFrame:
        merged = cells.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*by, "measure")
        run = merged.select("*", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(w).alias("docs"))
        quartiles = run.groupBy(*by, "measure").agg(F.max("docs").alias("docs"), *[
            F.min(F.when(F.col("upto") * 4 >= F.col("docs") * k, F.col("bucket"))).alias(f"q{k}") for k in (1, 3)])
        rows = F.create_map(*[x for m, v in MEASURES.items() for x in (F.lit(m), F.lit(v[3]))])
        two_sided = F.col("measure").isin([m for m, v in MEASURES.items() if v[4]])
        spread = F.greatest(F.col("q3") - F.col("q1"), rows[F.col("measure")].cast("long")) * SPREADS
        fenced = quartiles.select(*by, "measure", "docs", (F.col("q3") + spread).alias("high"), F.when(two_sided, F.col("q1") - spread).otherwise(F.lit(-1).cast("long")).alias("low"))
        return fenced.groupBy(*by).agg(F.max("docs").alias("docs"), *[
            F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in MEASURES for side in ("low", "high")])

    sides = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    own = limits(["lang", "source"])
    tongue = limits(["lang"]).select(F.col("lang").alias("l_lang"), F.col("docs").alias("l_docs"), *[F.col(c).alias(f"l_{c}") for c in sides])
    every = limits([]).select(*[F.col(c).alias(f"a_{c}") for c in sides])
    joined = own.join(tongue, F.col("lang").eqNullSafe(F.col("l_lang"))).join(F.broadcast(every), F.lit(True))
    return joined.select("lang", "source", "docs", *[
        F.when(F.col("docs") >= LEAST_CELL, F.col(c)).when(F.col("l_docs") >= LEAST_CELL, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in sides])


def judge(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """``counts`` with base_failed, outside (the measures beyond their fences) and kept."""
    sides = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    side = small_side(limits).select(F.col("lang").alias("_f_lang"), F.col("source").alias("_f_source"), *[F.col(c).alias(f"_f_{c}") for c in sides])
    joined = counts.join(side, F.col("lang").eqNullSafe(F.col("_f_lang")) & F.col("source").eqNullSafe(F.col("_f_source")), "left")
    beyond = F.array_compact(F.array(*[F.when((measure(m) > F.col(f"_f_{m}_high")) | (measure(m) < F.col(f"_f_{m}_low")), F.lit(m)) for m in MEASURES]))
    return joined.select(*counts.columns, base_failed().alias("base_failed"), beyond.alias("outside")).select(
        "*", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, outside, kept of every document."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    counts = stage(measured(named, "text", ("doc_id", "lang", "source")), "rules-counts")
    return judge(counts, stage(fences(stage(sketches(counts), "rules-sketches")), "rules-fences"))


def filter_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Texts are measured once and written with their counts; limits come from the counts, and a
    second scan drops what lies outside, so no text is shuffled.
    """
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    counts = stage(measured(whole, "text", ("_row", "lang", "source")), "rules-documents")
    verdicts = judge(counts, stage(fences(stage(sketches(counts), "rules-sketches")), "rules-fences"))
    return verdicts.where("kept").select("_row.*")
