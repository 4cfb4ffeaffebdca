"""Text chunking and per-document text measures.

``split_documents`` is one narrow projection plus one ``explode``: a document's pieces
are built as an array inside its own row, so the operator never shuffles and scales with
the number of executors. Very long documents only cost memory in their own task; put a
``repartition`` *before* it when document sizes are skewed, never after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import NON_BLANK, chunk_text, let, sentence_window
from folio.operators.metadata import new_uuid

SPLIT_DEFAULTS = dict(split_by="word", split_length=60, split_overlap=10,
                      max_character_length=450, sentence_window_size=0)


def validate_split_params(split_by, split_length, split_overlap, max_character_length,
                          sentence_window_size) -> None:
    if split_by not in ("word", "sentence", "passage"):
        raise ValueError(f"split_by must be word, sentence or passage, got {split_by!r}")
    if split_length is None or split_length <= 0:
        raise ValueError("split_length must be > 0")
    if split_overlap is None or split_overlap < 0:
        raise ValueError("split_overlap must be >= 0")
    if split_overlap >= split_length:
        raise ValueError("split_overlap must be < split_length")
    if sentence_window_size and sentence_window_size < 0:
        raise ValueError("sentence_window_size must be >= 0")
    if sentence_window_size and sentence_window_size > 0 and split_by != "sentence":
        raise ValueError("sentence_window_size > 0 needs split_by='sentence'")
    if max_character_length is not None and max_character_length < 0:
        raise ValueError("max_character_length must be >= 0")


def split_documents(df: DataFrame, split_by: str = "word", split_length: int = 60,
                    split_overlap: int = 10, max_character_length: int | None = 450,
                    sentence_window_size: int = 0, _validate: bool = True) -> DataFrame:
    """Split ``text`` elements into pieces; other rows pass unchanged.

    Each piece becomes a text element with ``metadata.content`` = piece (plus
    ``window``/``original_text`` when ``sentence_window_size`` > 0), a fresh
    deterministic ``uuid`` and ``piece`` = its index (rows order by ``pos, piece``).
    The document's own text isn't copied beside its pieces: a raw ``content`` column is null there.
    Whitespace-only pieces are skipped but still count as window neighbours. A text
    row with null content becomes an error row (the reference fails the job).
    """
    if _validate:
        validate_split_params(split_by, split_length, split_overlap, max_character_length,
                              sentence_window_size)
    content = F.col("metadata.content")
    is_text = F.coalesce(F.col("document_type") == "text", F.lit(False)) & content.isNotNull()
    # what is copied to every piece: the row without the document's own text
    md = F.col("metadata")
    bare = {"metadata": F.when(is_text, md.withField("content", F.lit(None).cast("string"))).otherwise(md)}
    if "content" in df.columns:
        bare["content"] = F.when(~is_text, F.col("content"))
    null_text = F.coalesce(F.col("document_type") == "text", F.lit(False)) & content.isNull()
    lean = df.select(*[bare[c].alias(c) if c in bare else F.col(c) for c in df.columns], is_text.alias("_split"), null_text.alias("_null"),
                     F.when(is_text, content).alias("_text"))
    # the splitting stands inside the explode: of a column below it, the optimizer would infer
    # filters on its size, and split every document again for each of these
    pieces = chunk_text(F.col("_text"), split_by, split_length, split_overlap, max_character_length)
    w = int(sentence_window_size or 0)
    if w > 0:
        items = let(pieces, lambda ps: F.arrays_zip(ps.alias("p"), sentence_window(ps, w).alias("w")))
    else:
        items = F.transform(pieces, lambda p: F.struct(p.alias("p"), F.lit(None).cast("string").alias("w")))
    passthrough = F.array(F.struct(F.lit(None).cast("string").alias("p"), F.lit(None).cast("string").alias("w")))
    exploded = lean.select(*df.columns, "_split", "_null", F.posexplode(F.when(F.col("_split"), items).otherwise(passthrough)).alias("piece", "_it"))
    is_text = F.col("_split")
    keep_row = ~is_text | F.col("_it.p").rlike(NON_BLANK)
    new_md = md.withField("content", F.col("_it.p"))
    if w > 0:
        new_md = new_md.withField("window", F.col("_it.w")).withField("original_text", F.col("_it.p"))
    uuid_cols = [F.col(c) for c in ("job_id", "pos") if c in df.columns] + [F.col("piece")]
    out = (exploded.where(keep_row)
           .withColumn("metadata", F.when(is_text, new_md).otherwise(md))
           .withColumn("uuid", F.when(is_text, new_uuid(*uuid_cols)).otherwise(F.col("uuid")) if "uuid" in df.columns
                       else new_uuid(*uuid_cols))
           .withColumn("piece", F.when(is_text, F.col("piece")).otherwise(F.lit(None)).cast("int"))
           .drop("_it", "_split"))
    from folio.operators.metadata import tag_error  # local import: avoid cycle at module load
    return tag_error(out, F.col("_null"), "DocumentSplitter needs text content; got null", task="split").drop("_null")


def count_words(text) -> Column:
    """Python ``len(s.split())``: runs of Unicode whitespace separate words."""
    t = F.col(text) if isinstance(text, str) else text
    return F.size(F.filter(F.split(t, "(?U)[\\s\\x{1C}-\\x{1F}]+", -1), lambda x: x != ""))


def estimate_pages(df: DataFrame, type_col: str = "document_type", text_col: str = "content",
                   pages_col: str = "n_pages", paragraphs_col: str = "n_paragraphs",
                   slides_col: str = "n_slides") -> DataFrame:
    """Page estimate per document: text/md/html = round-half-even(words / 300);
    docx = paragraphs // 15; pptx = slides; pdf = pages; images = 1; else 0."""
    t = F.lower(F.col(type_col))

    def opt(c):
        return F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0)

    est = (F.when(t.isin("txt", "text", "md", "html"), F.bround(count_words(F.col(text_col)) / 300.0, 0))
           .when(t == "docx", F.floor(opt(paragraphs_col) / 15))
           .when(t == "pptx", opt(slides_col))
           .when(t == "pdf", opt(pages_col))
           .when(t.isin("jpeg", "bmp", "png", "svg"), F.lit(1))
           .otherwise(F.lit(0)))
    return df.withColumn("estimated_pages", est.cast("long"))


def explode_extractions(df: DataFrame, list_col: str = "extracted") -> DataFrame:
    """A list of extracted elements per document -> one row each; empty lists vanish."""
    rest = [c for c in df.columns if c != list_col]
    return df.select(*rest, F.posexplode(list_col).alias("piece", "_e")).select(*rest, "piece", "_e.*")


# A few very common words per language, used by the default detector.
STOPWORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "it", "that", "with", "for", "on", "as", "are", "this", "by"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "en", "est", "que", "qui", "pour", "dans"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "mit", "von", "sich", "auf"],
    "es": ["el", "los", "las", "y", "es", "un", "una", "por", "con", "para", "del", "que", "se", "como"],
}


def detect_language(df: DataFrame, text_col: str = "content", fn=None, out_col: str = "language",
                    min_hits: int = 2) -> DataFrame:
    """Language code per row, ``unknown`` when undetectable or not a known code.

    Default: stop-word vote in JVM expressions (lower-cased word array, count of hits per
    language, best with at least ``min_hits``; ties -> alphabetical). ``fn`` may be a
    pandas function ``Series[str] -> Series[str]`` run as a pandas UDF instead.
    """
    from folio.schema import LANGUAGES
    if fn is not None:
        from pyspark.sql.functions import pandas_udf
        udf = pandas_udf(fn, "string")
        code = udf(F.col(text_col))
    else:
        words = F.split(F.lower(F.col(text_col)), "[^\\p{L}]+", -1)
        def hits(ws):
            return F.size(F.filter(words, lambda x: x.isin(*ws)))
        scores = [F.struct(hits(ws).alias("n"), F.lit(lang).alias("lang"))
                  for lang, ws in sorted(STOPWORDS.items())]
        best = F.reduce(F.array(*scores[1:]), scores[0],
                        lambda acc, s: F.when(s["n"] > acc["n"], s).otherwise(acc))
        code = F.when(best["n"] >= min_hits, best["lang"]).otherwise(F.lit("unknown"))
    return df.withColumn(out_col, F.when(code.isin(*LANGUAGES), code).otherwise(F.lit("unknown")))
