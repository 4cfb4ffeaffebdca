"""Languages by character trigrams: profiles learned from labelled texts, scored as vectors.

A profile holds, per language, how often the language's most frequent trigrams come. It is learned
from all labelled rows: tasks count the trigrams of their rows with numpy, Spark sums the counts,
and ``GRAMS`` trigrams a language are kept, a table whose size the parameter and the number of
languages bound. A text's score for a language is the mean logarithm of its trigrams' shares there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import runs_by_size

GRAMS = 2000          # trigrams a language keeps
MARGIN = 0.05         # by which the best language must lead, in mean log share
COVERED = 0.3         # share of a text's trigrams that the profiles must know
_FLUSH = 1 << 20
TAKEN = 1 << 18       # bytes or characters of texts whose trigrams are held at a time


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all texts (21 bits a character), and how many each text has. Letters are lower-cased,
    all else is one blank, and a text begins and ends with one."""
    code, ends = [], []
    for t in texts:
        letters = "".join(c if c.isalpha() else " " for c in (t or "").lower())
        code.append(np.frombuffer((" " + " ".join(letters.split()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32))
        ends.append(len(code[-1]))
    flat, size = np.concatenate(code).astype(np.int64), np.array(ends, np.int64)
    gram = flat[:-2] << 42 | flat[1:-1] << 21 | flat[2:]
    last = np.cumsum(size)
    inside = np.ones(len(flat), bool)
    inside[last - 1] = inside[last - 2] = False  # windows do not reach into the next text
    return gram[inside[:len(gram)]], size - 2


def learn_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", grams: int = GRAMS) -> DataFrame:
    """(language, gram, n, total): the most frequent trigrams of each language, with their counts and
    those of all its trigrams. Rows without a language or a text teach nothing."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, pd.Series] = {}
        held: dict[str, list[np.ndarray]] = {}

        def fold(lang: str) -> None:
            gram, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            new = pd.Series(n, index=gram)
            sums[lang] = new if lang not in sums else sums[lang].add(new, fill_value=0).astype(np.int64)

        for batch in batches:
            for lo, hi in runs_by_size(pc.binary_length(batch.column("text")).to_pylist(), TAKEN):
                for lang, texts in batch.slice(lo, hi - lo).to_pandas().groupby("lang")["text"]:
                    gram, _ = trigrams(texts.tolist())
                    held.setdefault(lang, []).append(gram)
                    if sum(map(len, held[lang])) > _FLUSH:
                        fold(lang)
        for lang in list(held):
            fold(lang)
        for lang, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(s), pa.string()), pa.array(s.index.to_numpy(np.int64)), pa.array(s.to_numpy(np.int64))], names=["language", "gram", "n"])

    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(count, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    total = counts.groupBy("language").agg(F.sum("n").alias("total"))
    top = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    return counts.withColumn("_rank", F.row_number().over(top)).where(F.col("_rank") <= grams).drop("_rank").join(total, "language")


def detector(profiles: DataFrame, margin: float = MARGIN, covered: float = COVERED):
    """A pandas function texts -> language codes, for ``detect_language(fn=...)``: ``unknown`` where no
    language leads by ``margin``, or too few trigrams are known. Takes the profiles as they are now."""
    p = profiles.toPandas()  # bounded by the number of languages and of trigrams kept
    languages = sorted(p["language"].unique())
    grams = np.unique(p["gram"].to_numpy(np.int64))
    share = np.zeros((len(grams), len(languages)))
    for j, lang in enumerate(languages):
        own = p[p["language"] == lang]
        n = np.zeros(len(grams))
        n[np.searchsorted(grams, own["gram"].to_numpy(np.int64))] = own["n"].to_numpy(float)
        share[:, j] = np.log((n + 0.5) / (float(own["total"].iloc[0]) + 0.5 * len(grams)))

    def detect(texts: pd.Series) -> pd.Series:
        out = []
        for lo, hi in runs_by_size([len(t) if isinstance(t, str) else 0 for t in texts], TAKEN):
            gram, size = trigrams(texts.iloc[lo:hi].tolist())
            if not len(grams):
                out += ["unknown"] * len(size)
                continue
            at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
            known = grams[at] == gram
            row = np.repeat(np.arange(len(size)), size)[known]
            n = np.bincount(row, minlength=len(size))
            score = np.stack([np.bincount(row, share[at[known], j], len(size)) for j in range(len(languages))], axis=1) / np.maximum(n, 1)[:, None]
            order = np.sort(score, axis=1)
            lead = order[:, -1] - order[:, -2] if len(languages) > 1 else np.full(len(size), np.inf)
            sure = (n > 0) & (n >= covered * size) & (lead >= margin)
            out += [languages[b] if s else "unknown" for b, s in zip(score.argmax(axis=1).tolist(), sure.tolist())]
        return pd.Series(out)

    return detect
