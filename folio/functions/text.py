"""Column functions for text: splitting into units, windows, pieces; sanitisers.

All of these are JVM expressions (``split``, ``transform``, ``slice``, ``array_join``,
``regexp_replace``): one document's pieces stay in one row until the caller explodes
them, so chunking never shuffles.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiters per split mode.
DELIMITERS = {"word": " ", "sentence": ".", "passage": "\n\n"}

# Characters Python's str.isspace() accepts; Java's (?U)\s lacks U+001C..U+001F.
_SPACE_CLASS = "\\s\\x{1C}-\\x{1F}"
NON_BLANK = f"(?U)[^{_SPACE_CLASS}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable.

    Spark does not share common subexpressions inside lambdas: an array column that a
    lambda body mentions is recomputed for every element. Binding it through a
    one-element ``transform`` computes it once per row.
    """
    return F.transform(F.array(value), fn).getItem(0)


def runs_by_size(sizes: list[int], most: int):
    """(from, to) of consecutive runs whose sizes sum to ``most`` at most; what is larger is a run by itself."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def split_units(text, split_by: str = "word") -> Column:
    """Split at the delimiter and glue it back onto every unit but the last."""
    if split_by not in DELIMITERS:
        raise ValueError(f"split_by must be one of {sorted(DELIMITERS)}, got {split_by!r}")
    delim = DELIMITERS[split_by]
    return let(F.split(_col(text), re.escape(delim), -1), lambda parts: F.transform(
        parts, lambda u, i: F.when(i < F.size(parts) - 1, F.concat(u, F.lit(delim))).otherwise(u)))


def window_count(n_units: Column, split_length: int, split_overlap: int) -> Column:
    step = split_length - split_overlap
    return F.when(n_units <= split_length, F.lit(1)).otherwise(
        1 + F.ceil((n_units - split_length) / F.lit(step)).cast("int"))


def window_units(units, split_length: int, split_overlap: int) -> Column:
    """Sliding windows of ``split_length`` units, step ``length - overlap``; ragged last.

    Empty windows (only possible from a trailing empty unit) are dropped.
    """
    step = split_length - split_overlap
    if split_length < 1 or step < 1 or split_overlap < 0:
        raise ValueError("need split_length >= 1, 0 <= split_overlap < split_length")
    def body(us):
        k = window_count(F.size(us), split_length, split_overlap)
        wins = F.transform(
            F.sequence(F.lit(0), k - 1),
            lambda w: F.array_join(F.slice(us, w * step + 1, F.lit(split_length)), ""))
        return F.filter(wins, lambda s: F.length(s) > 0)
    return let(_col(units), body)


def split_long_text(pieces, max_character_length: int | None) -> Column:
    """Cut every piece longer than ``max_character_length`` into equal-size parts."""
    pieces = _col(pieces)
    if not max_character_length:
        return pieces
    m = int(max_character_length)
    return F.flatten(F.transform(pieces, lambda s: F.when(
        F.length(s) > m,
        F.transform(F.sequence(F.lit(0), F.ceil(F.length(s) / F.lit(m)).cast("int") - 1),
                    lambda j: s.substr(j * m + 1, F.lit(m))),
    ).otherwise(F.array(s))))


def sentence_window(pieces, window_size: int) -> Column:
    """For piece i: the concatenation of pieces i-w .. i+w (clipped)."""
    w = int(window_size)
    return let(_col(pieces), lambda ps: F.transform(ps, lambda p, i: F.array_join(
        F.slice(ps, F.greatest(i - w, F.lit(0)) + 1,
                F.least(i + 1 + w, F.size(ps)) - F.greatest(i - w, F.lit(0))), "")))


def split_windows(text, split_by: str, split_length: int, split_overlap: int) -> Column:
    """``window_units(split_units(text))`` in one pass: each window is the delimiter-join
    of its raw parts plus a trailing delimiter unless it ends at the last part. Saves a
    per-unit array rewrite (the glue step) on every word of every document."""
    if split_by not in DELIMITERS:
        raise ValueError(f"split_by must be one of {sorted(DELIMITERS)}, got {split_by!r}")
    step = split_length - split_overlap
    if split_length < 1 or step < 1 or split_overlap < 0:
        raise ValueError("need split_length >= 1, 0 <= split_overlap < split_length")
    delim = DELIMITERS[split_by]

    def body(parts):
        n_parts = F.size(parts)
        k = window_count(n_parts, split_length, split_overlap)
        wins = F.transform(F.sequence(F.lit(0), k - 1), lambda w: F.concat(
            F.array_join(F.slice(parts, w * step + 1, F.lit(split_length)), delim),
            F.when(w * step + split_length < n_parts, F.lit(delim)).otherwise(F.lit(""))))
        return F.filter(wins, lambda s: F.length(s) > 0)
    return let(F.split(_col(text), re.escape(delim), -1), body)


def chunk_text(text, split_by="word", split_length=60, split_overlap=10,
               max_character_length=450) -> Column:
    """Units -> windows -> long-text cut: the array of pieces of one text."""
    return split_long_text(split_windows(text, split_by, split_length, split_overlap), max_character_length)


def is_blank(c) -> Column:
    return ~_col(c).rlike(NON_BLANK)


def ascii_sanitize(c) -> Column:
    """Every non-ASCII character becomes ``?``."""
    return F.regexp_replace(_col(c), "[^\\x{00}-\\x{7F}]", "?")


def clean_filename(c) -> Column:
    """strip, spaces -> ``_``, keep only ``-``, word characters and ``.``; ``""``/``.``/``..`` -> null."""
    stripped = F.regexp_replace(_col(c), f"^(?U)[{_SPACE_CLASS}]+|(?U)[{_SPACE_CLASS}]+$", "")
    s = F.regexp_replace(F.regexp_replace(stripped, " ", "_"), "[^-\\p{L}\\p{N}_.]", "")
    return F.when(s.isin("", ".", ".."), F.lit(None).cast("string")).otherwise(s)


def sanitize_metric_name(c) -> Column:
    """space -> ``_``, drop anything but ASCII word characters, cut at 63."""
    s = F.regexp_replace(F.regexp_replace(_col(c), " ", "_"), "[^A-Za-z0-9_]", "")
    return F.substring(s, 1, 63)
