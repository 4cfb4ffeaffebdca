"""SQL fragments for the oracle side (DuckDB dialect), written independently of the
Spark operators: the same rules restated in SQL list functions."""

from __future__ import annotations

# Unicode White_Space (as Java's (?U)\s) plus U+001C..U+001F (Python str.isspace).
NON_BLANK_RE2 = ("[^\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                 "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")

_DELIM_SQL = {"word": "' '", "sentence": "'.'", "passage": "(chr(10) || chr(10))"}


def chunk_pieces_sql(source: str, split_by: str, n: int, overlap: int, max_len: int | None,
                     keep: str = "*") -> str:
    """``SELECT <keep>, _pieces`` where ``_pieces`` is the list of pieces of ``content``."""
    d = _DELIM_SQL[split_by]
    step = n - overlap
    cut = (f"flatten(list_transform(_wins, lambda s: CASE WHEN length(s) > {max_len} THEN "
           f"list_transform(generate_series(0, CAST(ceil(length(s) / {max_len}) AS BIGINT) - 1), "
           f"lambda j: substring(s, j * {max_len} + 1, {max_len})) ELSE [s] END))"
           if max_len else "_wins")
    return f"""
      SELECT {keep}, {cut} AS _pieces FROM (
        SELECT *, list_filter(list_transform(
                 generate_series(0, CASE WHEN len(_units) <= {n} THEN 0
                                    ELSE CAST(ceil((len(_units) - {n}) / {step}) AS BIGINT) END),
                 lambda k: array_to_string(list_slice(_units, k * {step} + 1, k * {step} + {n}), '')),
               lambda s: length(s) > 0) AS _wins
        FROM (
          SELECT *, list_transform(_parts, lambda x, i: CASE WHEN i < len(_parts) THEN x || {d} ELSE x END) AS _units
          FROM (SELECT *, string_split(content, {d}) AS _parts FROM ({source}) _s0 WHERE content IS NOT NULL) _s1
        ) _s2
      ) _s3"""
