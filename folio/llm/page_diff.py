"""Main text of web pages: markup, and the differences to the pages nearest by URL on the same host.

The lines of a page are its text blocks. Pages stand in the order of host and URL path, and each is
paired with its nearest neighbours in that order on its host, NEAR on either side. A pair's lines
are aligned by their longest common subsequence, and lines that a page shares with the pages around
it are deleted: menus, notices and footers without any telling markup.

* A neighbour that would leave less than a tenth of a page is a copy of it and says nothing; the
  next one is taken, of REACH on either side.
* Where the page marks no article, a line goes that most of its neighbours share; a passage that one
  other page quotes stays. Inside an explicit article a line is text unless all neighbours, three at
  least, share it: copies and quotations of articles are whole.
* Blocks that markup calls something else (``html_blocks``) go in any case, and align with others.

Neighbours need nothing but hashes and sizes of lines: pages get their places by ranges of the
order (no host meets in one task), blocks of places with REACH rows around them are compared by
themselves, and pages meet what is to be deleted by a join on host, path and lines. Texts are
read a second time instead of being kept.

Defined cases: null html is empty; a page without main text has '' and 0 characters; pages without
a host, or alone on it, go by their markup only; repeated pages get the same text; very long pages
are read whole (subsequences of any length need memory in proportion to a page's lines); an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.html_blocks import ARTICLE, blocks, candidates
from folio.llm.shared import numbered, stage

NEAR = 2        # neighbours on either side
REACH = 8       # pages on either side among which they are sought
BLOCK = 1024    # places that are compared in one group
COPY = 10       # a neighbour that leaves less than one COPY-th of a page's text is a copy
_SLICE = 256
_BITS = 1 << 28
THIN = "host string, path string, at long, signature long, hashes array<long>, sizes array<int>, kinds array<int>"
TEXTS = "row_id long, row_url string, at long, signature long, places array<int>, lines array<string>"
_DROPPED, _OPEN, _ARTICLE = 0, 1, 2


def longest_common(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, ascending."""
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < min(end_a, end_b) and a[lo] == b[lo]:
        lo += 1
    while min(end_a, end_b) > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    out = list(range(lo))
    both = set(a[lo:end_a]).intersection(b[lo:end_b])
    if both:
        at = [i for i in range(lo, end_a) if a[i] in both]
        out += [at[i] for i in _common([a[i] for i in at], [x for x in b[lo:end_b] if x in both])]
    return out + list(range(end_a, len(a)))


def _columns(a: list, b: list) -> Iterator[int]:
    """After each item of ``a``: a bit per item of ``b``, clear where the subsequence with that prefix grows."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    whole = row = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & whole
        yield row


def _lengths(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and each prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _columns(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _common(a: list, b: list) -> list[int]:
    if len(a) * len(b) > _BITS and len(a) > 1:  # halves of a, and b where both together are longest
        mid = len(a) // 2
        cut = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
        return _common(a[:mid], b[:cut]) + [mid + i for i in _common(a[mid:], b[cut:])]
    rows, out, i, j = list(_columns(a, b)), [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append(i)
            i, j = i - 1, j - 1
    return out[::-1]


def place_of(url: str | None) -> tuple[str | None, str]:
    """Host and path of a URL; no host where it has none. Slashes come first among characters, so
    that a folder's pages stand together."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return None, ""
    return host or None, parts.path.strip("/").replace("/", "\x01")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _page(url: str | None, html: str | None):
    found = blocks(html or "")
    host, path = place_of(url)
    left = candidates(found)
    kept = set(left)
    hashes = [_hash(b.text) for b in found]
    kinds = [(_ARTICLE if b.place == ARTICLE else _OPEN) if i in kept else _DROPPED for i, b in enumerate(found)]
    at = _hash(f"{host or ''}\0{path}")
    signature = xxhash.xxh64_intdigest(np.array([*hashes, *kinds], np.int64).tobytes()) - (1 << 63)
    return found, left, host, path, at, signature, hashes, kinds


def _thin_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in THIN.split(", ")]
    kinds_of = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    for batch in batches:
        for lo in range(0, batch.num_rows, _SLICE):
            rows = batch.slice(lo, _SLICE)
            out = []
            for url, html in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                found, _, host, path, at, signature, hashes, kinds = _page(url, html)
                if host is not None and found:
                    out.append((host, path, at, signature, hashes, [len(b.text) for b in found], kinds))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds_of)], names=names)


def _text_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in TEXTS.split(", ")]
    for batch in batches:
        for lo in range(0, batch.num_rows, _SLICE):
            rows = batch.slice(lo, _SLICE)
            out = []
            for url, html in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                found, left, _, _, at, signature, _, _ = _page(url, html)
                out.append((at, signature, left, [found[i].text for i in left]))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32())),
                pa.array(cols[3], pa.list_(pa.string()))], names=names)


def shared_lines(page: tuple, others: Iterator[tuple], near: int) -> tuple[int, np.ndarray]:
    """How many of the first ``near`` pages that are no copies there are, and how many of them share each line."""
    hashes, sizes, kinds = page
    text = int(sizes[kinds != _DROPPED].sum())
    used, count = 0, np.zeros(len(hashes), np.int64)
    for other in others:
        if used == near:
            break
        shared = np.zeros(len(hashes), bool)
        shared[longest_common(hashes.tolist(), other[0].tolist())] = True
        if COPY * int(sizes[(kinds != _DROPPED) & ~shared].sum()) >= text > 0:
            used += 1
            count += shared
    return used, count


def _deleted(rows: pd.DataFrame) -> pd.DataFrame:
    """What to delete of each page of a block; ``block`` is the block of a row, ``own`` that of its place."""
    rows = rows.sort_values("pos")
    hosts, paths = rows["host"].tolist(), rows["path"].tolist()
    pages = list(zip([np.asarray(h, np.int64) for h in rows["hashes"]], [np.asarray(s, np.int64) for s in rows["sizes"]], [np.asarray(k, np.int64) for k in rows["kinds"]]))
    keys = list(zip(rows["at"].tolist(), rows["signature"].tolist()))
    out = []
    for i, own in enumerate((rows["own"] == rows["block"]).tolist()):
        if not own:
            continue
        kinds = pages[i][2]
        if not (kinds != _DROPPED).any():
            continue

        def side(step: int, i: int = i) -> Iterator[tuple]:
            for k in range(i + step, i + step * (REACH + 1), step):
                if not 0 <= k < len(pages) or hosts[k] != hosts[i]:
                    return
                yield pages[k]

        used, count = 0, np.zeros(len(kinds), np.int64)
        for step in (-1, 1):
            more, shared = shared_lines(pages[i], side(step), NEAR)
            used, count = used + more, count + shared
        if not used:
            continue
        gone = (kinds == _OPEN) & (2 * count > used) | (kinds == _ARTICLE) & (count == used) & (used >= 3)
        if gone.any():
            out.append((*keys[i], np.flatnonzero(gone).tolist()))
    return pd.DataFrame(out, columns=["at", "signature", "gone"])


def deleted_lines(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(at, signature, gone): pages that share lines with their neighbours, and the places of these lines."""
    texts = pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    names = [c.split()[0] for c in THIN.split(", ")]
    first = [F.first(c).alias(c) for c in names if c not in ("at", "signature")]
    thin = stage(texts.mapInArrow(_thin_task, THIN).groupBy("at", "signature").agg(*first).withColumn("key", F.lit("")), "page-lines")
    order = [F.col("host"), F.col("path"), F.col("at"), F.col("signature")]
    placed = numbered(thin, "key", order, "page-places").withColumn("own", F.expr(f"pos div {BLOCK}"))
    within = F.col("pos") % BLOCK
    around = F.array_compact(F.array(F.col("own"), F.when(within < REACH, F.col("own") - 1), F.when(within >= BLOCK - REACH, F.col("own") + 1)))
    dealt = placed.withColumn("block", F.explode(around)).select("block", "own", "pos", *names)
    return dealt.groupBy("block").applyInPandas(_deleted, "at long, signature long, gone array<int>")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, lines) of every page: the blocks of its main text, in page order."""
    gone = stage(deleted_lines(pages, url_col, html_col), "page-shared-lines")
    gone = gone.select(F.col("at").alias("g_at"), F.col("signature").alias("g_signature"), "gone")
    thin = pages.select(F.col(id_col).cast("long").alias("row_id"), F.col(url_col).cast("string").alias("row_url"), F.col(html_col).cast("string").alias("html"))
    texts = thin.mapInArrow(_text_task, TEXTS)
    both = texts.join(gone, (F.col("at") == F.col("g_at")) & (F.col("signature") == F.col("g_signature")), "left")
    left = F.filter("lines", lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), F.element_at("places", i + 1)))
    return both.select(F.col("row_id").alias(id_col), F.col("row_url").alias(url_col), left.alias("lines"))
