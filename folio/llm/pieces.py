"""SentencePiece BPE encoding with seeded merge-dropout, and its lossless decoding.

Merge types (BPE) models join the best-scored adjacent pair first, the leftmost among equals.
With dropout a candidate merge is skipped when a hash, keyed by seed, document and the
candidate's three boundaries in the text, falls below the dropout rate. A candidate enters the
agenda once, when its two symbols become neighbours, so skipping it is the same as its never
entering, and a text's pieces depend on nothing but seed, key and text.

No piece holds a space mark after another character, so texts fall into chunks that merge
independently. numpy works all chunks of a batch in lockstep: each round joins every chunk's
best live candidate. Chunks beyond LONG symbols have an agenda (a heap) of their own.

Characters outside the vocabulary, and space marks that the text itself holds, become byte
pieces: decoding gives back every text exactly.

Defined cases: null and empty texts have no pieces and decode to the empty text; a null key is a
key like others; no rows give no rows; equal rows get equal pieces; other columns pass through
``encode_documents``' ``keep`` or are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.textnum import mix

U = np.uint64
MARK = "▁"   # stands for a space in pieces (fixed by the model format)
LONG = 192
NEVER = np.int64(np.iinfo(np.int64).max)
_RANK_SHIFT = 32  # a candidate is its rank above its place: the least is the best, leftmost one
_KEYS = tuple(U(k) for k in (0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25))
_KEY_SUM = U(sum(map(int, _KEYS)) % (1 << 64))


class Pieces:
    """Tables of a model, built from the pieces and scores that the library reads from its file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        bytes_ = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(bytes_) != 256:
            raise ValueError(f"{path}: without all 256 byte pieces, texts can't be kept whole")
        if sp.normalize("ﬁ Ａ  x") != MARK + "ﬁ" + MARK + "Ａ" + MARK * 2 + "x":
            raise ValueError(f"{path}: its normaliser changes texts")
        normal = {names[i]: i for i in range(n) if not special[i] and not sp.is_byte(i)}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError(f"{path}: pieces go beyond a space")
        self.n, self.mark = n, normal[MARK]
        self.byte_id = np.array([bytes_[b] for b in range(256)], np.int32)
        symbols = dict(normal)
        for p in normal:
            for c in p:
                symbols.setdefault(c, n + len(symbols) - len(normal))
        self.char = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.char[ord(MARK)] = -1
        self.char[0x20] = self.mark
        scores = np.array([sp.get_score(i) for i in range(n)])
        rank = np.searchsorted(np.unique(-scores), -scores)
        pairs = {(symbols[p[:k]], symbols[p[k:]]): i for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        self._index(pairs, rank)
        raw = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else names[i].replace(MARK, " ").encode() for i in range(n)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(r) for r in raw])
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len

    def _index(self, pairs: dict, rank: np.ndarray) -> None:
        """Open-addressed table of (left, right) -> merged piece."""
        size = 1 << (4 * len(pairs)).bit_length()
        self.mask, self.shift = size - 1, U(64 - size.bit_length() + 1)
        self.key, self.value = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        self.rank = rank.astype(np.int64)
        for (a, b), i in pairs.items():
            k = a << 24 | b
            at = (k * int(_KEYS[0]) % (1 << 64)) >> int(self.shift)
            while self.key[at] >= 0:
                at = (at + 1) & self.mask
            self.key[at], self.value[at] = k, i

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that joins each pair; -1 where none does."""
        k = (a.astype(np.int64) << 24) | b
        at = ((k.view(U) * _KEYS[0]) >> self.shift).astype(np.int64)
        got = self.key[at]
        out = np.where(got == k, self.value[at], -1)
        open_ = np.flatnonzero((got != k) & (got >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            got = self.key[at[open_]]
            hit = got == k[open_]
            out[open_[hit]] = self.value[at[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def encode(pieces: Pieces, texts: list[str], keys: np.ndarray, seed: int = 0, dropout: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the count of each. keys: an int64 per text."""
    below = min(int(dropout * 2.0 ** 64), (1 << 64) - 1)
    size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    code = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), np.uint32)
    n, begin = len(code), np.cumsum(size) - size
    if not n:
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    sym = pieces.char[code]
    key = mix(np.asarray(keys, np.int64).view(U) ^ mix(np.array([seed], np.int64).view(U) + U(1)))

    alone = sym < 0
    head = np.zeros(n, bool)
    head[begin[size > 0]] = True
    head[1:] |= alone[1:] | alone[:-1] | ((sym[1:] == pieces.mark) & (sym[:-1] != pieces.mark))
    first = np.flatnonzero(head)
    stop = np.append(first[1:], n)
    doc = np.repeat(np.arange(len(texts)), size)
    following = np.arange(1, n + 1)  # of a live symbol: where the next one starts
    before = np.arange(-1, n - 1)
    live = np.ones(n, bool)
    # a candidate's hash: seed and document, and its boundaries counted from the document's begin
    hashed = (key - begin.view(U) * _KEY_SUM)[doc] if below else None

    def candidates(at: np.ndarray, chunk_stop: np.ndarray) -> np.ndarray:
        """Rank above place of the pairs that start at ``at``; NEVER for what can't be joined."""
        out = np.full(len(at), NEVER)
        mid = following[at]
        has = np.flatnonzero(mid < chunk_stop)
        a, m = at[has], mid[has]
        new = pieces.merged(sym[a], sym[m])
        ok = new >= 0
        if below:
            o = np.flatnonzero(ok)
            ao, mo = a[o], m[o]
            h = hashed[ao]
            h += ao.view(U) * _KEYS[0]
            h += mo.view(U) * _KEYS[1]
            h += following[mo].view(U) * _KEYS[2]
            ok[o] = mix(h) >= U(below)
        out[has[ok]] = (pieces.rank[new[ok]] << _RANK_SHIFT) | a[ok]
        return out

    length = stop - first
    for c in np.flatnonzero(length > LONG):
        _agenda(pieces, int(first[c]), int(stop[c]), sym, following, before, live, candidates)
    c = np.flatnonzero((length > 1) & (length <= LONG))
    c = c[np.argsort(length[c], kind="stable")]
    _lockstep(pieces, first[c], stop[c], sym, following, before, live, candidates)

    at = np.flatnonzero(live)
    ids, own = sym[at], doc[at]
    other = (ids < 0) | (ids >= pieces.n)
    if other.any():
        ids, own = _bytes(pieces, ids, own, other, code[at])
    return ids.astype(np.int32), np.bincount(own, minlength=len(texts))


def _lockstep(pieces, first, stop, sym, following, before, live, candidates) -> None:
    """Join the best candidate of every chunk, again and again, until no chunk has one.

    ``place`` holds the symbols of all open chunks one after the other, ``best`` their candidates.
    """
    length = stop - first
    place = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    slot = np.empty(len(sym), np.int64)  # where a symbol's candidate stands in ``best``
    best = candidates(place, np.repeat(stop, length))
    while len(first):
        slot[place] = np.arange(len(place))
        base = np.cumsum(length) - length
        top = np.minimum.reduceat(best, base)
        open_ = top < NEVER
        if not open_.all():
            # closed chunks go, and so do symbols that were joined to their left
            stay = np.repeat(open_, length) & live[place]
            kept = np.add.reduceat(stay, base)[open_]
            place, best = place[stay], best[stay]
            first, stop, length, top = first[open_], stop[open_], kept, top[open_]
            if not len(first):
                return
            slot[place] = np.arange(len(place))
        a = top & ((1 << _RANK_SHIFT) - 1)
        m = following[a]
        e = following[m]
        sym[a] = pieces.merged(sym[a], sym[m])
        live[m] = False
        best[slot[m]] = NEVER
        following[a] = e
        inner = e < stop
        before[e[inner]] = a[inner]
        best[slot[a]] = candidates(a, stop)
        left = a > first
        p = before[a[left]]
        best[slot[p]] = candidates(p, stop[left])


def _agenda(pieces, first, stop, sym, following, before, live, candidates) -> None:
    """One long chunk: a heap of candidates; those whose symbols have changed meanwhile are passed over."""
    at = np.arange(first, stop)
    entry = candidates(at, np.full(len(at), stop))
    heap = [(int(x), int(following[p]), int(following[following[p]]) if following[p] < stop else stop) for x, p in zip(entry, at) if x < NEVER]
    heapq.heapify(heap)
    limit = np.array([stop])
    while heap:
        x, m, e = heapq.heappop(heap)
        a = x & ((1 << _RANK_SHIFT) - 1)
        if not live[a] or following[a] != m or not live[m] or following[m] != e:
            continue
        sym[a] = pieces.merged(sym[a:a + 1], sym[m:m + 1])[0]
        live[m] = False
        following[a] = e
        if e < stop:
            before[e] = a
        for p in ([a] if a == first else [a, int(before[a])]):
            new = int(candidates(np.array([p]), limit)[0])
            if new < NEVER:
                mid = int(following[p])
                heapq.heappush(heap, (new, mid, int(following[mid])))


def _bytes(pieces, ids, own, other, code) -> tuple[np.ndarray, np.ndarray]:
    """Replace the symbols without a piece by the byte pieces of their character."""
    raw = [chr(c).encode() for c in code[other]]
    width = np.ones(len(ids), np.int64)
    width[other] = [len(r) for r in raw]
    out = np.repeat(ids, width)
    out[np.repeat(other, width)] = pieces.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.repeat(own, width)


def decode(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the length of each."""
    size = pieces.raw_len[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total)
    at += np.repeat(pieces.raw_at[ids] - (ends - size), size)
    out = pieces.raw[at]
    full = np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])
    begin = (np.cumsum(full) - full)[full > 0]
    keep = np.ones(total, bool)
    keep[begin] = False  # the space that encoding put before each text
    return out[keep], full - (full > 0)


def _encode_task(path: str, seed: int, dropout: float, slice_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            lo = 0
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(0)), 0).to_numpy(zero_copy_only=False))
            while lo < batch.num_rows:
                done = int(sizes[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(sizes, done + slice_chars, side="right")))
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column(0).to_pylist()]
                ids, counts = encode(pieces, texts, rows.column(1).to_numpy(zero_copy_only=False), seed, dropout)
                raw, lengths = decode(pieces, ids, counts)
                whole = "".join(texts).encode()
                if len(whole) == len(raw) and np.array_equal(np.frombuffer(whole, np.uint8), raw) and [len(t.encode()) for t in texts] == lengths.tolist():
                    lossless = np.ones(len(texts), bool)
                else:
                    parts = np.split(raw, np.cumsum(lengths)[:-1])
                    lossless = np.array([t.encode() == p.tobytes() for t, p in zip(texts, parts)])
                ends = np.cumsum(counts)
                data = memoryview(ids.astype("<i4")).cast("B")
                sums = [zlib.crc32(data[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), counts.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*rows.columns[2:], lists, pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(lossless)],
                                                 names=[*rows.schema.names[2:], "ids", "n_ids", "ids_crc32", "lossless"])
                lo = hi

    return run


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), seed: int = 7, dropout: float = 0.1,
                     slice_chars: int = 100_000) -> DataFrame:
    """doc_id, the ``keep`` columns, ids, n_ids, ids_crc32 (of the ids as little-endian 32-bit integers) and
    lossless (the decoded ids are the text) of every document. ``model``: a file that every worker can open."""
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.xxhash64(F.col(id_col)).alias("_key"), F.col(id_col).alias("doc_id"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(_encode_task(model, seed, dropout, slice_chars), f"{schema}, ids array<int>, n_ids long, ids_crc32 long, lossless boolean")


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of encoded documents; null ids decode to the empty text."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        pieces = load(model)
        for batch in batches:
            lists = batch.column(1)
            raw, lengths = decode(pieces, lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy())
            offsets = pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StringArray.from_buffers(batch.num_rows, offsets, pa.py_buffer(raw.tobytes()))], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
