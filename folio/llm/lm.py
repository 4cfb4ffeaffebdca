"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept in sorted hash arrays.

Counting. Tasks hash the words of training documents, sum the n-grams of a few million tokens
at a time and send them, packed, to shards: the most frequent words as codes of 19 bits, others as
their hashes, so that the packing loses nothing. A shard is a range of n-gram keys; a key's
leading bits come from its context, so a context's n-grams and its totals meet in one shard.
Words that hold over 1/512 of all tokens are the exception: contexts made of such words only
spread over all shards by the whole n-gram, and their totals are summed afterwards (there are
at most 512 such words, whatever the corpus). Each shard task merges its n-grams, writes
arrays sorted by key (a key's leading bits are told by its place, its last bytes are kept and
hold a small count as well), and passes on, to the shards of the next lower order, how many distinct words
stand before each shorter n-gram. The raw counts of single words travel along. What goes to the
next order is staged, and the shuffle files of the order before go. The shards grow in number with
the corpus, as each has to fit a worker's memory; their files are joined, so that a worker that
scores maps some 1,500 files at order 3, whatever the corpus.

Scoring. Workers map the arrays from the shared folder and look up the n-grams of a chunk of
documents at a time, sorted, by binary search. All orders are interpolated down to a uniform
share for unknown words, so every text has a probability.

The arrays need a folder that all machines have mounted; a task that runs again writes the same
file again, in one move.

Defined cases: null text is empty, and an empty text is its end alone; a null id is not held
out; without training tokens every word has the uniform share 1 / (V + 1); repeated rows count
and score one by one; very long texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import crc_mod, mounted, shared_path, stage
from folio.llm.textnum import GRAM, chunks, grams, mix, word_bounds, word_hashes

U = np.uint64
BOS, END = U(0x0123456789ABCDEF), U(0xFEDCBA9876543210)
HEAVY = 512
CODE_BITS = 19
CODES = (1 << CODE_BITS) - 1  # words with codes; also the code of all others
SURVEY_TOKENS = 4_000_000
CONTEXT_BITS = 20
FLUSH_TOKENS = 6_000_000
SHARD_TOKENS = 2_000_000
CHUNK = 2 << 20
SLICE = 1 << 18  # n-grams whose keys are made at a time
MERGE_ROWS = 3_000_000  # n-grams of a shard that are merged at a time, unless more of them are distinct
FILE_BITS = 6           # files of a kind are 64 at most: each that is mapped is an open file
BATCH_BYTES = 1 << 20
_LOW = U((1 << (64 - CONTEXT_BITS)) - 1)
ROWS = "level int, bucket int, payload binary, ctx long, sums array<long>"
_ARROW = pa.schema([("level", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary()), ("ctx", pa.int64()), ("sums", pa.list_(pa.int64()))])


@dataclass
class Model:
    """Where the arrays are, and what is global: all of bounded size."""

    path: str
    order: int
    shard_bits: int
    tokens: int
    types: int
    heavy: np.ndarray                                   # words over 1/512 of all tokens, sorted
    discounts: dict[int, list[float]] = field(default_factory=dict)
    unigram_total: float = 0.0
    unigram_left: float = 0.0                           # mass that order 1 leaves to the uniform share
    heavy_ctx: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @property
    def file_bits(self) -> int:
        return min(self.shard_bits, FILE_BITS)


# ---- tokens ---------------------------------------------------------------------------------

def tokens(buf: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all rows' tokens, each row led by order - 1 BOS and closed by END; the places of
    the tokens to predict; and how many of those each row has."""
    starts, ends, first = word_bounds(buf, offs)
    h = word_hashes(buf, starts, ends) if len(starts) else np.empty(0, U)
    per_row = np.diff(first)
    row = np.repeat(np.arange(len(per_row)), per_row)
    out = np.full(len(h) + len(per_row) * order, BOS, U)
    out[np.arange(len(h)) + row * order + (order - 1)] = h
    out[first[1:] + np.arange(1, len(per_row) + 1) * order - 1] = END
    targets = np.ones(len(out), bool)
    begin = first[:-1] + np.arange(len(per_row)) * order
    for i in range(order - 1):
        targets[begin + i] = False
    return out, np.flatnonzero(targets), per_row + 1


def _is_in(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    near = np.zeros(1 << 16, bool)  # by leading bits: most words share them with none of the table
    near[table >> U(48)] = True
    out = near[x >> U(48)]
    at = np.flatnonzero(out)
    if len(at):
        out[at] = table[np.minimum(np.searchsorted(table, x[at]), len(table) - 1)] == x[at]
    return out


def keys_of(columns: list[np.ndarray], heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, context hash, whether the context is spread) of n-grams given as columns of word hashes."""
    k = len(columns)
    if k == 1:
        return columns[0], np.zeros(len(columns[0]), U), np.zeros(len(columns[0]), bool)
    n = len(columns[0])
    key, context, spread = np.empty(n, U), np.empty(n, U), np.empty(n, bool)
    for at in (slice(lo, lo + SLICE) for lo in range(0, n, SLICE)):
        part = [c[at] for c in columns]
        whole, context[at], spread[at] = _hash(part), _hash(part[:-1]), _is_in(part[0], heavy)
        for c in part[1:-1]:
            spread[at] &= _is_in(c, heavy)
        key[at] = np.where(spread[at], whole, (context[at] & ~_LOW) | (whole & _LOW))
    return key, context, spread


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    out = columns[0] * GRAM[0]
    for i, c in enumerate(columns[1:], 1):
        out = out + c * GRAM[i]
    return mix(out)


# ---- packed n-grams -------------------------------------------------------------------------

class Codes:
    """Codes of 19 bits for the given words, most frequent first."""

    def __init__(self, words: np.ndarray):
        self.words = words
        order_of = np.argsort(words)
        self.sorted, self.rank = words[order_of], order_of.astype(np.uint32)
        # where the words with given leading bits begin: mostly there are one or none
        lead = (self.sorted >> U(64 - CODE_BITS - 1)).astype(np.int64)
        self.start = np.concatenate(([0], np.cumsum(np.bincount(lead, minlength=1 << CODE_BITS + 1)))).astype(np.uint32)

    def __reduce__(self):
        return Codes, (self.words,)

    def of(self, column: np.ndarray) -> np.ndarray:
        out = np.full(len(column), CODES, np.uint32)
        for lo in range(0, len(column), SLICE):
            part = column[lo:lo + SLICE]
            lead = (part >> U(64 - CODE_BITS - 1)).astype(np.int64)
            at, end = self.start[lead], self.start[lead + 1]
            left = np.flatnonzero(at < end)
            at, end, word = at[left], end[left], part[left]
            while len(left):
                hit = self.sorted[at] == word
                out[lo + left[hit]] = self.rank[at[hit]]
                at += np.uint32(1)
                on = np.flatnonzero(~hit & (at < end))
                left, at, end, word = left[on], at[on], end[on], word[on]
        return out


def pack(columns: list[np.ndarray], codes: list[np.ndarray], count: np.ndarray, raw: np.ndarray) -> bytes:
    """n-grams with two counts; the codes' first, second and third bytes stand apart, as they compress best so."""
    same = bool(np.array_equal(count, raw))
    others = [c[code == CODES] for c, code in zip(columns, codes)]
    head = np.array([len(count), len(columns), same, *(len(o) for o in others)], np.int64)
    planes = [code.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T for code in codes]
    parts = [head, *planes, *others, count.astype(np.uint32), *([] if same else [raw.astype(np.uint64)])]
    body = b"".join(p.tobytes() for p in parts)
    return len(body).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(body, asbytes=True)


def unpack(payload: bytes, codes: Codes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    body = pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
    n, k, same = np.frombuffer(body, np.int64, 3).tolist()
    others = np.frombuffer(body, np.int64, k, 24).tolist()
    at = 24 + 8 * k

    def take(kind, size):
        nonlocal at
        a = np.frombuffer(body, kind, size, at)
        at += a.nbytes
        return a

    planes = [take(np.uint8, 3 * n).reshape(3, n) for _ in range(k)]
    columns = []
    for plane, size in zip(planes, others):
        code = plane[0] | plane[1].astype(np.uint32) << 8 | plane[2].astype(np.uint32) << 16
        known = code != CODES
        column = np.empty(n, U)
        column[known] = codes.words[code[known]]
        column[~known] = take(U, size)
        columns.append(column)
    count = take(np.uint32, n).astype(np.int64)
    return columns, count, count if same else take(U, n).astype(np.int64)


def _runs(order_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorting order, and the places in it at which a new value begins."""
    o = np.argsort(order_of)
    s = order_of[o]
    return o, np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))


def _sum_by(order_of: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows at which a new value begins in order of ``order_of``, and sums of ``values`` by it."""
    o, at = _runs(order_of)
    return (o[at], *[np.add.reduceat(v[o], at) for v in values])


def _send(level: int, columns: list[np.ndarray], count: np.ndarray, raw: np.ndarray, heavy: np.ndarray, codes: Codes, bits: int,
          coded: list[np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """Summed n-grams as a payload for each of their shards, sorted by the codes of their first words."""
    key = keys_of(columns, heavy)[0]
    coded = coded or [codes.of(c) for c in columns]
    rank = np.empty(len(key), U)
    for at in (slice(lo, lo + SLICE) for lo in range(0, len(key), SLICE)):
        rank[at] = sum(c[at].astype(U) << U(64 - CODE_BITS * (i + 1)) for i, c in enumerate(coded[:3])) >> U(bits)
        if bits:
            rank[at] |= key[at] >> U(64 - bits) << U(64 - bits)
    del key
    o = np.argsort(rank)
    ends = np.searchsorted(rank, np.arange(1, 1 << bits, dtype=U) << U(64 - bits), sorter=o).tolist() if bits else []
    del rank
    for shard, (lo, hi) in enumerate(zip([0, *ends], [*ends, len(o)])):
        if lo < hi:
            at = o[lo:hi]
            yield _row(level, shard, pack([c[at] for c in columns], [c[at] for c in coded], count[at], raw[at]))


def _row(level: int, bucket: int, payload: bytes | None = None, ctx: int | None = None, sums: list[int] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"level": level, "bucket": bucket, "payload": payload, "ctx": ctx, "sums": sums}], schema=_ARROW)


def _sums_rows(level: int, bucket: int, ctx: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    n, wide = sums.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * wide), pa.array(sums.reshape(-1)))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, level, np.int32)), pa.array(np.full(n, bucket, np.int32)), pa.nulls(n, pa.binary()),
                                       pa.array(ctx.view(np.int64)), lists.cast(_ARROW.field("sums").type)], schema=_ARROW)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, about ``BATCH_BYTES`` of them at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# ---- sorted keys ----------------------------------------------------------------------------

LEAST_NOTE = 4  # bits of a note at least
NEAR = 128      # rows that are searched for all keys at once


def _layout(n: int, bits: int) -> tuple[int, int]:
    """(bytes kept of a key, leading bits after the shard's that ``start`` tells) for the least disk."""
    sizes = [(w, max(0, 64 - bits - 8 * w + LEAST_NOTE)) for w in range(1, 9)]
    width, told = min(sizes, key=lambda s: (n * s[0] + (4 << s[1]), s[0]))
    return width, max(told, min(64 - bits, max(1, n >> 6).bit_length() - 1))


class Keys:
    """Sorted keys of a shard, each with a note of a few bits, without the bits that all its keys or
    its place tell: ``start`` has where the keys with given leading bits begin, ``kept`` what is left."""

    def __init__(self, start: np.ndarray, kept: np.ndarray, bits: int):
        self.start, n = np.asarray(start), int(start[-1])
        self.width, self.bits, self.told = (len(kept) - 8) // n if n else 8, bits, (len(start) - 1).bit_length() - 1
        self.left = 64 - bits - self.told
        self.note = 8 * self.width - self.left if n else 0
        # windows of 8 bytes that end with every key's: the low ones are of keys before and change no comparison
        self.rows, self.low = np.ndarray((n,), "<u8", np.asarray(kept), self.width, (self.width,)), U(64 - 8 * self.width)

    @staticmethod
    def room(n: int, bits: int) -> int:
        """Bits of a note."""
        width, told = _layout(n, bits)
        return 8 * width - (64 - bits - told)

    @staticmethod
    def pack(keys: np.ndarray, notes: np.ndarray, bits: int, n: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(start, kept) of sorted distinct keys that share their leading ``bits``, laid out as ``n`` keys if given."""
        width, told = _layout(len(keys) if n is None else n, bits)
        left = 64 - bits - told
        lead = (keys >> U(left) & U((1 << told) - 1)).astype(np.int64) if told else np.zeros(len(keys), np.int64)
        start = np.concatenate(([0], np.cumsum(np.bincount(lead, minlength=1 << told)))).astype(np.uint32)
        value = (keys & U((1 << left) - 1)) << U(8 * width - left) | notes.astype(U)
        kept = np.ascontiguousarray(value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).reshape(-1)
        return start, np.concatenate((np.zeros(8, np.uint8), kept))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys (of this shard) are held, and their notes."""
        if not len(self.rows):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lead = (keys >> U(self.left) & U((1 << self.told) - 1)).astype(np.int64) if self.told else np.zeros(len(keys), np.int64)
        value = keys << U(64 - self.left)
        end = self.start[lead + 1].astype(np.int64) - 1
        at = self.start[lead].astype(np.int64) - 1  # the last row that is known to come before the key
        most = int((end - at).max(initial=0))
        for step in (1 << i for i in reversed(range(most.bit_length()))):
            if step >= NEAR:
                far = np.flatnonzero(end - at >= NEAR)
                next_ = np.minimum(at[far] + step, end[far])
                at[far] = np.where(self.rows[next_] < value[far], next_, at[far])
            else:
                next_ = np.minimum(at + step, end)
                np.copyto(at, next_, where=self.rows[next_] < value)
        inside = np.flatnonzero(at < end)
        row = self.rows[at[inside] + 1] >> self.low
        hit = row >> U(self.note) == value[inside] >> U(64 - self.left)
        return inside[hit], (row[hit] & U((1 << self.note) - 1)).astype(np.int64)


# ---- counting -------------------------------------------------------------------------------

def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of a task (word null), and the words that come more than once in some millions of them."""
    held: list[np.ndarray] = []
    n = 0

    def flush() -> pa.RecordBatch:
        word, count = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        often = (count > 1) | (count * HEAVY >= n)
        found = pa.array(np.append(U(0), word[often]).view(np.int64), mask=np.arange(int(often.sum()) + 1) == 0)
        return pa.RecordBatch.from_arrays([found, pa.array(np.append(n, count[often]).astype(np.int64))], names=["word", "n"])

    for batch in batches:
        for _, _, buf, offs in chunks(batch.column(0), CHUNK):
            p, at, _ = tokens(buf, offs, 1)
            held.append(p[at])
            n += len(at)
            if n >= SURVEY_TOKENS:
                yield flush()
                n = 0
    if n:
        yield flush()


def _count_task(order: int, heavy: np.ndarray, codes: Codes, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            p = np.concatenate([h for h, _ in held])
            before = np.cumsum([0, *(len(h) for h, _ in held)])
            begin = np.concatenate([at + b for (_, at), b in zip(held, before)]) - (order - 1)
            held.clear()
            o, at = _runs(grams(p, order)[begin])
            begin, count = begin[o[at]], np.diff(at, append=len(o))
            del o, at
            code = codes.of(p)
            columns, coded = [p[begin + j] for j in range(order)], [code[begin + j] for j in range(order)]
            del p, begin, code
            yield from _send(order, columns, count, count, heavy, codes, bits, coded)

        for batch in batches:
            for _, _, buf, offs in chunks(batch.column(0), CHUNK):
                p, at, _ = tokens(buf, offs, order)
                held.append((p, at))
                n += len(at)
                if n >= FLUSH_TOKENS:
                    yield from _together(flush())
                    n = 0
        if n:
            yield from _together(flush())

    return run


def _save(path: str, name: str, *pieces: np.ndarray, once: bool = False) -> None:
    """Write arrays, one after another, as one file. ``once``: a file that is there already stays as it is."""
    temporary, final = os.path.join(path, f".{name}-{os.getpid()}-{os.urandom(4).hex()}"), os.path.join(path, name)
    shape, kind = (sum(map(len, pieces)), *pieces[0].shape[1:]), np.lib.format.dtype_to_descr(pieces[0].dtype)
    with open(temporary, "wb") as f:
        np.lib.format.write_array_header_1_0(f, {"descr": kind, "fortran_order": False, "shape": shape})
        for piece in pieces:
            f.write(np.ascontiguousarray(piece).data)
    if once and os.path.exists(final):
        os.remove(temporary)
    else:
        os.replace(temporary, final)


def _save_keys(path: str, name: str, keys: np.ndarray, notes: np.ndarray, bits: int, n: int | None) -> None:
    for part, array in zip(("start", "kept"), Keys.pack(keys, notes, bits, n)):
        _save(path, f"{name}{part}.npy", array)


Part = tuple[list[np.ndarray], np.ndarray, np.ndarray]


def _merge_task(level: int, path: str, heavy: np.ndarray, codes: Codes, bits: int, n: int | None = None):
    """Merge the shards of one order, write their arrays (all laid out as those of ``n`` keys if given), send the next lower order on."""

    def summed(parts: list[Part]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each n-gram of the parts once, by its key: words, counts, raw counts, key, context hash, whether that is spread. Empties ``parts``."""
        columns = [np.concatenate([p[0][j] for p in parts]) for j in range(level)]
        count, raw = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        parts.clear()
        key, context, spread = keys_of(columns, heavy)
        first, count, raw = _sum_by(key, count, raw)
        for j in range(level):
            columns[j] = columns[j][first]
        return columns, count, raw, key[first], context[first], spread[first]

    def merge(bucket: int, parts: list[Part]) -> Iterator[pa.RecordBatch]:
        columns, count, raw, key, context, spread = summed(parts)
        kinds = [int((count == j).sum()) for j in range(1, 5)]
        if level == 1:
            _save(path, f"1-{bucket}-key.npy", key)
            for name, values in (("left", count), ("raw", raw)):
                wide = np.flatnonzero(values >= 255)  # rows of numbers that a byte can't hold, and these
                _save(path, f"1-{bucket}-{name}.npy", np.minimum(values, 255).astype(np.uint8))
                _save(path, f"1-{bucket}-{name}wide.npy", np.stack((wide, values[wide])))
            yield _row(0, -1 - bucket, ctx=1, sums=[*kinds, len(key), int(count.sum()), int((count >= 3).sum()), int(raw.sum())])
            return
        most = (1 << Keys.room(n or len(key), bits)) - 1
        _save_keys(path, f"{level}-{bucket}-key", key, np.minimum(count, most), bits, n)
        many = np.flatnonzero(count >= most)  # counts that a note can't hold
        _save(path, f"{level}-{bucket}-many.npy", np.stack((key[many], count[many].astype(U))))
        one, total, n1, n2, n3 = _sum_by(context, count, (count == 1).astype(np.int64), (count == 2).astype(np.int64), (count >= 3).astype(np.int64))
        of, sums = context[one], np.stack((total, n1, n2, n3), axis=1)
        own = ~spread[one]
        del key, context, spread, one, total, n1, n2, n3
        of_own, sums_own = of[own], sums[own]
        # n1 and n2 of contexts without larger counts make a note if they are small, 0 stands for all others
        room = Keys.room(n or len(of_own), bits)
        half = room // 2
        small = (sums_own[:, 3] == 0) & (sums_own[:, 1] < 1 << (room - half)) & (sums_own[:, 2] < 1 << half)
        _save_keys(path, f"{level}-{bucket}-ctx", of_own, np.where(small, sums_own[:, 1] << half | sums_own[:, 2], 0), bits, n)
        of_own, sums_own = of_own[~small], sums_own[~small]
        _save(path, f"{level}-{bucket}-some.npy", of_own)
        _save(path, f"{level}-{bucket}-sums.npy", np.minimum(sums_own, 255).astype(np.uint8))
        wide = np.flatnonzero(sums_own[:, 0] >= 255)  # the total is the largest of the sums
        _save(path, f"{level}-{bucket}-wide.npy", of_own[wide])
        _save(path, f"{level}-{bucket}-widesums.npy", sums_own[wide].astype(np.uint32))
        yield _row(0, -1 - bucket, ctx=level, sums=[*kinds, len(count), int(count.sum()), int((count >= 3).sum()), int(raw.sum())])
        if not own.all():
            yield _sums_rows(-level, -1 - bucket, of[~own], sums[~own])
        del of, sums, own, of_own, sums_own, small, count
        shorter = columns[1:]
        del columns
        # an n-gram that begins a text has no word before it and keeps its count
        left = np.where(shorter[0] == BOS, raw, 1) if level > 2 else np.ones(len(raw), np.int64)
        first, left, raw = _sum_by(shorter[0] if level == 2 else _hash(shorter), left, raw)
        shorter = [c[first] for c in shorter]
        del first
        yield from _send(level - 1, shorter, left, raw, heavy, codes, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, held, once = None, [], 0, 0
        for batch in batches:
            for b, payload in zip(batch.column(1).to_pylist(), batch.column(2)):
                if b != bucket and parts:
                    yield from _together(merge(bucket, parts))
                    parts, held, once = [], 0, 0
                bucket = b
                parts.append(unpack(payload.as_py(), codes))
                held += len(parts[-1][1])
                if held >= MERGE_ROWS + 2 * once:  # the n-grams of a frequent word come from all shards above
                    parts = [summed(parts)[:3]]
                    held = once = len(parts[0][1])
        if parts:
            yield from _together(merge(bucket, parts))

    return run


def _shards(path: str, level: int) -> str:
    """Where the files of an order's shards are until they are joined."""
    return os.path.join(path, f"shards-{level}")


def _join_task(level: int, path: str, bits: int, n: int):
    """Join the files of neighbouring shards: one of each kind for all that share their leading ``FILE_BITS``."""
    folder, each = _shards(path, level), bits - FILE_BITS
    kinds = ("left", "leftwide", "raw", "rawwide", "key") if level == 1 else (
        "keystart", "keykept", "many", "ctxstart", "ctxkept", "some", "sums", "wide", "widesums")

    def load(kind: str, shards: list[int]) -> list[np.ndarray]:
        return [np.load(os.path.join(folder, f"{level}-{s}-{kind}.npy"), mmap_mode="r") for s in shards]

    def joined(kind: str, shards: range, held: list[int]) -> list[np.ndarray]:
        found = load(kind, held)
        if kind.endswith("start"):
            start, rows, pieces = dict(zip(held, found)), 0, []
            for s in shards:
                pieces.append(start[s][:-1] + np.uint32(rows) if s in start else np.full(1 << _layout(n, bits)[1], rows, np.uint32))
                rows += int(start[s][-1]) if s in start else 0
            return [*pieces, np.array([rows], np.uint32)]
        if kind.endswith("kept"):
            return [np.zeros(8, np.uint8), *(k[8:] for k in found)]
        if kind == "many":
            return [np.concatenate(found, axis=1)]
        if kind.endswith("wide") and level == 1:  # numbers of rows, and what is there
            before = np.cumsum([0, *map(len, load("key", held))])
            return [np.concatenate([np.stack((f[0] + b, f[1])) for f, b in zip(found, before)], axis=1)]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in (g for batch in batches for g in batch.column(0).to_pylist()):
            shards = range(group << each, (group + 1) << each)
            held = [s for s in shards if os.path.exists(os.path.join(folder, f"{level}-{s}-key{'' if level == 1 else 'kept'}.npy"))]
            try:
                for kind in kinds if held else ():
                    _save(path, f"{level}-{group}-{kind}.npy", *joined(kind, shards, held), once=True)
            except FileNotFoundError:  # another run of this task is done with the group
                if not all(os.path.exists(os.path.join(path, f"{level}-{group}-{kind}.npy")) for kind in kinds):
                    raise
            for file in (os.path.join(folder, f"{level}-{s}-{kind}.npy") for s in shards for kind in kinds):
                with contextlib.suppress(FileNotFoundError):
                    os.remove(file)
        yield from ()

    return run


def discounts(kinds: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from the numbers of n-grams counted 1 to 4 times; for
    corpora too small to estimate them: 0.5, 1 and 1.5."""
    n1, n2, n3, n4 = kinds
    if min(kinds) <= 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return d if all(0 <= x <= j for j, x in enumerate(d, 1)) else [0.5, 1.0, 1.5]


def train(docs: DataFrame, order: int = 2, text_col: str = "text", path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Count the texts of ``docs`` and write the model's arrays to ``path`` (a new shared folder if None)."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    path = mounted(path or shared_path(spark, "lm"))
    os.makedirs(path, exist_ok=True)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    survey = stage(texts.mapInArrow(_survey, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-survey", free=True)
    n_tokens = survey.where(F.col("word").isNull()).first()
    n_tokens = int(n_tokens["n"]) if n_tokens else 0
    words = survey.where(F.col("word").isNotNull())
    least, n_often = 1, 0  # words with a count of ``least`` or more are fewer than CODES
    for r in sorted(words.groupBy(F.floor(F.log2("n") * 8).cast("long").alias("step")).count().collect(), reverse=True):  # some 500 rows at most
        n_often += r["count"]
        if n_often >= CODES:
            least = 2 ** ((r["step"] + 1) / 8)
            break
    often = words.where((F.col("n") >= least) | (F.col("n") * HEAVY >= n_tokens)).select("word", "n").toArrow()  # CODES + 511 rows at most
    word, n = often["word"].to_numpy().astype(np.int64), often["n"].to_numpy()
    word, n = (x[np.lexsort((word, -n))] for x in (word, n))
    word = word.view(U)
    # a word over 2/512 of all tokens has over half of them in chunks where it is over 1/512
    heavy = np.unique(np.append(word[n * HEAVY >= n_tokens], BOS))
    codes = Codes(np.append(BOS, word[word != BOS])[:CODES])
    bits = max(0, -(-n_tokens // shard_tokens) - 1).bit_length()

    rows, sums = texts.mapInArrow(_count_task(order, heavy, codes, bits), ROWS), []
    n = max(1, n_tokens >> bits) if bits > FILE_BITS else None  # files that are joined have one layout
    for level in range(order, 0, -1):
        folder = path if n is None else _shards(path, level)
        os.makedirs(folder, exist_ok=True)
        shards = rows.where(F.col("level") == level).repartition("bucket").sortWithinPartitions("bucket")
        # n-grams of one order are on disk at a time, beside the arrays
        rows = stage(shards.mapInArrow(_merge_task(level, folder, heavy, codes, bits, n), ROWS), f"lm-{level}", free=True)
        sums.append(rows.where(F.col("level") <= 0).select("level", "ctx", "sums"))
        if n is not None:
            spark.range(0, 1 << FILE_BITS, 1, 1 << FILE_BITS).mapInArrow(_join_task(level, path, bits, n), "id long").collect()  # no rows
            with contextlib.suppress(OSError):
                os.rmdir(folder)
    sums = reduce(DataFrame.unionByName, sums)
    total = sums.groupBy("level", "ctx").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(8)]).collect()  # at most 513 ** (order - 1) + order rows

    model = Model(path, order, bits, n_tokens, 0, heavy)
    for level in range(1, order + 1):
        s = next(([r[f"s{i}"] for i in range(8)] for r in total if r["level"] == 0 and r["ctx"] == level), [0] * 8)
        model.discounts[level] = discounts(s[:4])
        if level == 1:
            d = model.discounts[1]
            model.types, model.unigram_total = s[4], float(s[5])
            model.unigram_left = d[0] * s[0] + d[1] * s[1] + d[2] * s[6]
        spread = sorted((r["ctx"] & (2 ** 64 - 1), [r[f"s{i}"] for i in range(4)]) for r in total if r["level"] == -level)
        model.heavy_ctx[level] = (np.array([c for c, _ in spread], U), np.array([v for _, v in spread], np.int64).reshape(-1, 4))
    return model


# ---- scoring --------------------------------------------------------------------------------

class Arrays:
    """A worker's view of a model's files, mapped when first touched."""

    def __init__(self, model: Model):
        self.model, self.files = model, {}

    def file(self, level: int, shard: int, name: str) -> np.ndarray | None:
        at = (level, shard, name)
        if at not in self.files:
            full = os.path.join(self.model.path, f"{level}-{shard}-{name}.npy")
            self.files[at] = np.load(full, mmap_mode="r") if os.path.exists(full) else None
        return self.files[at]

    def keys(self, level: int, shard: int, name: str) -> Keys | None:
        at = (level, shard, name)
        if at not in self.files:
            start, kept = self.file(level, shard, name + "start"), self.file(level, shard, name + "kept")
            self.files[at] = None if start is None else Keys(start, kept, self.model.file_bits)
        return self.files[at]

    def find(self, level: int, index: str, keys: np.ndarray, shards: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, which of the keys it holds, at which rows of its arrays or, above level 1, their notes); ``shards`` ascends."""
        at = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))) if len(shards) else []
        for lo, hi in zip(at, [*at[1:], len(shards)]):
            table = (self.file if level == 1 else self.keys)(level, int(shards[lo]), index)
            if table is None:
                continue
            if level > 1:
                hit, note = table.find(keys[lo:hi])
                yield int(shards[lo]), lo + hit, note
            elif len(table):
                row = np.minimum(np.searchsorted(table, keys[lo:hi]), len(table) - 1)
                hit = np.flatnonzero(table[row] == keys[lo:hi])
                yield int(shards[lo]), lo + hit, row[hit]

    def shard(self, key: np.ndarray) -> np.ndarray:
        bits = self.model.file_bits
        return (key >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)

    def words(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct words before, raw count) of sorted words."""
        left, raw = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        for shard, which, row in self.find(1, "key", key, self.shard(key)):
            for out, name in ((left, "left"), (raw, "raw")):
                found = self.file(1, shard, name)[row].astype(np.int64)
                wide = np.flatnonzero(found == 255)
                if len(wide):
                    table = self.file(1, shard, name + "wide")
                    found[wide] = table[1][np.searchsorted(table[0], row[wide])]
                out[which] = found
        return left, raw

    def counts(self, level: int, key: np.ndarray) -> np.ndarray:
        """Counts of sorted n-gram keys."""
        out = np.zeros(len(key), np.int64)
        for shard, which, c in self.find(level, "key", key, self.shard(key)):
            many = np.flatnonzero(c == (1 << self.keys(level, shard, "key").note) - 1)
            if len(many):
                table = self.file(level, shard, "many")
                c[many] = table[1][np.searchsorted(table[0], key[which[many]])]
            out[which] = c
        return out

    def contexts(self, level: int, context: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """(total, n1, n2, n3+) of sorted contexts."""
        out = np.zeros((len(context), 4), np.int64)
        own = np.flatnonzero(~spread)
        for shard, which, note in self.find(level, "ctx", context[own], self.shard(context[own])):
            half = self.keys(level, shard, "ctx").note // 2
            n1, n2 = note >> half, note & (1 << half) - 1
            out[own[which]] = np.stack((n1 + 2 * n2, n1, n2, np.zeros(len(note), np.int64)), axis=1)
            some = own[which[note == 0]]
            if not len(some):
                continue
            found = self.file(level, shard, "sums")[np.searchsorted(self.file(level, shard, "some"), context[some])].astype(np.int64)
            wide = np.flatnonzero(found[:, 0] == 255)
            if len(wide):
                found[wide] = self.file(level, shard, "widesums")[np.searchsorted(self.file(level, shard, "wide"), context[some[wide]])]
            out[some] = found
        table, sums = self.model.heavy_ctx[level]
        if len(table):
            far = np.flatnonzero(spread)
            row = np.minimum(np.searchsorted(table, context[far]), len(table) - 1)
            hit = table[row] == context[far]
            out[far[hit]] = sums[row[hit]]
        return out


def _less(count: np.ndarray, d: list[float]) -> np.ndarray:
    """Counts after their discount."""
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0.0)


def probabilities(arrays: Arrays, p: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(model probability, raw count) of the tokens at ``at``."""
    m = arrays.model
    word, back = np.unique(p[at], return_inverse=True)
    left, raw = arrays.words(word)
    uniform = 1.0 / (m.types + 1)
    prob = ((_less(left, m.discounts[1]) + m.unigram_left * uniform) / m.unigram_total if m.unigram_total else np.full(len(word), uniform))[back]
    for level in range(2, m.order + 1):
        key, context, spread = keys_of([p[at - (level - 1) + j] for j in range(level)], m.heavy)
        gram, gram_back = np.unique(key, return_inverse=True)
        count = arrays.counts(level, gram)[gram_back]
        ctx, ctx_back = np.unique(context, return_inverse=True)
        apart = np.zeros(len(ctx), bool)
        apart[ctx_back] = spread
        sums = arrays.contexts(level, ctx, apart).astype(np.float64)
        total, rest = sums[:, 0][ctx_back], (sums[:, 1:] @ np.array(m.discounts[level]))[ctx_back]
        seen = total > 0
        prob = np.where(seen, (_less(count, m.discounts[level]) + rest * prob) / np.where(seen, total, 1.0), prob)
    return prob, raw[back]


def _score_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        floor = model.tokens + (model.types + 1)
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(0), CHUNK):
                p, at, n = tokens(buf, offs, model.order)
                prob, raw = probabilities(arrays, p, at)
                begin = np.cumsum(n) - n
                score = np.add.reduceat(np.log10(prob), begin)
                base = np.add.reduceat(np.log10((raw + 1) / floor), begin)
                known = np.add.reduceat((raw > 0).astype(np.int64), begin)
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(n), pa.array(known), pa.array(base), pa.array(score)],
                                                 names=[*rows.schema.names[1:], "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``keep`` columns, n_tokens (words and the end), n_known (seen in training), base_score (add-one
    single words), score (log10 probability) and perplexity of every document."""
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col).alias("doc_id"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    scored = rows.mapInArrow(_score_task(model), f"{schema}, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def score_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2, folds: int = 7, fold: int = 2) -> DataFrame:
    """Scores of all documents by a model of those whose crc32(id as text) mod ``folds`` is not ``fold``."""
    out = crc_mod(F.col(id_col), folds) == fold
    model = train(docs.where(~out), order, text_col)
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), out.alias("held_out")), model, keep=("held_out",))
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
