"""Static range asymmetric numeral system over token ids, vectorised across interleaved lanes.

A segment holds one frequency table, shared by its blocks. Blocks are coded independently:
token i of a block belongs to lane i mod LANES, all lanes of all blocks advance together, and
a block's lanes share one stream of 32-bit words. Every CHECKPOINT steps a block keeps its
lanes' states and its place in the stream, so a decoder can start at any checkpoint; all
checkpoints of a segment are decoded side by side. Each block has a checksum of its ids.

States are 64 bits in [2**31, 2**63), frequencies sum to 2**SCALE.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

U = np.uint64
SCALE = 18
LANES = 64
STEPS = 1024
BLOCK = LANES * STEPS
CHECKPOINT = 256
LOW = U(1 << 31)
M = U(1 << SCALE)
HEAD = struct.Struct("<4sIQII")
MAGIC = b"rAN1"


class CorruptSegment(ValueError):
    """A segment whose bytes don't decode to what its checksums say."""


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**SCALE, at least 1 for every symbol that occurs."""
    total, target = int(counts.sum()), 1 << SCALE
    used = counts > 0
    if int(used.sum()) > target:
        raise ValueError(f"{int(used.sum())} distinct ids don't fit a table of 2**{SCALE}")
    f = np.where(used, np.maximum(1, counts.astype(np.float64) * (target / total)).astype(np.int64), 0)
    short = target - int(f.sum())
    if short > 0:
        f[np.argmax(f)] += short
    while short < 0:  # too many rare symbols were raised to 1: take it from the frequent ones
        most = int(np.argmax(f))
        give = min(-short, max(1, int(f[most]) // 8))
        f[most] -= give
        short += give
    return f


def _steps(n: int) -> tuple[int, np.ndarray]:
    """Blocks of n tokens, and the steps of each."""
    blocks = -(-n // BLOCK)
    steps = np.full(blocks, STEPS)
    if blocks:
        steps[-1] = -(-(n - (blocks - 1) * BLOCK) // LANES)
    return blocks, steps


def encode(ids: np.ndarray) -> bytes:
    """A segment of all ``ids``."""
    n = len(ids)
    if not n:
        return HEAD.pack(MAGIC, 0, 0, 0, 0)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    dense = np.empty(len(counts), np.int32)
    dense[symbols] = np.arange(len(symbols))
    f = frequencies(counts[symbols])
    cum = np.cumsum(f) - f
    blocks, steps = _steps(n)
    grid = np.zeros(blocks * BLOCK, np.int32)  # what is past the end codes as the first symbol
    np.take(dense, ids, out=grid[:n])
    grid = grid.reshape(blocks, STEPS, LANES)
    fu, cu = f.astype(U), cum.astype(U)
    state = np.full((blocks, LANES), LOW, U)
    words = np.zeros((blocks, STEPS, LANES), np.uint32)
    out = np.zeros((blocks, STEPS, LANES), bool)
    kept = np.zeros((blocks, STEPS // CHECKPOINT, LANES), U)
    for t in range(int(steps.max()) - 1, -1, -1):
        live = blocks if t < steps[-1] else blocks - 1
        x, s = state[:live], grid[:live, t]
        fs = fu[s]
        full = (x >> U(63 - SCALE)) >= fs
        words[:live, t] = x
        out[:live, t] = full
        x = x >> (full * U(32))
        q = x // fs
        q *= M - fs
        q += x
        q += cu[s]  # (x // f) * M + x % f + cum
        state[:live] = q
        if t % CHECKPOINT == 0:
            kept[:live, t // CHECKPOINT] = state[:live]
    per_step = out.sum(axis=2)
    before = np.cumsum(per_step, axis=1) - per_step
    marks = -(-steps // CHECKPOINT)
    has = np.arange(STEPS // CHECKPOINT) < marks[:, None]
    ids32 = ids.astype("<u4")
    sums = [zlib.crc32(ids32[b * BLOCK:(b + 1) * BLOCK].tobytes()) for b in range(blocks)]
    table = zlib.compress(np.concatenate((np.diff(symbols.astype("<i8"), prepend=0), f)).astype("<u4").tobytes(), 1)
    return b"".join((
        HEAD.pack(MAGIC, blocks, n, len(symbols), len(table)), table, np.array(sums, "<u4").tobytes(), per_step.sum(axis=1).astype("<u4").tobytes(),
        before[:, ::CHECKPOINT][has].astype("<u4").tobytes(), kept[has].astype("<u8").tobytes(), words[out].astype("<u4").tobytes()))


def decode(segment: bytes) -> np.ndarray:
    """All ids of a segment, as uint32; CorruptSegment if they can't be those that were written."""
    try:
        return _decode(segment)
    except (struct.error, zlib.error, ValueError, IndexError) as e:
        raise CorruptSegment(str(e)) from e


def _decode(segment: bytes) -> np.ndarray:
    magic, blocks, n, n_symbols, n_table = HEAD.unpack_from(segment)
    if magic != MAGIC or blocks != -(-n // BLOCK):
        raise ValueError("not a segment")
    if not n:
        return np.empty(0, np.uint32)
    at = HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(segment, kind, count, at)
        at += a.nbytes
        return a

    table = np.frombuffer(zlib.decompress(take("u1", n_table).tobytes()), "<u4")
    symbols, f = np.cumsum(table[:n_symbols], dtype=np.int64).astype(np.uint32), table[n_symbols:].astype(U)
    if int(f.sum()) != 1 << SCALE:
        raise ValueError("frequencies don't add up")
    cum = np.cumsum(f) - f
    _, steps = _steps(n)
    marks = -(-steps // CHECKPOINT)
    sums, n_words = take("<u4", blocks), take("<u4", blocks).astype(np.int64)
    places, states = take("<u4", int(marks.sum())).astype(np.int64), take("<u8", int(marks.sum()) * LANES).reshape(-1, LANES)
    words = take("<u4", int(n_words.sum()))

    # units: a checkpoint and the steps up to the next; whole ones and the last, shorter one
    block = np.repeat(np.arange(blocks), marks)
    mark = np.arange(len(block)) - np.repeat(np.cumsum(marks) - marks, marks)
    length = np.minimum(steps[block] - mark * CHECKPOINT, CHECKPOINT)
    at_word = (np.cumsum(n_words) - n_words)[block] + places
    symbol_of = np.repeat(np.arange(n_symbols, dtype=np.int32), f.astype(np.int64))
    x = states.astype(U)
    grid = np.zeros((len(block), CHECKPOINT, LANES), np.int32)
    padded = np.concatenate((words, np.zeros(LANES, np.uint32)))
    for t in range(CHECKPOINT):
        live = len(block) if t < length[-1] else len(block) - 1
        if not live:
            break
        slot = x[:live] & (M - U(1))
        s = symbol_of[slot.view(np.int64)]
        grid[:live, t] = s
        y = x[:live] >> U(SCALE)
        y *= f[s]
        y += slot
        y -= cum[s]
        need = y < LOW
        row, lane = np.nonzero(need)  # in stream order: by unit, then by lane
        taken = need.sum(axis=1)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
        y[row, lane] = (y[row, lane] << U(32)) | padded[np.minimum(at_word[row] + nth, len(padded) - 1)]
        x[:live] = y
        at_word[:live] += taken
    # a run of steps ends in the next checkpoint's states, a block's last one in those it was begun with
    ends = np.full_like(states, LOW)
    inner = np.flatnonzero(block[1:] == block[:-1])
    ends[inner] = states[inner + 1]
    if not np.array_equal(x, ends):
        raise ValueError("the coded words don't lead from checkpoint to checkpoint")
    ids = np.empty(blocks * BLOCK, np.uint32).reshape(blocks, STEPS // CHECKPOINT, CHECKPOINT * LANES)
    ids[block, mark] = symbols[grid].reshape(len(block), -1)
    ids = ids.reshape(-1)[:n]
    for b in range(blocks):
        if zlib.crc32(ids[b * BLOCK:(b + 1) * BLOCK].astype("<u4").tobytes()) != sums[b]:
            raise ValueError(f"block {b} fails its checksum")
    return ids
