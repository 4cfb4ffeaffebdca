"""Alignment of two tokenizers' tokens: a byte-level one (A) and a SentencePiece one (B).

A reads a space and the text, B the text, before which it puts the space itself. Bytes at which
tokens of both end cut the tokens into groups. The library's character offsets of A and the proto
spans of B are the coarse cuts; where several tokens share a character, as a part of its bytes
or as B's byte pieces, spans stand for the whole character, and the ends inside it are
those of the tokens' decoded bytes.

Text between two spaces that follow a non-blank has the tokens it has alone in both, so a worker
aligns each distinct piece of text once and keeps the result; the new pieces of some hundred
documents are tokenised as one text and aligned with numpy. Tokens of a group are linked, each with each: what counts is how many
documents hold two ids linked. A task sums its documents' pairs before they are shuffled; the counts
become sorted arrays in the shared folder, which workers map and search, so no worker holds them
all. Documents are tokenised once, and their pairs staged between the two steps. The arrays need a
folder that all machines have mounted; a task that runs again writes the same file again, in one move.

Defined cases: null and empty texts have no tokens, as have texts that either tokenizer does not give
back whole (a text with the sign that B writes for a space, for one); they are all zeros, and their
groups are ''. Repeated rows and ids count row by row; very long texts are read whole; a table
without rows gives none; columns that are not named are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import mounted, shared_path, stage
from folio.llm.token_files import BYTE_CHARS

MARK = "▁"            # stands for a space in B's pieces (fixed by the model format)
KEPT = 500_000        # distinct pieces of text that a worker keeps
LONG = 400            # characters of a piece that is not kept
PAIRS_HELD = 4 << 20  # pairs that a task gathers before it sums them
_SLICE = 256          # documents that are Python strings at a time
_SLICE_CHARS = 1 << 21
# Cut before a space that follows a non-blank: neither tokenizer has a token across it
_PIECES = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*").findall
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, ends array<int>, pairs array<long>, times array<int>"


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError(f"{a_path}: a byte-level tokenizer without normaliser and prefix is needed")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        to_byte = {c: b for b, c in enumerate(BYTE_CHARS)}
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or []}
        entries = {i: e for e, i in self.a.get_vocab().items()}
        self.n_a = max(entries) + 1
        self.a_bytes = [special[i] if i in special else bytes(to_byte[c] for c in entries.get(i, "")) for i in range(self.n_a)]
        self.b = SentencePieceProcessor(model_file=b_path)
        if self.b.normalize("ﬁ Ａ  x") != MARK + "ﬁ" + MARK + "Ａ" + MARK * 2 + "x":
            raise ValueError(f"{b_path}: its normaliser changes texts")
        self.n_b = self.b.vocab_size()
        names = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.space = self.b.piece_to_id(MARK)
        self.a_size, self.b_size = (np.array([len(x) for x in raw], np.int64) for raw in (self.a_bytes, self.b_bytes))
        # each id as text, with what can follow it
        self.a_text, self.b_text = ([f"{i}{c}" for i in range(n) for c in ends] for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")))
        self.cut = (spec.get("post_processor") or pre).get("type") == "ByteLevel" and pre.get("use_regex", True) and not any(MARK in p.lstrip(MARK) for p in names)

    def pieces(self, text: str) -> list[str]:
        return _PIECES(" " + text) if self.cut else [" " + text]

    def both(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """A's ids, their end bytes, B's ids, their end bytes in a text that begins with a space; None
        where the tokens' bytes are not the text's."""
        found = self.a.encode(text, add_special_tokens=False)
        a_ids, raw = found.ids, text.encode()
        spans = [(t.id, t.end) for t in self.b.encode(text[1:], return_type="proto").pieces] or [(self.space, 0)]
        b_ids = [i for i, _ in spans]
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != raw or b"".join(map(self.b_bytes.__getitem__, b_ids)) != raw:
            return None
        a_ids, b_ids = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends = np.array([end for _, end in found.offsets], np.int64)
        if len(raw) != len(text):  # characters before bytes
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            a_ends = np.concatenate(([0], np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))))[a_ends]
        b_ends = np.array([end for _, end in spans], np.int64) + 1  # the space that B adds
        return a_ids, _refined(a_ends, self.a_size[a_ids]), b_ids, _refined(b_ends, self.b_size[b_ids])


def _refined(ends: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ends of spans; of those that share a character with the next or the last one, by decoded bytes."""
    shared = np.zeros(len(ends), bool)
    shared[:-1] = ends[:-1] >= ends[1:]
    shared[1:] |= ends[1:] <= ends[:-1]
    start = np.concatenate(([0], ends[:-1]))
    shared |= ends - start != size  # also a byte piece whose span is empty because a later one has it
    return np.where(shared, np.cumsum(size), ends)


class Aligned:
    """What is known of pieces: their groups as text, and as arrays their counts, ends and linked pairs."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 5), np.int64)  # A's tokens, B's tokens, groups, links; 1 if not whole
        self.uses = np.zeros(0, np.int64)
        self.pairs, self.ends = _Ragged(2), _Ragged(1)

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces; those that no blank ends stand apart in one text as they do alone."""
        apart = [p for p in pieces if not p[-1].isspace() and MARK not in p and len(p) <= LONG]
        if self.tokenizers.cut and len(apart) > 1:
            found = self.tokenizers.both("".join(apart))
            if found is not None:
                self._add(apart, *found)
                pieces = [p for p in pieces if p[-1].isspace() or MARK in p or len(p) > LONG]
        for p in pieces:
            self._add([p], *(self.tokenizers.both(p) or [None] * 4))

    def _add(self, pieces: list[str], a_ids, a_ends, b_ids, b_ends) -> None:
        """Keep the groups of pieces that stand one after the other; of none if there are no ids."""
        n = len(pieces)
        self.index.update(zip(pieces, range(len(self.uses), len(self.uses) + n)))
        self.uses = np.concatenate((self.uses, np.zeros(n, np.int64)))
        if a_ids is None:
            self.groups += [""] * n
            self.counts = np.concatenate((self.counts, np.array([[0, 0, 0, 0, 1]] * n, np.int64)))
            self.pairs.add(np.zeros((0, 2), np.int64), np.zeros(n, np.int64))
            self.ends.add(np.zeros((0, 1), np.int64), np.zeros(n, np.int64))
            return
        last = np.cumsum(np.fromiter((len(p.encode()) for p in pieces), np.int64, n))
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        piece = np.searchsorted(last, cuts)
        n_a, n_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        counts = np.zeros((n, 5), np.int64)
        for c, weight in enumerate((n_a, n_b, np.ones(len(cuts)), n_a * n_b)):
            counts[:, c] = np.bincount(piece, weight, n)
        self.counts = np.concatenate((self.counts, counts))
        self.ends.add((cuts - np.concatenate(([0], last[:-1]))[piece])[:, None], counts[:, 2])
        self._add_text(n, piece, a_ids, a_group, b_ids, b_group)
        self._add_pairs(n, piece, n_a, n_b, a_ids, a_group, b_ids, b_group)

    def _add_text(self, n: int, piece, a_ids, a_group, b_ids, b_group) -> None:
        """Each piece's groups as text, every one closed by a semicolon."""
        texts, which = [], []
        for ids, group, table in ((a_ids, a_group, self.tokenizers.a_text), (b_ids, b_group, self.tokenizers.b_text)):
            ends = np.append(group[1:] != group[:-1], True)
            texts += map(table.__getitem__, (2 * ids + ends).tolist())
            which.append(group)
        order = np.argsort(np.concatenate((2 * which[0], 2 * which[1] + 1)), kind="stable")
        texts = list(map(texts.__getitem__, order.tolist()))
        at = np.concatenate(([0], np.cumsum(np.bincount(piece[np.concatenate(which)], minlength=n)))).tolist()
        self.groups += ["".join(texts[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]

    def _add_pairs(self, n: int, piece, n_a, n_b, a_ids, a_group, b_ids, b_group) -> None:
        """Each piece's linked pairs with their times: of small groups all of them, of large ones by distinct ids."""
        b_start = np.cumsum(n_b) - n_b
        small = (n_a * n_b <= 4096)[a_group]
        left, times = a_ids[small], n_b[a_group[small]]
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        right = b_ids[np.repeat(b_start[a_group[small]], times) + step]
        wide = self.tokenizers.n_a * self.tokenizers.n_b
        key = np.repeat(piece[a_group[small]], times) * wide + np.repeat(left, times) * self.tokenizers.n_b + right
        weight = np.ones(len(key), np.int64)
        for g in np.flatnonzero(n_a * n_b > 4096).tolist():
            (x, x_times), (y, y_times) = (np.unique(i[k == g], return_counts=True) for i, k in ((a_ids, a_group), (b_ids, b_group)))
            key = np.concatenate((key, (piece[g] * wide + x[:, None] * self.tokenizers.n_b + y).ravel()))
            weight = np.concatenate((weight, (x_times[:, None] * y_times).ravel()))
        key, weight = _sums(key, weight)
        of, pair = np.divmod(key, wide)
        self.pairs.add(np.stack((pair, weight), axis=1), np.bincount(of, minlength=n))

    def forget(self) -> None:
        """Keep what was met most often, up to half of KEPT; pieces met once and long ones go."""
        names = list(self.index)
        often = np.flatnonzero((self.uses > 1) & (np.fromiter(map(len, names), np.int64, len(names)) <= LONG))
        keep = np.sort(often[np.argsort(-self.uses[often], kind="stable")[:KEPT // 2]])
        self.index = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.groups = [self.groups[i] for i in keep.tolist()]
        self.counts, self.uses = self.counts[keep], self.uses[keep] >> 1
        self.pairs.keep(keep)
        self.ends.keep(keep)

    def documents(self, texts: list[str], spans: bool) -> tuple[np.ndarray, list[str], list, list, list]:
        """Of each text: counts, groups, their end bytes, and its linked pairs with their times."""
        if len(self.index) > KEPT:
            self.forget()
        parts, sizes = [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                own = self.tokenizers.pieces(t)
                sizes[k] = len(own)
                parts += own
        new = list(set(parts).difference(self.index))
        if new:
            self.learn(new)
        which = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
        doc = np.repeat(np.arange(len(texts)), sizes)
        counts = np.zeros((len(texts), 5), np.int64)
        for c in range(5):
            counts[:, c] = np.bincount(doc, self.counts[which, c], len(texts))
        self.uses += np.bincount(which, minlength=len(self.uses))
        whole = counts[:, 4] == 0
        counts[~whole] = 0
        names, at = list(map(self.groups.__getitem__, which.tolist())), np.concatenate(([0], np.cumsum(sizes))).tolist()
        groups = ["".join(names[at[k]:at[k + 1]])[:-1] if whole[k] else "" for k in range(len(texts))]
        ends = [self._ends(parts[at[k]:at[k + 1]], which[at[k]:at[k + 1]]) if whole[k] else [] for k in range(len(texts))] if spans else [None] * len(texts)
        part, times = np.unique(doc * len(self.uses) + which, return_counts=True)
        doc, part = np.divmod(part, max(1, len(self.uses)))
        fine = whole[doc]
        doc, part, times = doc[fine], part[fine], times[fine]
        rows, per = self.pairs.take(part)
        wide = self.tokenizers.n_a * self.tokenizers.n_b
        key = np.repeat(doc, per) * wide + rows[:, 0]
        times = np.repeat(times, per) * rows[:, 1]
        order = np.argsort(key)
        key, times = key[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        times = np.add.reduceat(times, first) if len(key) else times
        doc, pair = np.divmod(key[first], wide)
        at = np.searchsorted(doc, np.arange(len(texts) + 1))
        return counts, groups, ends, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(pair, pa.int64())), pa.ListArray.from_arrays(
            pa.array(at, pa.int32()), pa.array(times, pa.int32()))

    def _ends(self, parts: list[str], which: np.ndarray) -> list[int]:
        rows, per = self.ends.take(which)
        size = np.array([len(p.encode()) for p in parts], np.int64)
        return (rows[:, 0] + np.repeat(np.cumsum(size) - size, per)).tolist()


def _sums(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of ``n`` by them."""
    if not len(key):
        return key, n
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n, first)


class _Ragged:
    """Rows of several numbers each, some to an entry."""

    def __init__(self, width: int):
        self.rows, self.count = np.zeros((0, width), np.int64), np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, count: np.ndarray) -> None:
        self.rows, self.count = np.concatenate((self.rows, rows)), np.concatenate((self.count, count))
        self.start = np.cumsum(self.count) - self.count

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of these entries one after the other, and how many each has."""
        count = self.count[which]
        at = np.arange(int(count.sum())) + np.repeat(self.start[which] - (np.cumsum(count) - count), count)
        return self.rows[at], count

    def keep(self, which: np.ndarray) -> None:
        self.rows, self.count = self.take(which)
        self.start = np.cumsum(self.count) - self.count


@lru_cache(maxsize=1)
def _aligned(a_path: str, b_path: str) -> Aligned:
    return Aligned(Tokenizers(a_path, b_path))


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about _SLICE_CHARS; a longer one comes alone."""
    lo = size = 0
    for k, t in enumerate(texts):
        if k > lo and size + len(t) > _SLICE_CHARS:
            yield lo, k
            lo, size = k, 0
        size += len(t)
    if texts:
        yield lo, len(texts)


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """Each document's tokens in groups: (doc_id, n_a, n_b, n_groups, n_links, groups, ends, pairs, times).

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of A and B in order; ``ends`` (with ``spans``) the end byte
    of each group in a space and the text; ``pairs`` the linked pairs, A's id times B's size plus B's
    id, and ``times`` how many links each is. ``a_path``, ``b_path``: files that every worker can open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _aligned(a_path, b_path)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(at, _SLICE)
                texts = [t or "" for t in rows.column(1).to_pylist()]
                for lo, hi in _slices(texts):
                    counts, groups, ends, pairs, times = aligned.documents(texts[lo:hi], spans)
                    yield pa.RecordBatch.from_arrays([
                        rows.column(0).slice(lo, hi - lo), *[pa.array(counts[:, c]) for c in range(4)], pa.array(groups, pa.string()),
                        pa.array(ends, pa.list_(pa.int32())), pairs, times], names=[c.split()[0] for c in ALIGNED.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ALIGNED)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, n, held, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def out():
        for lo in range(0, len(key), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + (1 << 17)]), pa.array(n[lo:lo + (1 << 17)])], names=["pair", "docs"])

    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            own = batch.column(0).slice(lo, 1024).flatten().to_numpy(zero_copy_only=False)
            held.append(own)
            size += len(own)
            if size >= PAIRS_HELD:
                key, n = _sums(np.concatenate([key, *held]), np.concatenate([n, np.ones(size, np.int64)]))
                held, size = [], 0
                if len(key) >= PAIRS_HELD:
                    yield from out()
                    key, n = key[:0], n[:0]
    if size:
        key, n = _sums(np.concatenate([key, *held]), np.concatenate([n, np.ones(size, np.int64)]))
    yield from out()


def _write_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            key, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            name = f"{TaskContext.get().partitionId()}.npy"
            temporary = os.path.join(path, f".{name}-{os.getpid()}-{os.urandom(4).hex()}")
            with open(temporary, "wb") as f:
                np.save(f, np.stack((key, n)))
            os.replace(temporary, os.path.join(path, name))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array(key[:1])], names=["name", "low"])

    return run


@lru_cache(maxsize=2)
def _mapped(path: str, names: tuple[str, ...]) -> list[np.ndarray]:
    return [np.load(os.path.join(path, n), mmap_mode="r") for n in names]


def _find(arrays: list[np.ndarray], lows: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Counts of sorted keys, all of which the arrays hold."""
    out = np.zeros(len(key), np.int64)
    cut = np.append(np.searchsorted(key, lows), len(key))
    for array, lo, hi in zip(arrays, cut[:-1].tolist(), cut[1:].tolist()):
        if hi > lo:
            out[lo:hi] = array[1][np.searchsorted(array[0], key[lo:hi])]
    return out


def _score_task(path: str, names: tuple[str, ...], lows: np.ndarray, best: np.ndarray, n_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _mapped(path, names)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                rows = batch.slice(lo, 1024)
                pairs, times = rows.column(rows.schema.get_field_index("pairs")), rows.column(rows.schema.get_field_index("times"))
                size = np.diff(pairs.offsets.to_numpy())
                key, times = pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                unique, at = np.unique(key, return_inverse=True)
                count = _find(arrays, lows, unique)
                top = count == best[unique // n_b]
                ends = np.cumsum(size)
                sums = [np.diff(np.concatenate(([0], np.cumsum(v)))[np.concatenate(([0], ends))]) for v in (times * top[at], times * count[at])]
                keep = [rows.column(c) for c in range(rows.num_columns) if rows.schema.names[c] not in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays([*keep, *map(pa.array, sums)], names=[c for c in rows.schema.names if c not in ("pairs", "times")] + ["n_best", "count_sum"])

    return run


def score_links(aligned: DataFrame, n_b: int, path: str | None = None) -> DataFrame:
    """``aligned`` (a staged table with ``pairs`` and ``times``) with, instead of these, ``n_best`` and
    ``count_sum``: the links whose documents are the most that their A id has, and all links' documents."""
    spark = aligned.sparkSession
    path = mounted(path or shared_path(spark, "pair-counts"))
    os.makedirs(path, exist_ok=True)
    counts = aligned.select("pairs").mapInArrow(_count_task, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = stage(counts, "pairs")
    ordered = counts.repartitionByRange("pair").sortWithinPartitions("pair")
    files = stage(ordered.mapInArrow(_write_task(path), "name string, low long"), "pair-files").orderBy("low").collect()  # a row a file
    tops = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("docs").alias("docs")).collect()  # a row an id of A's vocabulary
    best = np.zeros(max((r["a"] for r in tops), default=0) + 1, np.int64)
    for r in tops:
        best[r["a"]] = r["docs"]
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_best long", "count_sum long"])
    return aligned.mapInArrow(_score_task(path, tuple(r["name"] for r in files), np.array([r["low"] for r in files], np.int64), best, n_b), schema)


def vocabulary_size(path: str) -> int:
    """Ids of a SentencePiece model."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).vocab_size()
