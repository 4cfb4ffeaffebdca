"""Token ids of documents in coded segments, in ascending order of id, and back.

Documents are range-partitioned by id and tokenised in order; a task cuts its tokens into
segments of whole documents (``rans``) and writes each as a row of a Parquet table, with
the ids and token counts of its documents. A reader decodes segments independently, and
takes each document's place among all tokens from sums over segments.

Defined cases: null text is empty, and an empty document holds the end id alone; a null id sorts
first; rows that repeat an id stand next to each other, each on its own; no rows make an empty
table; one document longer than a segment gets one of its own; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import rans
from folio.llm.shared import small_side, stage

SEGMENT_TOKENS = 4 << 20
FILE_SCHEMA = "part int, seq int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, payload binary"
DOC_SCHEMA = "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
_SLICE_BYTES = 8 << 20   # of texts that are cut at a time
_CACHED = 900_000        # distinct pieces of text whose ids a worker keeps
_CACHED_WORDS = 400_000  # pre-tokens, in each of two generations
# Fixed values of byte-level tokenizers: the pattern of their pre-tokens, and the characters that stand for bytes
_PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHER = [b for b in range(256) if b not in _PLAIN]
BYTE_CHARS = "".join(chr(b) if b in _PLAIN else chr(256 + _OTHER.index(b)) for b in range(256))
_BLANK_AFTER_SPACE = r" ([\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"


class WholeTexts:
    """Ids of whole texts by the tokenizers library, asked once for each distinct piece.

    A byte-level pre-tokenizer always cuts before a space that a non-blank follows, so text
    between two such places has the ids it has alone. Pieces are kept with their ids; a new
    one is cut by the library's pattern and the library's model merges what no earlier
    piece had. Where the tokenizer is of another kind, whole texts are given to it.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.cut = (spec.get("normalizer") is None and spec.get("post_processor") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                    and pre.get("use_regex", True) and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec.get("added_tokens") or []))
        self.tokenizer, self.model, self.end_id = Tokenizer.from_file(path), None, end_id
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        # marks that end words, and whether no special token can be in a word with one
        self.marks = {c: self._word(c) for c in ".,!?;:"} if self.cut else {}
        self.plain = not any(t.rstrip(".,!?;:").strip().isalpha() or not t.strip(".,!?;: ") for t in self.special)
        self._clear()

    def _clear(self) -> None:
        self.known: dict = {None: 0}  # None: the end; bytes: a text's first piece; str: one after a space
        self.start, self.count, self.flat = np.zeros(1, np.int64), np.ones(1, np.int64), np.array([self.end_id], np.uint32)
        self.uses = np.zeros(1, np.int64)

    def _forget(self) -> None:
        """Keep the pieces met most often, up to half of _CACHED; those met once go."""
        often = np.flatnonzero(self.uses > 1)
        keep = np.sort(often[np.argsort(-self.uses[often], kind="stable")[:_CACHED // 2]])
        keep = np.concatenate(([0], keep[keep > 0]))
        names = list(self.known)  # in the order of their places
        self.known = {names[i]: k for k, i in enumerate(keep.tolist())}
        count = self.count[keep]
        ends = np.cumsum(count)
        self.flat = self.flat[np.arange(int(ends[-1])) + np.repeat(self.start[keep] - (ends - count), count)]
        self.start, self.count, self.uses = ends - count, count, self.uses[keep] >> 1

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token, 4 bytes each."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.old_words.get(word)
            if ids is None:
                ids = array("I", [t.id for t in self.model.tokenize(charmap_decode(word.encode(), "strict", BYTE_CHARS)[0])]).tobytes()
            if len(self.words) >= _CACHED_WORDS:
                self.old_words, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def _whole(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are not a word, or a word and a mark; where one may hold a special token, by the tokenizer."""
        blob = "\0".join(pieces)
        if any(x in blob for x in self.special):
            return [array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in pieces]
        return [b"".join(map(self._word, _PRE_TOKENS(t))) for t in pieces]

    def _learn(self, pieces: list) -> None:
        found, odd, word = [], [], self._word
        for p in pieces:
            if self.plain and type(p) is str and p.isalpha():
                found.append(word(" " + p))
            elif self.plain and type(p) is str and p[-1:] in self.marks and p[:-1].isalpha():
                found.append(word(" " + p[:-1]) + self.marks[p[-1]])
            else:
                odd.append(len(found))
                found.append(p.decode() if isinstance(p, bytes) else " " + p)
        for i, ids in zip(odd, self._whole([found[i] for i in odd])):
            found[i] = ids
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        self.known.update(zip(pieces, range(len(self.count), len(self.count) + len(pieces))))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(count) - count))
        self.count, self.flat = np.concatenate((self.count, count)), np.concatenate((self.flat, flat))
        self.uses = np.concatenate((self.uses, np.zeros(len(pieces), np.int64)))

    def pieces(self, text: str) -> list:
        """Pieces of a text in which a blank, or the end, follows a space: those stay together."""
        parts = text.split(" ")
        whole = parts[:1]
        for p in parts[1:]:
            if not p or p[0].isspace():
                whole[-1] += " " + p
            else:
                whole.append(p)
        whole[0] = whole[0].encode()
        return whole

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and the count of each.

        Texts are cut, and equal pieces found, by Arrow; Python sees a slice's distinct pieces."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.cut:
            found = [[*e.ids, self.end_id] for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        odd = pc.match_substring_regex(texts, _BLANK_AFTER_SPACE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        flat = split.flatten().dictionary_encode()
        inside, words = flat.indices.to_numpy(), flat.dictionary.to_pylist()
        sizes = np.zeros(len(texts), np.int64)
        sizes[~odd] = np.diff(split.offsets.to_numpy())
        first = np.cumsum(sizes[~odd]) - sizes[~odd]
        heads = [words[i].encode() for i in inside[first].tolist()]
        parts = [self.pieces(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        sizes[odd] = [len(p) for p in parts]
        others = [*heads, *(x for p in parts for x in p)]
        new = list({*words, *others}.difference(self.known))
        if len(self.known) + len(new) > _CACHED:
            self._forget()
            new = list({*words, *others}.difference(self.known))
        if new:
            self._learn(new)
        place = self.known.__getitem__
        plain = np.fromiter(map(place, words), np.int64, len(words))[inside]
        others = np.fromiter(map(place, others), np.int64, len(others))
        plain[first] = others[:len(heads)]
        last = np.cumsum(sizes + 1) - 1
        which = np.zeros(int(last[-1]) + 1, np.int64)  # the end, if nothing else
        row = np.repeat(odd, sizes)
        inner = np.ones(len(which), bool)
        inner[last] = False
        at = np.flatnonzero(inner)
        which[at[~row]], which[at[row]] = plain, others[len(heads):]
        self.uses += np.bincount(which, minlength=len(self.uses))
        count = self.count[which]
        ends = np.cumsum(count)
        at = np.arange(int(ends[-1]))
        at += np.repeat(self.start[which] - (ends - count), count)
        return self.flat[at], np.diff(ends[last], prepend=0)


@lru_cache(maxsize=1)
def _texts(path: str, end_id: int) -> WholeTexts:
    return WholeTexts(path, end_id)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about _SLICE_BYTES of text together; a longer one comes alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + _SLICE_BYTES, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _encode_task(path: str, end_id: int, segment_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, seq = _texts(path, end_id), TaskContext.get().partitionId(), 0
        doc_ids, counts, held, n = [], [], [], 0

        def segment() -> pa.RecordBatch:
            flat, sizes = np.concatenate(held), np.concatenate(counts)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(flat)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())), pa.array([rans.encode(flat)], pa.binary())], names=["part", "seq", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            for rows in _slices(batch):
                ids, sizes = tokenizer.encode(rows.column(1))
                keys, lo_doc, lo_tok = rows.column(0).to_pylist(), 0, 0
                ends = np.cumsum(sizes)
                while lo_doc < len(keys):  # whole documents up to the size of a segment, one at least
                    hi = int(np.searchsorted(ends, lo_tok + segment_tokens - n, side="right"))
                    if hi == lo_doc and not n:
                        hi = lo_doc + 1
                    if hi > lo_doc:
                        held.append(ids[lo_tok:ends[hi - 1]])
                        counts.append(sizes[lo_doc:hi])
                        doc_ids += keys[lo_doc:hi]
                        n += int(ends[hi - 1]) - lo_tok
                        lo_doc, lo_tok = hi, int(ends[hi - 1])
                    if lo_doc < len(keys):
                        yield segment()
                        seq += 1
                        doc_ids, counts, held, n = [], [], [], 0
        if n:
            yield segment()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write all documents' ids to ``path``. ``tokenizer``: a tokenizers file that every worker can open."""
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # rows that share an id are dealt by their texts, equal rows by their numbers
    thin = thin.withColumn("tie", F.monotonically_increasing_id())
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    ordered = thin.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    ordered.mapInArrow(_encode_task(tokenizer, end_id, segment_tokens), FILE_SCHEMA).write.parquet(path)


def _decode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part, seq, _, doc_ids, sizes, payload = (batch.column(i)[row] for i in range(6))
            ids = rans.decode(payload.as_buffer()).astype("<u4")
            sizes = np.array(sizes.as_py(), np.int64)
            ends = np.cumsum(sizes)
            raw = memoryview(ids).cast("B")
            sums = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), sizes.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), doc_ids.values, pa.array(ends - sizes), pa.array(sizes),
                pa.array(sums, pa.int64())], names=["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the decoded ids."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    segments = files.select("part", "seq", "n_tokens")
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens")).select(
        F.col("part").alias("b_part"), F.coalesce(F.sum("part_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("within")).join(parts, F.col("part") == F.col("b_part"))
    places = stage(places.select(F.col("part").alias("s_part"), F.col("seq").alias("s_seq"), (F.col("base") + F.col("within")).alias("segment_start")), "token-places")
    docs = files.mapInArrow(_decode_task, DOC_SCHEMA)
    return docs.join(small_side(places), (F.col("part") == F.col("s_part")) & (F.col("seq") == F.col("s_seq"))).select(
        "doc_id", (F.col("segment_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of each document."""
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids = rans.decode(batch.column(2)[row].as_buffer()).astype(np.int32)
                doc_ids, sizes = batch.column(0)[row].values, np.array(batch.column(1)[row].as_py(), np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([doc_ids, lists], names=["doc_id", "ids"])

    return spark.read.schema(FILE_SCHEMA).parquet(path).select("doc_ids", "doc_tokens", "payload").mapInArrow(run, "doc_id long, ids array<int>")
