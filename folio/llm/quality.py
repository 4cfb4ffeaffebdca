"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts, as vector operations over the bytes of many documents. The
trees are grown from histograms of binned statistics on a bounded sample of labelled
documents (``SAMPLE`` of them, those of least hash) and flattened into arrays: all trees have one
depth, node i's children are 2i + 1 and 2i + 2, so a batch walks a tree in a few gathers.

Defined cases: null text is empty; an empty text has all statistics 0 and a score like any
other; a null id is not held out; labels that contradict each other or are null are not
learned from; without labels, or with one class only, every score is the smoothed share of
class 1; repeated rows score one by one; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import crc_mod
from folio.llm.textnum import chunks, grams, word_bounds, word_hashes

SAMPLE = 20_000      # labelled documents that the trees are grown on, at most
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_HESSIAN = 60, 4, 64, 0.2, 1.0, 2.0
KEEP_FROM = 0.7
U = np.uint64

# classes of bytes that are counted
_CLASSES = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": [32], "line": [10], "blank": [9, 11, 12, 13], "stop": b".,;:",
            "loud": b"!?", "symbol": b"#*$%&|<>", "bracket": b"()[]{}\"'`", "control": [*range(9), *range(14, 32), 127], "follow": range(128, 192), "lead": range(192, 256)}
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS[list(_bytes)] = _i
STATISTICS = [*[f"share_{c}" for c in (*_CLASSES, "other")], "words", "word_length", "word_spread", "short_words", "long_words", "loud_words", "lettered_words", "distinct_words",
              "distinct_triples", "lines", "words_per_line", "distinct_lines", "first_capital"]


def _distinct(key: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Distinct values in each row's run of ``key``."""
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows, dtype=U), np.diff(bounds))
    s = np.sort((row << U(44)) | (key >> U(20)))
    new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.empty(0, bool)
    return np.bincount((s[new] >> U(44)).astype(np.int64), minlength=rows)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each document."""
    rows, size = len(offs) - 1, np.diff(offs)
    kind = _CLASS[buf]
    width = len(_CLASSES) + 1
    counts = np.bincount(np.repeat(np.arange(rows), size) * width + kind, minlength=rows * width).reshape(rows, width).astype(np.float64)
    chars = np.maximum(size - counts[:, list(_CLASSES).index("follow")], 1.0)
    starts, ends, first = word_bounds(buf, offs)
    n = np.diff(first)
    some = np.maximum(n, 1).astype(np.float64)
    h = word_hashes(buf, starts, ends) if len(starts) else np.empty(0, U)
    length = (ends - starts).astype(np.float64)
    upper = np.concatenate(([0], np.cumsum(kind == 1)))
    letters = np.concatenate(([0], np.cumsum((kind <= 1) | (kind >= 11))))
    capitals = upper[ends] - upper[starts]
    mean = _sums(length, first) / some
    variance = np.maximum(_sums(length * length, first) / some - mean * mean, 0.0)
    # triples that cross into the next document are left out by shifting the row bounds
    triples = np.zeros(rows)
    if len(h) >= 3:
        g = grams(h, 3)
        row = np.repeat(np.arange(rows), n)
        inside = row[:len(g)] == row[2:2 + len(g)]
        triples = _distinct(g[inside], np.searchsorted(row[:len(g)][inside], np.arange(rows + 1))).astype(np.float64)
    # lines: what stands between line ends, hashed by the sum of their words' hashes
    breaks = np.concatenate(([0], np.cumsum(buf == 10)))
    line = (breaks[starts] - breaks[offs[:-1]][np.repeat(np.arange(rows), n)]) if len(starts) else np.empty(0, np.int64)
    new_line = np.ones(len(starts), bool)
    new_line[1:] = line[1:] != line[:-1]
    new_line[first[:-1][n > 0]] = True
    at = np.flatnonzero(new_line)
    line_hash = np.add.reduceat(h, at) if len(at) else np.empty(0, U)
    line_bounds = np.searchsorted(at, first)
    lines = np.diff(line_bounds)
    opens = (buf[starts] >= 65) & (buf[starts] < 91) if len(starts) else np.empty(0, bool)
    columns = [*(counts / chars[:, None]).T, np.log1p(n), mean, np.sqrt(variance), _sums(length <= 3, first) / some, _sums(length >= 16, first) / some,
               _sums((capitals > 1) & (2 * capitals > length), first) / some, _sums(letters[ends] - letters[starts] == ends - starts, first) / some,
               _distinct(h, first) / some, triples / np.maximum(n - 2, 1), np.log1p(lines), n / np.maximum(lines, 1),
               _distinct(line_hash, line_bounds) / np.maximum(lines, 1), _sums(opens, first) / some]
    return np.stack(columns, axis=1)


# ---- trees ----------------------------------------------------------------------------------

@dataclass
class Trees:
    """feature, threshold: (trees, inner nodes); value: (trees, leaves); bias: the log odds to start from."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        row = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            total += v[node - inner]
        return 1.0 / (1.0 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boosted trees for labels 0 and 1 by logistic loss."""
    n, n_features = x.shape
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = (y.sum() + 1.0) / (n + 2.0)
    bias = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), bias)
    # bin b holds values up to edges[b]; the last bin all above
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), bias)
    total = np.full(n, bias)
    for k in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, base = 2 ** level, 2 ** level - 1
            best = np.full(width, 1e-9)
            split_bin = np.full(width, bins, np.int64)
            for f in range(n_features):
                cell = (node - base) * bins + binned[:, f]
                left_g = np.cumsum(np.bincount(cell, g, width * bins).reshape(width, bins), axis=1)
                left_h = np.cumsum(np.bincount(cell, h, width * bins).reshape(width, bins), axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE) - all_g ** 2 / (all_h + RIDGE)
                gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
                gain = gain[:, :len(edges[f])]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = np.flatnonzero(top > best)
                best[better], split_bin[better] = top[better], at[better]
                out.feature[k, base + better], out.threshold[k, base + better] = f, edges[f][at[better]]
            here = node - base
            node = 2 * node + 1 + (binned[np.arange(n), out.feature[k, node]] > split_bin[here])
        leaf = node - inner
        out.value[k] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        total += out.value[k][leaf]
    return out


# ---- on documents -----------------------------------------------------------------------------

def _statistics_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in chunks(batch.column(0)):
            x = statistics(buf, offs)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), lists], names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
          folds: int = 4, fold: int = 2, sample: int = SAMPLE) -> Trees:
    """Trees from the labelled documents outside the held-out fold; ``sample`` of them at most."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & (crc_mod(F.col("id"), folds) != fold))
    agreed = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where(F.col("label") == F.col("other")).select("id", "label")
    chosen = agreed.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id")).join(F.broadcast(chosen), "id").select("text", "label")
    rows = texts.mapInArrow(_statistics_task, "label int, x array<double>").limit(2 * sample).toArrow()  # ids that repeat don't lift the bound
    n = rows.num_rows
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(n, len(STATISTICS)) if n else np.empty((0, len(STATISTICS)))
    y = rows.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    return grow(x[order], y[order])


def _score_task(trees: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(0)):
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(trees.score(statistics(buf, offs)))], names=[*rows.schema.names[1:], "score"])

    return run


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col).alias("doc_id"), (crc_mod(F.col(id_col), folds) == fold).alias("held_out"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_score_task(trees), f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def filter_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    trees = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.struct(*docs.columns).alias("row"))

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(0)):
                good = trees.score(statistics(buf, offs)) >= KEEP_FROM
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo).filter(pa.array(good))], names=["row"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}").select("row.*")
