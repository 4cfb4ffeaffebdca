"""Exact top-k inner products by columnar branch and bound.

Vectors become integers, floor(scale * x), kept as columns: one array per dimension. Candidates are
dealt to shards of about ``SHARD`` vectors; every shard meets all queries, block by block, and
gives each query its k best; a ranking over the shards' bests ends the search.

In a shard a query's products grow dimension block by dimension block. What the dimensions left can still
add is at most the product of both vectors' norms over them (Cauchy-Schwarz). A few promising
candidates are finished first, and their k-th best product is the bar: candidates whose sum
plus bound stays below it are dropped, and the rest is compacted once it is small enough.

Sums are exact: in doubles while all products fit 2**52, else in Python integers.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no part, nor
do null ids; vectors of different lengths are compared as if the shorter had zeros; fewer than k
candidates are all returned; ties go to the smaller id; all rows with a query's id are left out
of its candidates; rows that repeat a candidate's id compete one by one; of a query's
repeated rows the least vector asks; scores beyond 64 bits are clipped to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import stage

SHARD = 8192           # candidates that a query is compared with at a time
QUERY_BLOCK = 512
DIMS = 8               # dimensions added between two looks at the bounds
EXACT = 2.0 ** 52
BLOCKS = "shard int, asks int, dims int, ids binary, data binary"


def integers(col: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which rows take part, their lengths, all their components as whole doubles)."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy().astype(np.int64)
    flat = pc.list_flatten(col)
    values = np.floor(scale * pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ends = np.cumsum(size)
    good = (size > 0) & (bad[ends] == bad[ends - size])
    return good, size[good], values[np.repeat(good, size)]


def _pack_task(scale: float, block: int, asks: bool):
    """Vectors (shard, id, embedding), sorted by shard, as blocks of one shard in columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        n, of = 0, None

        def flush() -> pa.RecordBatch:
            dims = max(int(s.max()) for _, s, _ in held)
            ids = np.concatenate([i for i, _, _ in held])
            data, at = np.zeros((len(ids), dims)), 0
            for _, s, v in held:
                row = np.repeat(np.arange(at, at + len(s)), s)
                data[row, np.arange(len(v)) - np.repeat(np.cumsum(s) - s, s)] = v
                at += len(s)
            return pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([int(asks)], pa.int32()), pa.array([dims], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                                               pa.array([np.ascontiguousarray(data.T).tobytes()], pa.binary())], names=["shard", "asks", "dims", "ids", "data"])

        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(shards)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)]):
                while lo < hi:
                    if held and (shards[lo] != of or n >= block):
                        yield flush()
                        held, n = [], 0
                    of = int(shards[lo])
                    rows = batch.slice(lo, min(hi - lo, block - n))
                    good, size, values = integers(rows.column(2), scale)
                    if len(size):
                        held.append((rows.column(1).to_numpy()[good], size, values))
                        n += len(size)
                    lo += rows.num_rows
        if held:
            yield flush()

    return run


class Columns:
    """A shard's candidates by dimension, with the norm of what is left after each block of dimensions."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]]):
        dims = max(d.shape[0] for _, d in blocks)
        self.ids = np.concatenate([i for i, _ in blocks])
        self.data = np.concatenate([np.pad(d, ((0, dims - d.shape[0]), (0, 0))) for _, d in blocks], axis=1)
        self.left = _norms_left(self.data)
        self.largest = float(np.abs(self.data).max())

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, products) of the k best candidates, ties to smaller ids."""
        d = min(len(query), self.data.shape[0])
        query = query[:d]
        if self.largest * float(np.abs(query).max()) * d >= EXACT:
            return self._exactly(query, own, k)
        rest = _norms_left(query[:, None])[:, 0]
        part = query[:DIMS] @ self.data[:min(DIMS, d)]
        part[self.ids == own] = -np.inf
        n_others = int((self.ids != own).sum())
        bar = -np.inf
        if n_others > 4 * k:
            probe = np.argpartition(-part, 4 * k)[:4 * k]
            probe = probe[self.ids[probe] != own]
            bar = np.partition(query @ self.data[:d, probe], len(probe) - k)[len(probe) - k]
        at = None  # all candidates
        for b in range(1, -(-d // DIMS)):
            bound = part + rest[b] * (self.left[b] if at is None else self.left[b][at])
            live = bound * (1 + 1e-12) + 1 >= bar
            if live.sum() < 0.7 * len(live):
                keep = np.flatnonzero(live)
                at, part = (keep if at is None else at[keep]), part[keep]
            block = self.data[b * DIMS:min(d, (b + 1) * DIMS)]
            part += query[b * DIMS:(b + 1) * DIMS] @ (block if at is None else block[:, at])
        return _top(self.ids if at is None else self.ids[at], part, own, k)

    def _exactly(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        q = [int(v) for v in query]
        scores = np.array([sum(a * int(b) for a, b in zip(q, c)) for c in self.data[:len(q)].T], dtype=object)
        scores = np.clip(scores, -(1 << 63), (1 << 63) - 1)
        other = np.flatnonzero(self.ids != own)
        chosen = sorted(other, key=lambda i: (-scores[i], self.ids[i]))[:k]
        return self.ids[chosen], np.array([scores[i] for i in chosen], np.int64)


def _norms_left(data: np.ndarray) -> np.ndarray:
    """Norm of each column over the dimensions from each block on."""
    squares = np.add.reduceat(data * data, np.arange(0, data.shape[0], DIMS), axis=0)
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])


def _top(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    other = np.flatnonzero(ids != own)
    if len(other) > k:
        kth = np.partition(scores[other], len(other) - k)[len(other) - k]
        other = other[scores[other] >= kth]
    order = other[np.lexsort((ids[other], -scores[other]))][:k]
    return ids[order], scores[order].astype(np.int64)


def _search_task(k: int):
    """Blocks sorted by (shard, asks): a shard's candidates, then the queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, columns, of = [], None, None
        for batch in batches:
            for i in range(batch.num_rows):
                shard, asks, dims = (batch.column(j)[i].as_py() for j in range(3))
                ids = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
                data = np.frombuffer(batch.column(4)[i].as_buffer(), np.float64).reshape(dims, len(ids))
                if shard != of:
                    blocks, columns, of = [], None, shard
                if not asks:
                    blocks.append((ids.copy(), data.copy()))
                    continue
                if not blocks:
                    continue
                columns = columns or Columns(blocks)
                found = [columns.best(data[:, q], int(ids[q]), k) for q in range(len(ids))]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])),
                                                  pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates of ``vectors`` other than itself."""
    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("embedding")).where("id IS NOT NULL AND embedding IS NOT NULL")

    candidates, asking = named(vectors), named(queries).groupBy("id").agg(F.min("embedding").alias("embedding"))
    shards = max(1, -(-vectors.count() // shard))
    dealt = candidates.select(F.pmod(F.xxhash64("id", "embedding"), F.lit(shards)).cast("int").alias("shard"), "id", "embedding")
    packed = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(_pack_task(scale, shard, False), BLOCKS)
    batches = stage(asking.select(F.lit(0).alias("shard"), "id", "embedding").mapInArrow(_pack_task(scale, QUERY_BLOCK, True), BLOCKS), "topk-queries")
    everywhere = batches.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "asks", "dims", "ids", "data")
    found = packed.union(everywhere).repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(_search_task(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
