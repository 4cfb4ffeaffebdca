"""Vector rows and exact nearest-neighbour search.

``vector_search`` scores every stored vector against a block of query vectors inside
``mapInPandas`` (one numpy matrix product per Arrow batch), keeps a partial top-k per
query per batch, and merges the partials with a window over (query, candidate) rows
whose number is bounded by batches x queries x k. The query block is broadcast only
after its row count is checked against ``max_queries``; larger query sets are cut into
blocks of that size, each one more distributed pass over the vectors. No pair table is
ever materialised.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.filters import filter_errors


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def cosine_similarity(a, b) -> Column:
    """Cosine of the angle between two vectors (array columns); null for a zero vector."""
    na = F.sqrt(dot(a, a))
    nb = F.sqrt(dot(b, b))
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def l2_squared(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) ** 2),
                       F.lit(0.0), lambda acc, v: acc + v)


def vector_search(vectors: DataFrame, queries: DataFrame, k: int = 10, metric: str = "l2",
                  id_col: str = "pk", vector_col: str = "vector", query_id_col: str = "query_id",
                  query_vector_col: str = "query", max_queries: int = 4096) -> DataFrame:
    """Top-k stored vectors per query: query_id, rank (1..k), pk, score (squared L2,
    smaller is nearer; or cosine / inner product, larger is nearer). Ties -> smaller pk.

    Vectors that are null, hold nulls or numbers that are not finite, or have another length than most
    queries, take no part on either side; a null id is left out. Ids keep their own types."""
    if metric not in ("l2", "cosine", "ip"):
        raise ValueError("metric must be l2, cosine or ip")
    queries = _whole(queries.select(query_id_col, query_vector_col), query_id_col, query_vector_col)
    sizes = queries.groupBy(F.size(query_vector_col).alias("d")).count().collect()  # a row a length
    n_q = sum(r["count"] for r in sizes)  # size check before anything is broadcast
    if n_q == 0:
        kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((queries, query_id_col), (vectors, id_col))}
        return vectors.sparkSession.createDataFrame(
            [], f"`{query_id_col}` {kinds[query_id_col]}, rank int, `{id_col}` {kinds[id_col]}, score double")
    length = max(sizes, key=lambda r: (r["count"], -r["d"]))["d"]
    queries = queries.where(F.size(query_vector_col) == length)
    vectors = vectors.where(F.col(id_col).isNotNull() & (F.size(vector_col) == length))
    blocks = []
    if n_q <= max_queries:
        blocks.append(queries)
    else:
        nb = -(-n_q // max_queries)
        qb = queries.withColumn("_qb", F.abs(F.xxhash64(query_id_col)) % nb)
        blocks = [qb.where(F.col("_qb") == i).drop("_qb") for i in range(nb)]
    outs = [_search_block(vectors, b, k, metric, id_col, vector_col, query_id_col, query_vector_col)
            for b in blocks]
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _whole(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with an id and a vector of finite numbers."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & ~F.coalesce(bad, F.lit(True)))


def _squared_distances(v: np.ndarray, q: np.ndarray, rows: np.ndarray, cols: np.ndarray, step: int = 4096) -> np.ndarray:
    """Squared distance of the pairs (v[rows], q[cols]), ``step`` pairs at a time."""
    out = np.empty(len(rows))
    for lo in range(0, len(rows), step):
        d = v[rows[lo:lo + step]] - q[cols[lo:lo + step]]
        out[lo:lo + step] = (d * d).sum(axis=1)
    return out


def _search_block(vectors, queries, k, metric, id_col, vector_col, qid, qvec):
    spark = vectors.sparkSession
    rows = queries.select(qid, qvec).collect()  # bounded by max_queries (checked above)
    q_ids = pd.Series([r[0] for r in rows]).to_numpy()
    q_mat = np.array([np.asarray(r[1], dtype=np.float64) for r in rows])
    bc = spark.sparkContext.broadcast((q_ids, q_mat))
    larger_better = metric != "l2"

    def score(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, qm = bc.value
        qn = (qm * qm).sum(axis=1)
        if metric == "cosine":
            qm_unit = qm / np.where(qn > 0, np.sqrt(qn), 1.0)[:, None]
        for pdf in it:
            if pdf.empty:
                continue
            v = np.stack([np.asarray(x, dtype=np.float64) for x in pdf[vector_col].to_numpy()])
            whole = np.isfinite(v).all(axis=1)  # a null inside is not a number here
            v, pk = v[whole], pdf[id_col].to_numpy()[whole]
            if not len(v):
                continue
            if metric == "l2":
                squares = (v * v).sum(axis=1)[:, None] + qn[None, :]
                s = squares - 2.0 * (v @ qm.T)
                slack = (2 * v.shape[1] + 8) * np.finfo(np.float64).eps * squares
            elif metric == "cosine":
                vn = np.sqrt((v * v).sum(axis=1))
                s = (v @ qm_unit.T) / np.where(vn > 0, vn, 1.0)[:, None]
            else:
                s = v @ qm.T
            kk = min(k, len(pk))
            key = -s if larger_better else s
            if metric != "l2":
                slack = 0.0
            # partial top-k per query column, keeping every tie at the k-th score so the
            # final (score, pk) order is exact; the expanded square loses digits for near-equal
            # vectors, so all that its rounding could hide are kept and measured directly
            kth = np.partition(key + slack, kk - 1, axis=0)[kk - 1]
            rows_, cols = np.nonzero(key - slack <= kth[None, :])
            found = _squared_distances(v, qm, rows_, cols) if metric == "l2" else s[rows_, cols]
            yield pd.DataFrame({qid: ids[cols], id_col: pk[rows_], "score": found})

    part = vectors.select(id_col, vector_col).mapInPandas(
        score, f"`{qid}` {queries.schema[qid].dataType.simpleString()}, `{id_col}` {vectors.schema[id_col].dataType.simpleString()}, score double")
    order = F.col("score").desc() if larger_better else F.col("score").asc()
    w = Window.partitionBy(qid).orderBy(order, F.col(id_col).asc())
    return (part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                .select(qid, "rank", id_col, "score"))


def select_rag_texts(df: DataFrame) -> DataFrame:
    """Text used for retrieval: text rows -> content, structured rows -> table_content."""
    t = F.col("document_type")
    txt = (F.when(t == "text", F.col("metadata.content"))
           .when(t == "structured", F.col("metadata.table_metadata.table_content")))
    return df.withColumn("rag_text", txt).where(t.isin("text", "structured"))


def to_vector_rows(df: DataFrame, drop_filtered: bool = True) -> DataFrame:
    """Rows for the vector table: optionally drop ``filter=true`` info rows, keep rows
    with embeddings, project vector / text / source (JSON)."""
    d = filter_errors(df) if drop_filtered else df
    has = F.col("_contains_embeddings") if "_contains_embeddings" in df.columns else \
        F.col("metadata.embedding").isNotNull()
    keep = [c for c in ("job_id", "pos", "piece") if c in df.columns]
    # the text that was embedded: a table's content is its image
    text = F.coalesce(F.col("_content"), F.col("metadata.content")) if "_content" in df.columns else F.col("metadata.content")
    return d.where(F.coalesce(has, F.lit(False))).select(
        *keep, F.col("metadata.embedding").alias("vector"), text.alias("text"),
        F.to_json(F.col("metadata.source_metadata")).alias("source"))
