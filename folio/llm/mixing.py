"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every source is a queue of its documents in a seeded shuffled order, gone through up to
``max_repeats`` times. An item's virtual finish time is the source's running token count at
the item's end divided by the source's target, so at time 1 every source has given its
target. The mix is the prefix of all items in order of finish time whose tokens fit the
total budget.

Running sums never need one task for a source or for the whole order: documents fall into
equal ranges of their shuffle value and items into equal ranges of finish time; sums of
ranges give each range its base, and only rows inside a range are sorted. The number of
ranges grows with the square root of the rows, the result doesn't depend on it.

Defined cases: null or blank text has size 0 and is never taken; a null source is a source,
the last one; no rows give no rows; rows that repeat an id are items of their own (where
the plan is joined back to documents, they go together); columns other than the named ones
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import WORD, small_side, stage

U_BITS = 60


def shuffle_value(id_col: Column, seed: int) -> Column:
    """A 60-bit value of the seeded shuffle; documents are queued in its order."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, U_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """Target tokens of each source from (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all
    tokens; a target stops at ``max_repeats`` times its source and the excess goes to the others
    by weight. That fixed point is a water level: with the sources in order of cap by weight, it
    is the largest of the levels that result if the first k sources are at their caps.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("source", "source_size", F.row_number().over(by_name).alias("rank"))
    weighed = ranked.select("*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("weight"),
                            (F.col("source_size") * max_repeats).cast("double").alias("cap"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    levels = weighed.select(
        "*", (F.sum("source_size").over(everything) * share).alias("budget"),
        F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("open_weight"))
    level = F.max((F.col("budget") - F.col("capped")) / F.col("open_weight")).over(everything)
    return levels.select("source", "rank", "source_size", "budget", level.alias("level"), "weight", "cap").select(
        "source", "rank", "source_size", "budget", F.least(F.col("level") * F.col("weight"), F.col("cap")).alias("target"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
             share: float = 1.5, max_repeats: int = 2, seed: int = 13) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken, finish) of every document.

    copies is how often the mix takes it, taken = copies * size, finish its first finish time.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    thin = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                             shuffle_value(F.col(id_col), seed).alias("u")), "mix-sizes")
    bits = min(40, math.ceil(math.log2(max(2, thin.count())) / 2))
    targets = stage(source_targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats), "mix-targets")

    t = small_side(targets).select(F.col("source").alias("t_source"), "rank", "source_size", "target", "budget")
    queued = thin.join(t, F.col("source").eqNullSafe(F.col("t_source"))).withColumn("bucket", F.shiftright("u", U_BITS - bits))
    sums = queued.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    bases = sums.select(F.col("rank").alias("b_rank"), F.col("bucket").alias("b_bucket"), F.coalesce(
        F.sum("bucket_size").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "bucket").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = queued.withColumn("within", F.sum("size").over(inside))
    ordered = stage(placed.join(bases, (F.col("rank") == F.col("b_rank")) & (F.col("bucket") == F.col("b_bucket")))
                    .select("doc_id", "source", "size", "u", "rank", "source_size", "target", "budget", (F.col("base") + F.col("within")).alias("queued")), "mix-queues")

    items = (ordered.where(F.col("size") > 0).select("size", "rank", "budget", F.explode(F.array(*[_finish(r) for r in range(max_repeats)])).alias("finish"))
             .withColumn("range", _range(F.col("finish"), bits)))
    cut = _cut(items)
    copies = sum((F.when((F.col("size") > 0) & _before(_finish(r), F.col("rank"), bits, cut), 1).otherwise(0) for r in range(max_repeats)), F.lit(0))
    return ordered.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
                          F.when(F.col("size") > 0, _finish(0)).alias("finish"), "u")


def _finish(r: int) -> Column:
    """Virtual finish time of a document's copy in round r of its source."""
    return (F.col("queued") + F.lit(r) * F.col("source_size")) / F.col("target")


def _range(finish: Column, bits: int) -> Column:
    return F.floor(finish * F.lit(float(1 << bits)))


def _cut(items: DataFrame) -> tuple | None:
    """(range, finish, rank) of the last item taken: the global order is sorted only inside the
    range in which the budget runs out. None if all items fit; four numbers reach the driver."""
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ends = items.groupBy("range", "budget").agg(F.sum("size").alias("tokens")).select("range", "budget", "tokens", F.sum("tokens").over(order).alias("end"))
    over = ends.where(F.col("end") > F.col("budget")).agg(F.min(F.struct("range", (F.col("end") - F.col("tokens")).alias("before"))).alias("c")).select("c.*").first()
    if over is None or over["range"] is None:
        return None
    inside = Window.orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    upto = items.where(F.col("range") == over["range"]).select("finish", "rank", "budget", (F.sum("size").over(inside) + over["before"]).alias("upto"))
    last = upto.where(F.col("upto") <= F.col("budget")).agg(F.max(F.struct("finish", "rank")).alias("c")).select("c.*").first()
    return over["range"], last["finish"], last["rank"]


def _before(finish: Column, rank: Column, bits: int, cut: tuple | None) -> Column:
    if cut is None:
        return F.lit(True)
    rng, last_finish, last_rank = cut
    whole = _range(finish, bits) < F.lit(rng)
    if last_finish is None:
        return whole
    return whole | ((_range(finish, bits) == F.lit(rng)) & ((finish < F.lit(last_finish)) | ((finish == F.lit(last_finish)) & (rank <= F.lit(last_rank)))))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
                  share: float = 1.5, max_repeats: int = 2, seed: int = 13) -> DataFrame:
    """The documents of the mix with all their columns, repeated ones as often as they are taken.

    What a source gives is a prefix of its queue, one for each round, so a document's copies
    follow from its shuffle value and the queue's end: texts are scanned, not shuffled.
    """
    plan = plan_mix(docs, id_col, text_col, source_col, weights, share, max_repeats, seed)
    ends = stage(plan.groupBy("source").agg(*[F.max(F.when(F.col("copies") > r, F.struct("u", "doc_id"))).alias(f"end{r}") for r in range(max_repeats)]), "mix-ends")
    ends = small_side(ends).select(F.col("source").alias("_mix_source"), *[F.col(f"end{r}").alias(f"_mix_end{r}") for r in range(max_repeats)])
    place = F.struct(shuffle_value(F.col(id_col), seed).alias("u"), F.col(id_col).alias("doc_id"))
    worded = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(WORD)
    copies = sum((F.when(worded & F.coalesce(place <= F.col(f"_mix_end{r}"), F.lit(False)), 1).otherwise(0) for r in range(max_repeats)), F.lit(0))
    joined = docs.join(ends, F.col(source_col).eqNullSafe(F.col("_mix_source")))
    return joined.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), copies))).select(*docs.columns)
