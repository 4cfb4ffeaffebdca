"""Scans along an order inside huge, few-valued groups: positions, running sums, lags, last values.

``Window.partitionBy(stage).orderBy(ts)`` sends a whole stage to one task; with five
stages over 100 TB that is 20 TB per task. Here rows are range-partitioned on (group, order,
the row's own number) and written to the shared folder with the number of their slice, so
that every slice is a contiguous, balanced run of rows, also where one order value holds a
third of them. Slices are scanned by themselves, and each slice's last state, one small row a
slice, is carried to the slices after it. Being written once, slices stay what they are when a
branch is computed again. Work and memory per task are bounded by the slice size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.session import cut_lineage

_ROW_BITS = (1 << 33) - 1  # a row's number within its partition, in monotonically_increasing_id


def slices(df: DataFrame, group_cols, order_cols, num_slices: int | None = None) -> DataFrame:
    """``df`` written in slices: ``_slice``, ascending with (group, order), and ``_at``, the place in it.

    Order columns are names or sorted columns; rows that they do not tell apart come in any order."""
    by = [*[F.col(c) for c in group_cols], *[F.col(c) if isinstance(c, str) else c for c in order_cols], F.col("_tie")]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranges = tied.repartitionByRange(*([num_slices] if num_slices else []), *by).sortWithinPartitions(*by).drop("_tie")
    return cut_lineage(ranges.withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(_ROW_BITS)}), "table")


def scan(df: DataFrame, group_cols, order_cols, sums: dict | None = None, lags: dict | None = None, lasts: dict | None = None,
         num_slices: int | None = None) -> DataFrame:
    """``df`` with columns that look back along the order inside each group.

    ``sums``: name -> column, summed up to and including the row; ``lags``: name -> column, its value in
    the row before (null in a group's first); ``lasts``: name -> column, its last value that is
    not null, the row's own included. Null groups are groups."""
    group_cols, sums, lags, lasts = list(group_cols), dict(sums or {}), dict(lags or {}), dict(lasts or {})
    value = {f"_v{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate([*sums.values(), *lags.values(), *lasts.values()])}
    names = dict(zip([*sums, *lags, *lasts], value))
    placed = slices(df.withColumns(value), group_cols, order_cols, num_slices)
    # the state in which a slice leaves its last group, and the group that the next one begins with
    ends = placed.groupBy("_slice", *group_cols).agg(
        F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), *[F.sum(names[n]).alias(f"s_{names[n]}") for n in sums],
        *[F.max_by(F.struct(names[n]), "_at").alias(f"s_{names[n]}") for n in lags],
        *[F.max_by(names[n], F.when(F.col(names[n]).isNotNull(), F.col("_at"))).alias(f"s_{names[n]}") for n in lasts])
    state = [f"s_{v}" for v in value]
    group = F.struct(*group_cols) if group_cols else F.struct(F.lit(0).alias("all"))
    edges = ends.groupBy("_slice").agg(
        F.min_by(group, "_lo").alias("_first"), F.max_by(F.struct(group.alias("_g"), *state), "_hi").alias("_last"))
    marks = edges.select("_slice", F.explode(F.array(
        F.struct(F.lit(0).alias("_kind"), F.col("_first").alias("_g"), *[F.lit(None).cast(ends.schema[c].dataType).alias(c) for c in state]),
        F.struct(F.lit(1).alias("_kind"), F.col("_last._g").alias("_g"), *[F.col(f"_last.{c}").alias(c) for c in state]))).alias("_m")).select("_slice", "_m.*")
    before = Window.partitionBy("_g").orderBy("_slice", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(f"s_{names[n]}").over(before).alias(f"c_{names[n]}") for n in sums]
    carried += [F.last(f"s_{names[n]}", ignorenulls=True).over(before).alias(f"c_{names[n]}") for n in [*lags, *lasts]]
    carry = marks.select("_slice", "_kind", "_g", *carried).where("_kind = 0").drop("_kind")  # a row a slice
    carry = carry.select(F.col("_slice").alias("_to"), *[F.col("_g")[c].alias(f"_g_{c}") for c in group_cols], *[f"c_{v}" for v in value])
    own = Window.partitionBy("_slice", *group_cols).orderBy("_at")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    here = placed.withColumns(
        {f"w_{names[n]}": F.sum(names[n]).over(so_far) for n in sums}
        | {f"w_{names[n]}": F.lag(F.struct(names[n])).over(own) for n in lags}
        | {f"w_{names[n]}": F.last(names[n], ignorenulls=True).over(so_far) for n in lasts})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_cols], F.col("_slice") == F.col("_to"))
    joined = here.join(F.broadcast(carry), same, "left")  # as many rows as slices
    out = {n: F.coalesce(F.col(f"w_{v}") + F.col(f"c_{v}"), F.col(f"w_{v}"), F.col(f"c_{v}")) if n in sums
           else F.coalesce(f"w_{v}", f"c_{v}")[v] if n in lags else F.coalesce(f"w_{v}", f"c_{v}") for n, v in names.items()}
    return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def global_position(df: DataFrame, group_cols, order_cols, out: str = "gpos",
                    sum_col: str | None = None, sum_out: str = "running_sum",
                    num_slices: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row within its group in ``order_cols``
    order, and optionally ``sum_out`` = running sum of ``sum_col`` including the row."""
    sums = {out: F.lit(1).cast("long")} | ({sum_out: sum_col} if sum_col else {})
    return scan(df, group_cols, order_cols, sums=sums, num_slices=num_slices).withColumn(out, F.col(out) - 1)


def rolling_frame(df: DataFrame, group_cols, order_cols, window: int, aggs: dict,
                  block: int = 1 << 16, num_slices: int | None = None) -> DataFrame:
    """Aggregates over the last ``window`` rows (current included) of each group.

    Rows are numbered exactly (:func:`global_position`), cut into blocks of ``block``
    rows, and each block gets a copy of the ``window - 1`` rows before it; a window per
    (group, block) then sees at most ``block + window - 1`` rows. ``aggs`` maps output
    names to ``(value_col, fn)`` with ``fn: Column -> Column`` an aggregate."""
    if block < window:
        raise ValueError("block must be >= window")
    group_cols = list(group_cols)
    g = global_position(df, group_cols, order_cols, "_g", num_slices=num_slices)
    g = g.withColumn("_b0", F.floor(F.col("_g") / block))
    # one pass emits each row for its own block and, when it is among the last
    # window-1 rows of that block, once more as halo of the next block
    in_halo = (F.col("_g") % block) >= block - (window - 1)
    copies = F.when(in_halo, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = (g.withColumn("_halo", F.explode(copies))
             .withColumn("_b", F.col("_b0") + F.col("_halo").cast("long")).drop("_b0"))
    w = Window.partitionBy(*group_cols, "_b").orderBy("_g").rowsBetween(-(window - 1), 0)
    for name, (value_col, fn) in aggs.items():
        both = both.withColumn(name, fn(F.col(value_col)).over(w))
    return both.where(~F.col("_halo")).drop("_b", "_halo", "_g")


def exact_median(df: DataFrame, group_cols, value_col: str, out: str = "median",
                 num_slices: int | None = None) -> DataFrame:
    """Exact median per group (mean of the two middle values for even counts) without
    holding a group in one task. Equal values are counted first (combined before the
    shuffle), so a frequent value is one row; running counts over the distinct values
    then tell which one or two hold the middle positions."""
    group_cols = list(group_cols)
    h = df.where(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(F.count("*").alias("_n"))
    g = global_position(h, group_cols, [value_col], "_g", sum_col="_n", sum_out="_upto", num_slices=num_slices)
    n = h.groupBy(*group_cols).agg(F.sum("_n").alias("_cnt"))

    def holds(position):
        return ((position >= F.col("_upto") - F.col("_n")) & (position < F.col("_upto"))).cast("long")
    low, high = F.floor((F.col("_cnt") - 1) / 2), F.ceil((F.col("_cnt") - 1) / 2)
    mid = g.join(n, group_cols).withColumn("_w", holds(low) + holds(high)).where(F.col("_w") > 0)
    return mid.groupBy(*group_cols).agg((F.sum(F.col(value_col) * F.col("_w")) / 2).alias(out))
