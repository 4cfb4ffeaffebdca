"""Dataset inventory and byte-budget sampling of files by type.

Input ``files``: path, size [, pos]. The extension is the lower-cased suffix.
Budget sampling keeps files in order while the running byte total stays within the
type's budget and stops at the first file that overflows; the running total is exact
and computed over balanced range slices (:mod:`folio.operators.ranking`), so one type
holding most of the files does not land in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.predicates import extension
from folio.operators.ranking import global_position, scan
from folio.session import cut_lineage


def with_ext(files: DataFrame, path_col: str = "path") -> DataFrame:
    return files.withColumn("ext", extension(F.col(path_col)))


def scan_inventory(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Files grouped by extension: count and total bytes per extension (the file list
    itself stays a table: ``with_ext(files)``; it is never collected into one row)."""
    return with_ext(files, path_col).groupBy("ext").agg(
        F.count("*").alias("n_files"), F.sum("size").alias("total_bytes"))


def dataset_stats(files: DataFrame, path_col: str = "path", shares: dict | None = None) -> DataFrame:
    """Per type and overall (``ext`` null): files, distinct files, bytes (duplicates counted), distinct
    bytes, share of bytes; with ``shares`` (type -> percent) also ``target_bytes``, what the type was to
    have of all bytes, and a row for every type asked for."""
    f = with_ext(files, path_col)
    per_path = f.groupBy("ext", path_col).agg(F.count("*").alias("copies"), F.max("size").alias("size1"),
                                              F.sum("size").alias("bytes"))
    agg = per_path.rollup("ext").agg(
        F.sum("copies").alias("n_files"), F.count("*").alias("n_unique"),
        F.sum("bytes").alias("total_bytes"), F.sum("size1").alias("unique_bytes"))
    total = F.sum(F.when(F.col("ext").isNull(), F.col("total_bytes"))).over(Window.partitionBy())
    if shares is None:
        return agg.withColumn("share", F.col("total_bytes") / total)
    asked = F.array(*[F.struct(F.lit(k.lower()).alias("_ext"), F.lit(float(v)).alias("_percent")) for k, v in shares.items()])
    every = agg.where("ext IS NULL").select(F.col("total_bytes").alias("_all"), F.inline(asked))  # a row a type asked for
    both = agg.join(every.drop("_all"), F.col("ext") == F.col("_ext"), "full").withColumn("ext", F.coalesce("ext", "_ext"))
    whole = F.max("total_bytes").over(Window.partitionBy())
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_files", "n_unique", "total_bytes", "unique_bytes")}
    return both.withColumns(counts).withColumn("share", F.col("total_bytes") / whole).withColumn(
        "target_bytes", F.col("_percent") / 100 * whole).drop("_ext", "_percent")


def sample_files(files: DataFrame, shares: dict, total_bytes: int, order_col: str = "pos",
                 path_col: str = "path", replacement: bool = False, seed: int = 0) -> DataFrame:
    """Per type a byte budget of ``share% x total_bytes``; take files in ``order_col``
    order and stop at the first file that would overflow the budget. With
    ``replacement`` each draw picks one file of the type by a seeded hash of the draw's
    number instead, so a file can come more than once; column ``draw`` numbers the draws.
    Shares are percentages and must sum to 100. Files of no bytes are never drawn with
    replacement (they would be drawn forever)."""
    if abs(sum(shares.values()) - 100) > 1e-9:
        raise ValueError("shares must sum to 100")
    f = with_ext(files, path_col)
    budgets = F.create_map(*[x for k, v in shares.items() for x in (F.lit(k.lower()), F.lit(v / 100 * total_bytes))])
    f = f.withColumn("budget", F.element_at(budgets, F.col("ext"))).where(F.col("budget").isNotNull())
    if replacement:
        f = _draws(f.where(F.col("size") > 0), path_col, seed)
        order_col = "draw"
    g = scan(f, ["ext"], [order_col], sums={"cum_bytes": "size"})
    # sizes are >= 0, so "stop at the first overflow" == keep while the running total fits
    return g.where(F.col("cum_bytes") <= F.col("budget"))


def _draws(f: DataFrame, path_col: str, seed: int) -> DataFrame:
    """Numbered draws of files of each type, enough to pass the type's budget.

    A draw costs its file's size on average the type's mean, so a round makes as many draws as the
    bytes still missing hold means, and some more; the next round adds to the bytes reached. The
    number of rows made follows the number of rows returned, whatever the smallest file is. A round's
    draws are numbered by exploding blocks of numbers."""
    spark = f.sparkSession
    numbered = cut_lineage(global_position(f.withColumn("_rank", F.xxhash64(path_col)), ["ext"], ["_rank"], "_i").drop("_rank"), "table")
    per = numbered.groupBy("ext").agg(F.count("*").alias("files"), F.avg("size").alias("mean"), F.max("budget").alias("budget")).collect()  # a row a type asked for
    made, reached, rounds = {r["ext"]: 0 for r in per}, {r["ext"]: 0 for r in per}, []
    while True:
        wanted = []
        for r in per:
            left = r["budget"] - reached[r["ext"]]
            if left >= 0:  # the draw that passes the budget is not made yet
                n = int(left / r["mean"] * 1.05) + 64
                wanted += [(r["ext"], r["files"], made[r["ext"]], made[r["ext"]] + n)]
                made[r["ext"]] += n
        if not wanted:
            break
        spans = spark.createDataFrame(wanted, "ext string, _files long, _lo long, _hi long")
        blocks = spans.withColumn("_from", F.explode(F.sequence("_lo", F.col("_hi") - 1, F.lit(1 << 16).cast("long"))))
        draw = (blocks.repartition("ext", "_from")
                      .withColumn("draw", F.explode(F.sequence("_from", F.least(F.col("_from") + (1 << 16), F.col("_hi")) - 1)))
                      .select("ext", "draw", F.pmod(F.xxhash64(F.lit(seed), "ext", "draw"), F.col("_files")).alias("_i")))
        drawn = cut_lineage(draw.join(numbered, ["ext", "_i"]).drop("_i"), "table")
        for r in drawn.groupBy("ext").agg(F.sum("size").alias("bytes")).collect():
            reached[r["ext"]] += r["bytes"]
        rounds.append(drawn)
    return reduce(DataFrame.unionByName, rounds) if rounds else numbered.withColumn("draw", F.lit(0).cast("long")).drop("_i").limit(0)


def check_sample(sampled: DataFrame, shares: dict, total_bytes: int, tol: float = 0.05) -> DataFrame:
    """Achieved bytes of every type asked for against its target. ``ratio`` is the type's
    share of all bytes achieved (types not asked for included) over the share asked for,
    and ``ok`` whether that is within +-tol. A type with nothing sampled has a row with 0."""
    f = with_ext(sampled) if "ext" not in sampled.columns else sampled
    asked = F.array(*[F.struct(F.lit(k.lower()).alias("ext"), F.lit(float(v)).alias("_share")) for k, v in shares.items()])
    got = f.groupBy("ext").agg(F.sum("size").alias("_bytes"))
    total = got.agg(F.sum("_bytes").alias("_total"))  # one row, also of an empty sample
    types = total.select("_total", F.inline(asked)).join(got, "ext", "left")
    achieved = F.coalesce(F.col("_bytes"), F.lit(0)).cast("long")
    ratio = F.coalesce(F.try_divide(100.0 * achieved, F.col("_total") * F.col("_share")), F.lit(0.0))
    return types.select("ext", achieved.alias("achieved_bytes"), (F.col("_share") / 100 * total_bytes).alias("target_bytes"),
                        ratio.alias("ratio"), ratio.between(1 - tol, 1 + tol).alias("ok"))
