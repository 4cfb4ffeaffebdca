"""Merkle manifest of a table: a leaf a row, a tree of runs of three per group, a tree over the groups.

Levels are windows over the rows in their place. A node of level j stands on the row of its first
leaf, so its siblings are lag and lead columns at offsets 3**j and 2 * 3**j, masked by the node's
slot in its run and by the run's length; the row of a run's first child hashes the parent. A span
of 3**LEVELS rows is one window partition, whatever its group holds; all of a span's levels use one
shuffle, and a row takes its ancestors' siblings from the last row before it that has them. The
nodes that spans end in are the rows of the next round, a 729th as many. Rows get their places by
ranges of (group, order), with counts of ranges added, so no group meets in one task; only hashes
are shuffled, texts stay where they are read.

H is the lowercase hex SHA-256 of its inputs' concatenated text. A leaf's fields are "-" for null,
otherwise the value's size in UTF-8 bytes, ":" and the value.

Defined cases: null fields and groups are "-" and order first; an empty text is "0:"; a run of one
node is hashed like others, a group of one row is its own root; rows that repeat stand next to each
other, each with its own place; no rows give no rows; columns that are not named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import numbered, small_side, stage

FANOUT = 3
LEVELS = 6  # of a round: a span has 729 rows
SPAN = FANOUT ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_EMPTY_PATH = "array<struct<l:string,r:string>>"


def field(value: Column) -> Column:
    """A value as a leaf holds it: its size and itself, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _climb(rows: DataFrame) -> DataFrame:
    """The levels of each span: ``l0, r0, ...`` hold, on a node's row, its siblings before and after
    it (null where the group has no such level); ``top`` on a span's first row is the node it ends in."""
    span = Window.partitionBy("key", "span").orderBy("pos")
    out = rows.withColumn("span", F.expr(f"pos div {SPAN}")).withColumn("top", F.col("node"))
    for j in range(LEVELS):
        step = FANOUT ** j
        nodes, at = F.expr(f"(n + {step - 1}) div {step}"), F.expr(f"pos div {step}")
        slot = at % FANOUT
        length = F.least(F.lit(FANOUT), nodes - (at - slot))
        there = (F.col("pos") % step == 0) & (nodes > 1)
        out = out.withColumns({f"_{side}{k}": f("top", k * step).over(span) for side, f in (("lag", F.lag), ("lead", F.lead)) for k in (1, 2)})
        left = F.concat(F.when(slot == 2, F.col("_lag2")).otherwise(""), F.when(slot >= 1, F.col("_lag1")).otherwise(""))
        right = F.concat(F.when(slot + 1 < length, F.col("_lead1")).otherwise(""), F.when(slot + 2 < length, F.col("_lead2")).otherwise(""))
        out = out.withColumns({f"l{j}": F.when(there, left), f"r{j}": F.when(there, right)})
        out = out.withColumn("top", F.when(there & (slot == 0), F.sha2(F.concat("top", f"r{j}"), 256)).when((nodes <= 1) & (at == 0), F.col("top")))
        out = out.drop("_lag1", "_lag2", "_lead1", "_lead2")
    return out


def paths(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Of staged (key, pos, n, node, ...): the rows with ``path``, the siblings of their ancestors from
    the lowest level up, and ``root``, their key's; and (key, root), a row a key."""
    levels = _climb(rows)
    firsts = levels.where(F.col("pos") % SPAN == 0)
    span = Window.partitionBy("key", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spread = {f"{s}{j}": F.last(f"{s}{j}", ignorenulls=True).over(span) for j in range(LEVELS) for s in "lr"}
    below = levels.withColumns(spread | {"top": F.first("top").over(span)})
    own = F.filter(F.array(*[F.struct(F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")) for j in range(LEVELS)]), lambda x: x["l"].isNotNull())
    below = below.withColumn("path", own).drop(*spread)
    most = rows.agg(F.max("n")).first()[0] or 0
    if most <= SPAN:
        return below.withColumnRenamed("top", "root").drop("span"), firsts.select("key", F.col("top").alias("root"))
    ends = firsts.select("key", F.col("span").alias("pos"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"), F.col("top").alias("node"))
    upper, roots = paths(stage(ends, name), name)
    upper = stage(upper.select("key", F.col("pos").alias("span"), F.col("path").alias("_upper"), "root"), name + "-paths")
    joined = below.drop("top").join(small_side(upper), ["key", "span"])
    return joined.withColumn("path", F.concat("path", "_upper")).drop("_upper", "span"), roots


def fold(node: Column, path: Column) -> Column:
    """The root that a node and the siblings on its path lead to."""
    return F.aggregate(path, node, lambda acc, x: F.sha2(F.concat(x["l"], acc, x["r"]), 256))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source", found: dict[str, Column] | None = None) -> DataFrame:
    """(id, group, leaf, path, subroot, root) of each row and, where ``found`` says which columns an
    audit finds changed and how, the leaf of that: ``found_leaf`` (null where it is the same).

    ``path`` holds the siblings on the way up, before (l) and after (r) each node: ``fold`` of a leaf
    and its path gives the root."""
    as_found = leaf([(found or {}).get(c, F.col(c)) for c in fields])
    thin = docs.select(F.col(id_col).alias("_id"), F.col(group_col).cast("string").alias("_group"), field(F.col(group_col)).alias("key"),
                       leaf([F.col(c) for c in fields]).alias("node"), as_found.alias("_found"))
    thin = stage(thin.withColumn("_found", F.when(F.col("_found") != F.col("node"), F.col("_found"))), "manifest-leaves")
    groups = stage(thin.groupBy("key").agg(F.first("_group").alias("_group")), "manifest-groups")
    rows, roots = paths(stage(numbered(thin.drop("_group"), "key", [F.col("_id").asc_nulls_first(), F.col("node")], "manifest-places"), "manifest-rows"), "manifest-spans")
    subroots = roots.withColumnRenamed("key", "_key").join(small_side(groups), F.col("_key") == F.col("key")).select(
        F.lit("").alias("key"), F.col("_key"), F.col("_group"), F.col("root").alias("node"))
    order = [F.col("_group").asc_nulls_first()]
    above, _ = paths(stage(numbered(stage(subroots, "manifest-subroots"), "key", order, "manifest-order"), "manifest-tops"), "manifest-top-spans")
    above = stage(above.select(F.col("_key").alias("key"), "_group", F.col("path").alias("_above"), F.col("root").alias("_top")), "manifest-above")
    return rows.join(small_side(above), "key").select(
        F.col("_id").alias(id_col), F.col("_group").alias(group_col), F.col("node").alias("leaf"), F.col("_found").alias("found_leaf"),
        F.concat("path", "_above").alias("path"), F.col("root").alias("subroot"), F.col("_top").alias("root"))


def audit(entries: DataFrame) -> DataFrame:
    """``entries`` of a manifest with the digest of each proof, the root that the leaf as found folds
    to, and whether that is the manifest's."""
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["l"], x["r"])), "")
    out = entries.withColumns({"proof_sha256": F.sha2(siblings, 256), "folded_root": fold(F.coalesce("found_leaf", "leaf"), F.col("path"))})
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
