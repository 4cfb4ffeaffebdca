"""Job responses: one result per job, fragmenting of oversize results, reassembly.

Fragments are cut greedily: the next one begins at the first item that no longer fits. Where it
begins is, for every item, a search in the running sum of sizes; these jumps, doubled again and
again, reach all beginnings in a number of rounds that is the logarithm of the number of fragments.
Nothing folds over a job: its items are spread over as many tasks as they need.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.ranking import scan
from folio.session import cut_lineage

# Response descriptions.
DESC_OK = "Successfully processed the message."
DESC_FAILED = "Failed to process the message."
SIZE_LIMIT = 256 * 1024 * 1024


def _by_key(a, b):
    """Comparator on the orderable ``_k`` field (metadata holds a map, which Spark cannot order)."""
    return F.when(a["_k"] < b["_k"], -1).when(a["_k"] > b["_k"], 1).otherwise(0)


def _keys(elements: DataFrame) -> list:
    """What orders a job's items: position and piece (-1 where there is none), then id."""
    keys = [F.coalesce(F.col(c).cast("long"), F.lit(-1)).alias(f"_{c}") if c in elements.columns else F.lit(-1).cast("long").alias(f"_{c}") for c in ("pos", "piece")]
    return [*keys, (F.col("uuid").cast("string") if "uuid" in elements.columns else F.lit("")).alias("_uuid")]


def build_responses(jobs: DataFrame, elements: DataFrame, failed_col: str = "cm_failed", size_limit: int = SIZE_LIMIT,
                    overhead_bytes: int = 49, trace: DataFrame | None = None, annotations: DataFrame | None = None) -> DataFrame:
    """Responses per job: status, description, ``data`` = elements as
    ``{document_type, metadata}`` in ``pos`` order, ``fragment`` / ``fragment_count``.
    Failed jobs carry null data. A job whose result exceeds ``size_limit`` is split into
    fragments (:func:`fragment_responses`), so no response row, and no aggregation
    group, holds more than the size limit.

    ``trace`` (job_id, key, ts_us) and ``annotations`` (job_id, task, task_result, message) go, as maps
    ``trace::...`` -> nanoseconds and ``annotation::<task>`` -> JSON, with fragment 0 of jobs whose
    ``add_trace_tagging`` is not false; other fragments have null there."""
    fr = fragment_responses(elements, size_limit, overhead_bytes)
    order = F.struct(*_keys(elements))
    item = F.struct(order.alias("_k"), F.col("document_type"), F.col("metadata"))
    per = fr.groupBy("job_id", "fragment").agg(
        F.array_sort(F.collect_list(item), _by_key).alias("_items"),
        F.max("fragment_count").alias("fragment_count"))
    # a fragment can be empty: every number up to the count has its row
    counts = per.groupBy("job_id").agg(F.max("fragment_count").alias("fragment_count"))
    numbers = counts.select("job_id", "fragment_count", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fragment_count") - 1)).alias("fragment"))
    per = _null_safe(numbers, per.drop("fragment_count"), ["job_id", "fragment"], "left")
    tagging = F.coalesce(F.col("add_trace_tagging"), F.lit(True)) if "add_trace_tagging" in jobs.columns else F.lit(True)
    j = jobs.groupBy("job_id").agg(F.max(F.coalesce(F.col(failed_col), F.lit(False))).alias("_failed"), F.min(tagging).alias("_tagging"))
    out = _null_safe(j, per, ["job_id"], "left").withColumn("fragment", F.coalesce(F.col("fragment"), F.lit(0)))
    first, extra = F.col("_tagging") & (F.col("fragment") == 0), []
    if trace is not None:
        keyed = trace.where(F.col("key").startswith("trace::") & F.col("ts_us").isNotNull()).groupBy("job_id", "key").agg(F.max("ts_us").alias("ts_us"))
        out = _null_safe(out, _as_map(keyed, F.col("key"), F.col("ts_us") * 1000, "_trace"), ["job_id"], "left")
        extra.append(F.when(first, F.coalesce("_trace", F.create_map().cast("map<string,bigint>"))).alias("trace"))
    if annotations is not None:
        value = F.to_json(F.struct(F.col("task_result"), F.col("message")))
        keyed = annotations.groupBy("job_id", "task").agg(F.max_by(value, value).alias("_v"))
        out = _null_safe(out, _as_map(keyed, F.concat(F.lit("annotation::"), F.col("task")), F.col("_v"), "_notes"), ["job_id"], "left")
        extra.append(F.when(first, F.coalesce("_notes", F.create_map().cast("map<string,string>"))).alias("annotations"))
    data = F.transform(F.coalesce(F.col("_items"), F.array()),
                       lambda e: F.struct(e["document_type"].alias("document_type"), e["metadata"].alias("metadata")))
    return out.select(
        "job_id",
        F.when(F.col("_failed"), "failed").otherwise("success").alias("status"),
        F.when(F.col("_failed"), DESC_FAILED).otherwise(DESC_OK).alias("description"),
        F.when(F.col("_failed"), F.lit(None)).otherwise(data).alias("data"),
        F.col("fragment").cast("int").alias("fragment"),
        F.coalesce(F.col("fragment_count"), F.lit(1)).cast("int").alias("fragment_count"), *extra)


def _as_map(rows: DataFrame, key: Column, value: Column, out: str) -> DataFrame:
    """(job_id, out): a job's keys with their values; a key is there once."""
    pairs = F.array_sort(F.collect_list(F.struct(key.alias("key"), value.alias("value"))))
    return rows.where(key.isNotNull()).groupBy("job_id").agg(F.map_from_entries(pairs).alias(out))


def _null_safe(a: DataFrame, b: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi-join in which null equals null; the columns of ``b`` that ``on`` names are left out."""
    other = b.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in b.columns])
    joined = a.join(other, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on], how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{c}" for c in on])


def _starts(items: DataFrame, size_limit: int, overhead: int, most: int) -> DataFrame:
    """(job_id, _rn, fragment): the item each fragment begins with. items: job_id, _rn (from 0), _bytes
    and _upto, the bytes up to and with the item; ``most``: no job has more fragments."""
    room = size_limit - (2 + overhead)  # what fits beside "[]"
    # the first item beyond what fits, for each item: how many items end within its bytes and those
    # that fit, counted along the merged order of items and searches
    marks = items.select("job_id", F.col("_upto").alias("_at"), F.lit(0).alias("_kind"), F.lit(1).cast("long").alias("_one"), F.lit(None).cast("long").alias("_rn"))
    searches = items.select("job_id", (F.col("_upto") - F.col("_bytes") + room).alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_one"), "_rn")
    found = scan(marks.unionByName(searches), ["job_id"], ["_at", "_kind"], sums={"_next": "_one"}).where("_kind = 1")
    jump = cut_lineage(found.select("job_id", "_rn", F.greatest(F.col("_next"), F.col("_rn") + 1).alias("_next")), "table")
    # an oversize first item leaves an empty first fragment
    starts = items.where("_rn = 0").select("job_id", "_rn", (F.col("_bytes") > room).cast("long").alias("fragment"))
    starts = cut_lineage(starts, "table")
    rounds = max(1, ceil(log2(max(2, most))))
    for k in range(rounds):
        step = jump.select(F.col("job_id").alias("_j"), F.col("_rn").alias("_from"), F.col("_next").alias("_to"))
        known = items.select(F.col("job_id").alias("_i"), F.col("_rn").alias("_is"))
        hop = starts.join(step, F.col("job_id").eqNullSafe(F.col("_j")) & (F.col("_rn") == F.col("_from"))).select(
            "job_id", F.col("_to").alias("_rn"), (F.col("fragment") + 2 ** k).alias("fragment"))
        hop = hop.join(known, F.col("job_id").eqNullSafe(F.col("_i")) & (F.col("_rn") == F.col("_is")), "left_semi")  # not beyond the last item
        hop = cut_lineage(hop, "table")
        starts = starts.unionByName(hop)
        if k + 1 == rounds or hop.isEmpty():
            break
        jump = cut_lineage(jump.join(step, F.col("job_id").eqNullSafe(F.col("_j")) & (F.col("_next") == F.col("_from"))).select(
            "job_id", "_rn", F.col("_to").alias("_next")), "table")
    return starts


def fragment_responses(elements: DataFrame, size_limit: int = SIZE_LIMIT, overhead_bytes: int = 49, size_col: str | None = None) -> DataFrame:
    """Greedy, order-preserving packing of a job's items into fragments when the whole
    result exceeds ``size_limit``: a new fragment starts when current + item > limit
    (an oversize first item leaves an empty first fragment). Item size = JSON bytes, or what
    ``size_col`` holds, + ``overhead_bytes``. Returns elements with ``fragment`` and ``fragment_count``.

    Job totals are a JVM aggregate; only items of jobs over the limit are numbered in their order
    (position, piece, id) and packed, on a thin table of numbers and sizes. Everything else is
    fragment 0 of 1 and is not shuffled. A null job is a job like others."""
    size = F.col(size_col) if size_col else F.octet_length(F.to_json(F.struct("document_type", "metadata")))
    sized = elements.withColumn("_bytes", F.coalesce(size.cast("long"), F.lit(0)))
    totals = sized.groupBy("job_id").agg((F.sum("_bytes") + 2 * F.count("*") + F.lit(overhead_bytes)).alias("_total"),
                                         F.count("*").alias("_items"), F.sum(F.col("_bytes") + overhead_bytes).alias("_all"))
    big = cut_lineage(totals.where(F.col("_total") > size_limit), "table")
    whole = elements.withColumns({"fragment": F.lit(0).cast("long"), "fragment_count": F.lit(1).cast("long")})
    reach = big.agg(F.max("_items").alias("items"), F.max("_all").alias("bytes")).first()
    if reach["items"] is None:
        return whole
    room = size_limit - (2 + overhead_bytes)
    most = min(reach["items"], 2 * reach["bytes"] // room + 2) if room > 0 else reach["items"]  # two neighbours never fit into one
    # items are written once with a number; what is ordered and searched is thin
    keyed = cut_lineage(_null_safe(sized.select("*", *_keys(elements)), big.select("job_id"), ["job_id"], "left_semi")
                        .withColumn("_id", F.monotonically_increasing_id()), "table")
    sizes = keyed.select("job_id", "_id", "_pos", "_piece", "_uuid", (F.col("_bytes") + overhead_bytes).alias("_bytes"))
    rows = cut_lineage(scan(sizes, ["job_id"], ["_pos", "_piece", "_uuid"],
                            sums={"_rn": F.lit(1).cast("long"), "_upto": "_bytes"}).withColumn("_rn", F.col("_rn") - 1), "table")
    items = rows.select("job_id", "_rn", "_bytes", "_upto")
    starts = _starts(items, size_limit, overhead_bytes, most)
    marked = _null_safe(items.select("job_id", "_rn"), starts, ["job_id", "_rn"], "left").withColumnRenamed("fragment", "_f")
    thin = scan(marked, ["job_id"], ["_rn"], lasts={"fragment": "_f"}).drop("_f")
    counts = starts.groupBy("job_id").agg((F.max("fragment") + 1).alias("fragment_count"))
    placed = _null_safe(_null_safe(rows.select("job_id", "_id", "_rn"), thin, ["job_id", "_rn"], "inner"), counts, ["job_id"], "inner")
    packed = keyed.join(placed.select("_id", "fragment", "fragment_count"), "_id")
    rest = _null_safe(whole, big.select("job_id"), ["job_id"], "left_anti")
    return packed.select(*elements.columns, "fragment", "fragment_count").unionByName(rest)


def reassemble_responses(fragments: DataFrame) -> DataFrame:
    """Complete jobs only (fragments seen = fragment_count): data concatenated in
    fragment order; status / description / trace from fragment 0. A fragment that is delivered
    again counts once. Annotations are not kept."""
    kept = [c for c in ("status", "description", "data", "trace") if c in fragments.columns]
    once = fragments.groupBy("job_id", "fragment").agg(F.first(F.struct(*kept)).alias("_r"), F.max("fragment_count").alias("_n"))
    g = once.groupBy("job_id").agg(
        F.count("*").alias("_seen"), F.max("_n").alias("_count"),
        F.array_sort(F.collect_list(F.struct(F.struct("fragment").alias("_k"), F.col("_r"))), _by_key).alias("_f"))
    done = g.where(F.col("_seen") == F.col("_count"))
    first = F.col("_f")[0]["_r"]
    empty = F.array().cast(fragments.schema["data"].dataType)
    return done.select(
        "job_id", *[first[c].alias(c) for c in kept if c != "data"],
        F.flatten(F.transform("_f", lambda x: F.coalesce(x["_r"]["data"], empty))).alias("data"))
