"""Run telemetry as tables: job counters, trace pairing, spans, stage statistics.

Inputs
- results: job_id, status
- trace events (long form): job_id, key (``trace::entry::<name>`` / ``trace::exit::<name>``), ts_us
- stage spans (wide form): job_id, stage, pos, entry_us, exit_us
Timestamps are epoch microseconds (``to_micros``), which keeps every computation
independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.ranking import exact_median, global_position, rolling_frame, scan  # noqa: F401


def to_micros(ts) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ (or TIMESTAMP) column, time-zone free."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def job_counts(results: DataFrame, status_col: str = "status") -> DataFrame:
    """submitted / completed / failed over all jobs (one row; partial aggregation)."""
    s = F.col(status_col)
    return results.agg(F.count("*").alias("submitted"),
                       F.count_if(s == "success").alias("completed"),
                       F.count_if(s == "failed").alias("failed"))


def inflight(counts: DataFrame) -> DataFrame:
    return counts.withColumn("inflight", F.col("submitted") - F.col("completed") - F.col("failed"))


def trace_events(spans: DataFrame) -> DataFrame:
    """Wide stage spans -> long trace keys (entry and exit rows), as a job carries them."""
    name = F.concat(F.col("stage"), F.lit("::"), F.col("pos").cast("string"))
    return spans.select("job_id", F.explode(F.array(
        F.struct(F.concat(F.lit("trace::entry::"), name).alias("key"), F.col("entry_us").alias("ts_us")),
        F.struct(F.concat(F.lit("trace::exit::"), name).alias("key"), F.col("exit_us").alias("ts_us")),
    )).alias("e")).select("job_id", "e.key", "e.ts_us").where(F.col("ts_us").isNotNull())


def pair_trace(events: DataFrame) -> DataFrame:
    """Match ``trace::entry::X`` with ``trace::exit::X`` per job; entries without an exit
    are ignored. ``stage`` = third ``::`` part, so sub-traces fold into their parent."""
    parts = F.split(F.col("key"), "::", -1)
    kind = parts[1]
    name = F.regexp_extract(F.col("key"), "^trace::(?:entry|exit)::(.*)$", 1)
    e = events.where(F.col("key").rlike("^trace::(entry|exit)::"))
    g = (e.groupBy("job_id", name.alias("name"))
          .agg(F.max(F.when(kind == "entry", F.col("ts_us"))).alias("entry_us"),
               F.max(F.when(kind == "exit", F.col("ts_us"))).alias("exit_us")))
    return (g.where(F.col("entry_us").isNotNull() & F.col("exit_us").isNotNull())
             .withColumn("stage", F.split(F.col("name"), "::", -1)[0])
             .withColumn("latency_us", F.col("exit_us") - F.col("entry_us")))


def channel_latency(spans: DataFrame) -> DataFrame:
    """Queue wait before each stage: from the previous stage's exit to this entry, per
    job in entry order (first stage: no wait).

    The predecessor is a lag along range slices whose last row is carried to the next
    (see ``ranking``), so a job with a huge trace is spread over many tasks instead of one
    window partition."""
    before = scan(spans, ["job_id"], ["entry_us", "pos"], lags={"_prev_exit": "exit_us"})
    return before.withColumn("wait_us", F.col("entry_us") - F.col("_prev_exit")).drop("_prev_exit")


def rolling_stage_stats(values: DataFrame, window: int = 100, stage_col: str = "stage",
                        order_cols=("entry_us", "pos"), value_col: str = "latency_ms",
                        block: int = 1 << 16) -> DataFrame:
    """Mean and median of the last ``window`` values of each stage, at every arrival."""
    return rolling_frame(values, [stage_col], list(order_cols), window,
                         {"rolling_mean": (value_col, F.avg),
                          "rolling_median": (value_col, lambda c: F.percentile(c, 0.5))},
                         block=block)


def e2e_latency(annotations: DataFrame, created: str = "Created", pushed: str = "Pushed") -> DataFrame:
    """Pushed - Created per job; jobs lacking either give no row.
    annotations: job_id, name, ts_us."""
    g = annotations.groupBy("job_id").agg(
        F.min(F.when(F.col("name") == created, F.col("ts_us"))).alias("created_us"),
        F.max(F.when(F.col("name") == pushed, F.col("ts_us"))).alias("pushed_us"))
    return (g.where(F.col("created_us").isNotNull() & F.col("pushed_us").isNotNull())
             .withColumn("e2e_us", F.col("pushed_us") - F.col("created_us")))


def response_wait(pushed: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(waits, outstanding): time from push to collection per job, and pushed jobs not
    collected yet. pushed/fetched: job_id, ts_us."""
    p = pushed.groupBy("job_id").agg(F.min("ts_us").alias("pushed_us"))
    f = fetched.groupBy("job_id").agg(F.min("ts_us").alias("fetched_us"))
    waits = p.join(f, "job_id").withColumn("wait_us", F.col("fetched_us") - F.col("pushed_us"))
    outstanding = p.join(f, "job_id", "left_anti")
    return waits, outstanding


def build_spans(spans: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """One parent span per job over [min entry, max exit] and one child per traced name, in time
    order. Columns: job_id, span, parent, start_us, end_us, seq and, with ``results``, status.

    A traced ``name`` (or, without that column, ``stage::pos``, all main tasks) that has ``::`` is a sub-task:
    what stands before the first one is its main task, and that one's span its parent where the job
    has it, else the job's. ``results`` (job_id, task, task_result): a span whose name has a result is
    ``ok`` or ``error`` by its main task's."""
    parent = spans.groupBy("job_id").agg(F.min("entry_us").alias("start_us"), F.max("exit_us").alias("end_us")) \
        .select("job_id", F.concat(F.lit("job::"), F.col("job_id").cast("string")).alias("span"),
                F.lit(None).cast("string").alias("parent"), "start_us", "end_us", F.lit(0).alias("seq"))
    named = "name" in spans.columns
    name = F.col("name") if named else F.concat(F.col("stage"), F.lit("::"), F.col("pos").cast("string"))
    order = ["entry_us", "exit_us", "_name"] if named else ["entry_us", "pos"]
    g = scan(spans.withColumn("_name", name), ["job_id"], order, sums={"_seq": F.lit(1).cast("long")})
    job = F.concat(F.lit("job::"), F.col("job_id").cast("string"))
    main = F.split("_name", "::", 2)[0] if named else F.col("_name")
    g = g.withColumn("_main", main)
    if named:  # sub-tasks meet their main tasks by job and name
        mains = g.where(F.col("_name") == F.col("_main")).select(F.col("job_id").alias("_job"), F.col("_name").alias("_of")).distinct()
        g = g.join(mains, F.col("job_id").eqNullSafe(F.col("_job")) & (F.col("_main") == F.col("_of")), "left")
        above = F.when((F.col("_name") != F.col("_main")) & F.col("_of").isNotNull(), F.col("_of")).otherwise(job)
    else:
        above = job
    child = g.select("job_id", F.col("_name").alias("span"), above.alias("parent"), F.col("entry_us").alias("start_us"),
                     F.col("exit_us").alias("end_us"), F.col("_seq").cast("int").alias("seq"), "_main")
    if results is None:
        return parent.unionByName(child.drop("_main"))
    # one result a task: a failure outweighs a success
    last = results.groupBy("job_id", "task").agg(F.min("task_result").alias("_result"))
    own, of_main = (last.select(F.col("job_id").alias(f"_job{x}"), F.col("task").alias(f"_task{x}"), F.col("_result").alias(f"_result{x}")) for x in "am")
    joined = child.join(own, F.col("job_id").eqNullSafe(F.col("_joba")) & (F.col("span") == F.col("_taska")), "left") \
        .join(of_main, F.col("job_id").eqNullSafe(F.col("_jobm")) & (F.col("_main") == F.col("_taskm")), "left")
    status = F.when(F.col("_taska").isNotNull(), F.when(F.col("_resultm") == "SUCCESS", "ok").when(F.col("_resultm") == "FAILURE", "error"))
    return parent.withColumn("status", F.lit(None).cast("string")).unionByName(
        joined.select("job_id", "span", "parent", "start_us", "end_us", "seq", status.alias("status")))


def stage_report(spans: DataFrame, stage_col: str = "stage", value_col: str = "latency_ms") -> DataFrame:
    """Per stage: avg, exact median, total and share of the summed trace time, plus an
    ``unresolved`` row (wall time - summed time) only when positive."""
    per = spans.groupBy(stage_col).agg(F.avg(value_col).alias("avg_ms"), F.sum(value_col).alias("total_ms"))
    med = exact_median(spans, [stage_col], value_col, "median_ms")
    # the share needs the grand total: a window over the per-stage table (one row per stage)
    rep = (per.join(med, stage_col)
              .withColumn("pct", F.col("total_ms") / F.sum("total_ms").over(Window.partitionBy()) * 100))
    tot = spans.agg(F.sum(value_col).alias("_all"),
                    ((F.max("exit_us") - F.min("entry_us")) / 1000.0).alias("_wall"))
    unresolved = tot.where(F.col("_wall") - F.col("_all") > 0).select(
        F.lit("unresolved").alias(stage_col), F.lit(None).cast("double").alias("avg_ms"),
        (F.col("_wall") - F.col("_all")).alias("total_ms"), F.lit(None).cast("double").alias("median_ms"),
        F.lit(None).cast("double").alias("pct"))
    return rep.unionByName(unresolved)


def throughput(spans: DataFrame, pages_col: str | None = None) -> DataFrame:
    """Files/s and pages/s over the wall time of the run (one row). ``pages_col`` on the
    spans gives pages per job (counted once per job); without it one page per file."""
    per_job = spans.groupBy("job_id").agg(
        F.min("entry_us").alias("s"), F.max("exit_us").alias("e"),
        (F.max(pages_col) if pages_col else F.lit(1)).alias("p"))
    wall = per_job.agg(((F.max("e") - F.min("s")) / 1e6).alias("wall_s"),
                       F.count("*").alias("n_files"), F.sum("p").alias("n_pages"))
    return (wall.withColumn("files_per_s", F.col("n_files") / F.col("wall_s"))
                .withColumn("pages_per_s", F.col("n_pages") / F.col("wall_s")))


def annotations(rows: DataFrame) -> DataFrame:
    """Last task result per (job, task): rows job_id, task, task_result, message, ts_us, pos."""
    last = F.max_by(F.struct("task_result", "message"), F.struct("ts_us", "pos"))
    return rows.groupBy("job_id", "task").agg(last.alias("_l")).select(
        "job_id", "task", F.col("_l.task_result").alias("task_result"), F.col("_l.message").alias("message"))
