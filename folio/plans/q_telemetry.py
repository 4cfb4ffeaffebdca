"""Registered queries for telemetry: counters, trace pairing, spans, rolling statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import filters, telemetry as T
from folio.plans.registry import query
from folio.sources import tables

SPANS_SQL = """SELECT user_id AS job_id, event_type AS stage, event_id AS pos, epoch_us(ts) AS entry_us,
       epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) AS exit_us, value AS latency_ms FROM events"""

RESULTS_SQL = """SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success'
       ELSE NULL END AS status, o_totalprice AS size FROM orders"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.trace(spark, sf_dir)
    entry = T.to_micros("ts_entry")
    return t.select("job_id", "stage", "pos", entry.alias("entry_us"),
                    (entry + F.round(F.col("latency_ms") * 1000).cast("long")).alias("exit_us"),
                    "latency_ms")


def _r(c, n=6):
    return F.round(c, n)


@query("job_counts", operators=("H1", "H2"), sql=f"""
SELECT count(*) AS submitted, count_if(status = 'success') AS completed,
       count_if(status = 'failed') AS failed,
       count(*) - count_if(status = 'success') - count_if(status = 'failed') AS inflight
FROM ({RESULTS_SQL}) r""")
def job_counts_q(spark, sf_dir):
    return T.inflight(T.job_counts(tables.results(spark, sf_dir)))


@query("result_failed", operators=("C11",), sql=f"""
SELECT job_id, (status IS NULL OR strpos('failed', status) > 0) AS failed FROM ({RESULTS_SQL}) r""")
def result_failed_q(spark, sf_dir):
    return filters.result_failed(tables.results(spark, sf_dir)).select("job_id", "failed")


@query("pair_trace", operators=("H3",), sql=f"""
SELECT job_id, concat(stage, '::', CAST(pos AS VARCHAR)) AS name, stage, exit_us - entry_us AS latency_us
FROM ({SPANS_SQL}) s WHERE stage <> 'error'""")
def pair_trace_q(spark, sf_dir):
    # error stages never report an exit: their entries stay unpaired and are ignored
    ev = T.trace_events(spans(spark, sf_dir)).where(~F.col("key").startswith("trace::exit::error::"))
    return T.pair_trace(ev).select("job_id", "name", "stage", "latency_us")


@query("channel_latency", operators=("H4",), sql=f"""
SELECT job_id, pos, entry_us - lag(exit_us) OVER (PARTITION BY job_id ORDER BY entry_us, pos) AS wait_us
FROM ({SPANS_SQL}) s""")
def channel_latency_q(spark, sf_dir):
    return T.channel_latency(spans(spark, sf_dir)).select("job_id", "pos", "wait_us")


@query("rolling_stage_stats", operators=("H5",), sql=f"""
SELECT stage, pos,
  CAST((sum(CAST(round(latency_ms * 100) AS BIGINT)) OVER w * 20000 + count(*) OVER w)
       // (2 * count(*) OVER w) AS BIGINT) / 1e6 AS rolling_mean,
  round(quantile_cont(latency_ms, 0.5) OVER w, 6) AS rolling_median
FROM ({SPANS_SQL}) s
WINDOW w AS (PARTITION BY stage ORDER BY entry_us, pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")
def rolling_stage_stats_q(spark, sf_dir):
    # the mean is formed from an exact integer sum of hundredths, rounded half up to 1e-6,
    # so both engines produce the identical double
    s = spans(spark, sf_dir).withColumn("cents", F.round(F.col("latency_ms") * 100).cast("long"))
    r = T.rolling_frame(s, ["stage"], ["entry_us", "pos"], 100, {
        "_n": ("latency_ms", F.count), "_cs": ("cents", F.sum),
        "rolling_median": ("latency_ms", lambda c: F.percentile(c, 0.5))}, block=1 << 16)
    mean = F.floor((F.col("_cs") * 20000 + F.col("_n")) / (2 * F.col("_n"))) / 1e6
    return r.select("stage", "pos", mean.alias("rolling_mean"),
                    _r(F.col("rolling_median")).alias("rolling_median"))


ANNOT_SQL = f"""SELECT job_id, CASE stage WHEN 'signup' THEN 'Created' WHEN 'purchase' THEN 'Pushed' END AS name,
  entry_us AS ts_us FROM ({SPANS_SQL}) s"""


def _annot(spark, sf_dir):
    s = spans(spark, sf_dir)
    return s.select("job_id", F.when(F.col("stage") == "signup", "Created")
                    .when(F.col("stage") == "purchase", "Pushed").alias("name"), F.col("entry_us").alias("ts_us"))


@query("e2e_latency", operators=("H6",), sql=f"""
SELECT job_id, max(CASE WHEN name = 'Pushed' THEN ts_us END) - min(CASE WHEN name = 'Created' THEN ts_us END) AS e2e_us
FROM ({ANNOT_SQL}) a GROUP BY job_id
HAVING count_if(name = 'Pushed') > 0 AND count_if(name = 'Created') > 0""")
def e2e_latency_q(spark, sf_dir):
    return T.e2e_latency(_annot(spark, sf_dir)).select("job_id", "e2e_us")


def _push_fetch(spark, sf_dir):
    s = spans(spark, sf_dir)
    pushed = s.where(F.col("stage") == "purchase").select("job_id", F.col("exit_us").alias("ts_us"))
    # a response counts as collected by a slow click (latency over 90 ms)
    fetched = s.where((F.col("stage") == "click") & (F.col("latency_ms") > 90)).select(
        "job_id", F.col("entry_us").alias("ts_us"))
    return T.response_wait(pushed, fetched)


@query("response_wait", operators=("H7",), sql=f"""
SELECT p.job_id, f.f - p.p AS wait_us FROM
 (SELECT job_id, min(exit_us) AS p FROM ({SPANS_SQL}) s WHERE stage = 'purchase' GROUP BY job_id) p JOIN
 (SELECT job_id, min(entry_us) AS f FROM ({SPANS_SQL}) s WHERE stage = 'click' AND latency_ms > 90
  GROUP BY job_id) f USING (job_id)""")
def response_wait_q(spark, sf_dir):
    return _push_fetch(spark, sf_dir)[0].select("job_id", "wait_us")


@query("response_outstanding", operators=("H7",), sql=f"""
SELECT DISTINCT job_id FROM ({SPANS_SQL}) s WHERE stage = 'purchase'
  AND job_id NOT IN (SELECT job_id FROM ({SPANS_SQL}) s2 WHERE stage = 'click' AND latency_ms > 90)""")
def response_outstanding_q(spark, sf_dir):
    return _push_fetch(spark, sf_dir)[1].select("job_id")


@query("build_spans", operators=("H8",), sql=f"""
SELECT job_id, concat('job::', CAST(job_id AS VARCHAR)) AS span, NULL AS parent, min(entry_us) AS start_us,
       max(exit_us) AS end_us, 0 AS seq FROM ({SPANS_SQL}) s GROUP BY job_id
UNION ALL
SELECT job_id, concat(stage, '::', CAST(pos AS VARCHAR)), concat('job::', CAST(job_id AS VARCHAR)), entry_us, exit_us,
       row_number() OVER (PARTITION BY job_id ORDER BY entry_us, pos) FROM ({SPANS_SQL}) s""")
def build_spans_q(spark, sf_dir):
    return T.build_spans(spans(spark, sf_dir)).withColumn("seq", F.col("seq").cast("long"))


NAMED_SQL = f"""SELECT job_id, entry_us, exit_us, pos, stage,
  CASE WHEN pos = min(pos) OVER (PARTITION BY job_id, stage) THEN stage ELSE concat(stage, '::', CAST(pos AS VARCHAR)) END AS name FROM ({SPANS_SQL}) s"""


@query("build_span_tree", operators=("H8",), sql=f"""
WITH n AS ({NAMED_SQL}),
r AS (SELECT job_id, name AS task, CASE WHEN pos % 5 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS result FROM n WHERE pos % 3 <> 0)
SELECT job_id, concat('job::', CAST(job_id AS VARCHAR)) AS span, NULL AS parent, min(entry_us) AS start_us, max(exit_us) AS end_us, 0 AS seq, NULL AS status
FROM n GROUP BY job_id
UNION ALL
SELECT n.job_id, n.name, CASE WHEN n.name = n.stage THEN concat('job::', CAST(n.job_id AS VARCHAR)) ELSE n.stage END, n.entry_us, n.exit_us,
       row_number() OVER (PARTITION BY n.job_id ORDER BY n.entry_us, n.exit_us, n.name),
       CASE WHEN own.task IS NOT NULL THEN CASE m.result WHEN 'SUCCESS' THEN 'ok' WHEN 'FAILURE' THEN 'error' END END
FROM n LEFT JOIN r own ON own.job_id = n.job_id AND own.task = n.name LEFT JOIN r m ON m.job_id = n.job_id AND m.task = n.stage""")
def build_span_tree_q(spark, sf_dir):
    """A job's first event of a type is a main task, later ones its sub-tasks; two thirds have a result."""
    s = spans(spark, sf_dir).select("job_id", "entry_us", "exit_us", "pos", "stage")
    firsts = s.groupBy("job_id", "stage").agg(F.min("pos").alias("_first"))
    named = s.join(firsts, ["job_id", "stage"]).withColumn("name", F.when(F.col("pos") == F.col("_first"), F.col("stage")).otherwise(
        F.concat("stage", F.lit("::"), F.col("pos").cast("string"))))
    results = named.where(F.col("pos") % 3 != 0).select("job_id", F.col("name").alias("task"), F.when(F.col("pos") % 5 == 0, "FAILURE").otherwise("SUCCESS").alias("task_result"))
    return T.build_spans(named, results).withColumn("seq", F.col("seq").cast("long"))


@query("stage_report", operators=("H10",), sql=f"""
SELECT stage, round(avg(latency_ms), 6) AS avg_ms, round(sum(latency_ms), 6) AS total_ms,
       round(median(latency_ms), 6) AS median_ms,
       round(sum(latency_ms) / sum(sum(latency_ms)) OVER () * 100, 6) AS pct
FROM ({SPANS_SQL}) s GROUP BY stage
UNION ALL
SELECT 'unresolved', NULL, round((max(exit_us) - min(entry_us)) / 1000.0 - sum(latency_ms), 6), NULL, NULL
FROM ({SPANS_SQL}) s HAVING (max(exit_us) - min(entry_us)) / 1000.0 - sum(latency_ms) > 0""")
def stage_report_q(spark, sf_dir):
    r = T.stage_report(spans(spark, sf_dir))
    return r.select("stage", *[_r(F.col(c)).alias(c) for c in ("avg_ms", "total_ms", "median_ms", "pct")])


@query("throughput", operators=("H11",), sql=f"""
SELECT round(wall_s, 6) AS wall_s, n_files, n_pages, round(n_files / wall_s, 6) AS files_per_s,
       round(n_pages / wall_s, 6) AS pages_per_s
FROM (SELECT (max(exit_us) - min(entry_us)) / 1e6 AS wall_s, count(DISTINCT job_id) AS n_files,
             count(DISTINCT job_id) AS n_pages FROM ({SPANS_SQL}) s) t""")
def throughput_q(spark, sf_dir):
    t = T.throughput(spans(spark, sf_dir))
    return t.select(_r(F.col("wall_s")).alias("wall_s"), "n_files", "n_pages",
                    _r(F.col("files_per_s")).alias("files_per_s"), _r(F.col("pages_per_s")).alias("pages_per_s"))


@query("annotations", operators=("H17",), sql="""
SELECT job_id, task, arg_max(task_result, ts_us * 1e7 + pos) AS task_result, arg_max(message, ts_us * 1e7 + pos) AS message
FROM (SELECT user_id AS job_id, event_type AS task, event_id AS pos, epoch_us(ts) AS ts_us,
             CASE WHEN value > 50 THEN 'FAILURE' ELSE 'SUCCESS' END AS task_result, props AS message FROM events) a
GROUP BY job_id, task""")
def annotations_q(spark, sf_dir):
    e = tables.load(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("job_id"), F.col("event_type").alias("task"),
                    F.col("event_id").alias("pos"), T.to_micros("ts").alias("ts_us"),
                    F.when(F.col("value") > 50, "FAILURE").otherwise("SUCCESS").alias("task_result"),
                    F.col("props").alias("message"))
    return T.annotations(rows)
