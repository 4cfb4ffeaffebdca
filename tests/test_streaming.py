"""Streaming operators driven to completion from files (memory sink)."""

import json
import os
import tempfile

from folio.streaming import jobs as SJ
from folio.streaming import state as SS


def _run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()


def test_rolling_stats_stream_and_counters(spark):
    d = tempfile.mkdtemp(prefix="folio-stream-")
    rows = [("s", i, float(v)) for i, v in enumerate([10, 20, 30, 40])] + [("t", 10, 5.0)]
    spark.createDataFrame(rows, "stage string, pos long, latency_ms double").write.mode("overwrite").parquet(d + "/in")
    src = spark.readStream.schema("stage string, pos long, latency_ms double").parquet(d + "/in")
    _run(SS.rolling_stage_stats_stream(src, window=3), "roll")
    got = {(r.stage, r.pos): (r.rolling_mean, r.rolling_median) for r in spark.sql("select * from roll").collect()}
    assert got[("s", 3)] == (30.0, 30.0) and got[("s", 0)] == (10.0, 10.0) and got[("t", 10)] == (5.0, 5.0)

    res = spark.createDataFrame([(1, "success"), (2, "failed"), (3, None)], "job_id long, status string")
    res.write.mode("overwrite").parquet(d + "/res")
    rs = spark.readStream.schema("job_id long, status string").parquet(d + "/res")
    _run(SS.job_counts_stream(rs), "counts", mode="complete")
    c = spark.sql("select * from counts").first()
    assert (c.submitted, c.completed, c.failed) == (3, 1, 1)


def test_job_stream_keeps_failed_and_drops_anonymous(spark):
    d = tempfile.mkdtemp(prefix="folio-jobs-")
    good = {"job_id": "a", "job_payload": {"content": ["x"], "source_name": ["n"], "source_id": ["i"],
                                           "document_type": ["PDF"]}, "tasks": [], "tracing_options": {"ts_send": 1}}
    bad = {"job_id": "b", "job_payload": {"content": ["x", "y"], "source_name": ["n"], "source_id": ["i"],
                                          "document_type": ["pdf"]}}
    with open(os.path.join(d, "jobs.json"), "w") as fh:
        fh.write(json.dumps(good) + "\n" + json.dumps(bad) + "\n" + json.dumps({"job_payload": {}}) + "\n")
    _run(SJ.read_job_stream(spark, d), "jobs_in")
    got = {r.job_id: (r.cm_failed, r.response_channel) for r in spark.sql("select * from jobs_in").collect()}
    assert got == {"a": (False, "response_a"), "b": (True, "response_b")}


def test_write_vector_stream_idempotent_batches(spark):
    from folio.streaming.sinks import write_vector_stream
    d = tempfile.mkdtemp(prefix="folio-vec-")
    rows = [(i, f"t{i}", [float(i), 1.0], "{}") for i in range(7)]
    spark.createDataFrame(rows, "pk long, text string, vector array<double>, source string") \
        .write.mode("overwrite").parquet(d + "/in")
    src = spark.readStream.schema("pk long, text string, vector array<double>, source string").parquet(d + "/in")
    q = write_vector_stream(src, d + "/table", d + "/ckpt", batch_size=3)
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(d + "/table")
    assert sorted(r.pk for r in out.collect()) == list(range(7))


def test_dedup_images_stream(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    d = tempfile.mkdtemp(prefix="folio-dedup-")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, i, "same" if i < 3 else "other", t0 + dt.timedelta(seconds=i)) for i in range(4)] + \
           [(2, 9, "same", t0)]
    spark.createDataFrame(rows, "job_id long, pos long, content string, ts timestamp") \
        .write.mode("overwrite").parquet(d + "/in")
    src = spark.readStream.schema("job_id long, pos long, content string, ts timestamp").parquet(d + "/in")
    src = src.withColumn("metadata", F.struct(F.col("content").alias("content")))
    _run(SS.dedup_images_stream(src, "1 hour").select("job_id", "pos"), "dedup_out")
    got = sorted((r.job_id, r.pos) for r in spark.sql("select * from dedup_out").collect())
    assert len(got) == 3 and (1, 3) in got and (2, 9) in got


def test_watch_files(spark):
    d = tempfile.mkdtemp(prefix="folio-watch-")
    for name in ("a.txt", "b.pdf"):
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(name.encode())
    _run(SJ.watch_files(spark, d, max_files=1).select("path", "length"), "watched")
    got = sorted(os.path.basename(r.path) for r in spark.sql("select * from watched").collect())
    assert got == ["a.txt", "b.pdf"]


def test_reassemble_stream_puts_data_together(spark, tmp_path):
    import time

    schema = "job_id long, fragment long, fragment_count long, status string, description string, data array<string>"
    table, out = str(tmp_path / "table"), str(tmp_path / "out")

    def arrive(rows):
        source = str(tmp_path / "in")
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        q = SS.store_fragments(spark.readStream.schema(schema).parquet(source), table, str(tmp_path / "c1"), availableNow=True)
        q.awaitTermination(60)

    arrive([(5, 1, 2, "success", "d", ["y", "z"]), (6, 0, 2, "success", "x", ["w"]), (7, 0, 3, "success", "late", ["l"])])
    q = SS.reassemble_stream(spark, table, schema, out, str(tmp_path / "c2"), timeout="25 seconds", processingTime="1 second")
    try:
        arrive([(5, 1, 2, "success", "d", ["y", "z"]), (5, 0, 2, "success", "d0", ["x"]), (6, 0, 2, "success", "x", ["w"]), (7, 1, 3, "success", "n", ["m"])])
        arrive([(6, 1, 2, "success", "n", ["v"]), (5, 0, 2, "success", "d0", ["x"])])
        got, until = [], time.time() + 120
        while time.time() < until and len(got) < 3:
            assert q.exception() is None
            time.sleep(2)
            if os.path.isdir(out):
                got = spark.read.schema("job_id long, status string, description string, data array<string>").parquet(out + "/*").collect()
    finally:
        q.stop()
    assert sorted((r.job_id, r.status, r.description, r.data) for r in got) == [
        (5, "success", "d0", ["x", "y", "z"]), (6, "success", "x", ["w", "v"]), (7, "failed", SS.TIMED_OUT, None)]
