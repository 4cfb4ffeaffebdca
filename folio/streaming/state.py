"""Stateful streaming operators: counters, rolling stage statistics, duplicate images,
fragment reassembly."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folio.operators.responses import reassemble_responses


def job_counts_stream(results: DataFrame) -> DataFrame:
    """Running submitted / completed / failed over the whole stream (complete mode)."""
    s = F.col("status")
    return results.groupBy().agg(F.count("*").alias("submitted"), F.count_if(s == "success").alias("completed"),
                                 F.count_if(s == "failed").alias("failed"))


def rolling_stage_stats_stream(values: DataFrame, window: int = 100) -> DataFrame:
    """Per stage, at every arrival: mean and median of the last ``window`` values, in
    arrival order (stage, pos, latency_ms). State per stage = the last ``window``
    values (bounded)."""
    out_schema = "stage string, pos long, rolling_mean double, rolling_median double"
    state_schema = "vals array<double>"

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        vals = list(state.get[0]) if state.exists else []
        outs = []
        for pdf in pdfs:
            pdf = pdf.sort_values("pos")
            for pos, v in zip(pdf["pos"].to_numpy(), pdf["latency_ms"].to_numpy(dtype=float)):
                vals.append(float(v))
                if len(vals) > window:
                    vals = vals[-window:]
                outs.append((key[0], int(pos), float(np.mean(vals)), float(np.median(vals))))
        state.update((vals,))
        yield pd.DataFrame(outs, columns=["stage", "pos", "rolling_mean", "rolling_median"])

    return values.groupBy("stage").applyInPandasWithState(
        fn, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)


def dedup_images_stream(images: DataFrame, watermark: str = "10 minutes", ts_col: str = "ts") -> DataFrame:
    """Streaming duplicate removal per job and content hash; the watermark bounds the
    state (a copy arriving later than the watermark is not recognised)."""
    return (images.withColumn("_h", F.md5(F.col("metadata.content")))
                  .withWatermark(ts_col, watermark)
                  .dropDuplicatesWithinWatermark(["job_id", "_h"]).drop("_h"))


_UNIT_MS = {"ms": 1, "millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000}


def _duration_ms(d) -> int:
    """``600000`` or ``"10 minutes"`` -> milliseconds."""
    if isinstance(d, (int, float)):
        return int(d)
    num, unit = d.split()
    unit = unit.lower().rstrip("s") if unit.lower() != "ms" else "ms"
    return int(float(num) * _UNIT_MS[unit])


class _Fragments(StatefulProcessor):
    """Which fragments of a job are here; the fragments themselves are rows of a table.

    A list of numbers, the job's header and one processing-time timer a job. A job that was put out
    leaves a mark for as long as the time-out, so a fragment delivered again does not open it anew."""

    def __init__(self, timeout_ms: int, key_type: str):
        self.timeout_ms, self.key_type = timeout_ms, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "fragment long")
        self.header = handle.getValueState("header", "status string, description string, count long, timer long")
        self.over = handle.getValueState("over", "at long", self.timeout_ms)

    def _out(self, key, status, description, fragments, now) -> pd.DataFrame:
        timer = self.header.get()[3]
        if timer is not None and timer > now:
            self.handle.deleteTimer(timer)
        self.seen.clear()
        self.header.clear()
        self.over.update((now,))
        return pd.DataFrame([(key[0], status, description, fragments)], columns=_JOB_COLUMNS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known = {r[0] for r in self.seen.get()}
        status, description, count, timer = self.header.get() if self.header.exists() else (None, None, None, None)
        new = []
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                count = int(r.fragment_count)
                if int(r.fragment) in known:
                    continue
                known.add(int(r.fragment))
                new.append((int(r.fragment),))
                if r.fragment == 0:
                    status, description = r.status, r.description
        if self.over.exists():
            return
        if timer is not None:
            self.handle.deleteTimer(timer)
        self.header.update((status, description, count, None))
        if count is not None and len(known) >= count:
            yield self._out(key, status, description, len(known), now)
            return
        if new:
            self.seen.appendList(new)
        self.handle.registerTimer(now + self.timeout_ms)
        self.header.update((status, description, count, now + self.timeout_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.header.exists():
            yield self._out(key, "failed", TIMED_OUT, sum(1 for _ in self.seen.get()), timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


_JOB_COLUMNS = ["job_id", "status", "description", "fragments"]
TIMED_OUT = "Timed out waiting for all fragments"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def track_fragments(fragments: DataFrame, timeout="10 minutes") -> DataFrame:
    """Jobs of a stream of fragments (job_id, fragment, fragment_count, status, description), each when its
    last fragment is here: (job_id, status, description, fragments); a job without new fragments for
    ``timeout`` of processing time comes out as failed. The session must keep state in RocksDB."""
    kind = fragments.schema["job_id"].dataType.simpleString()
    thin = fragments.select("job_id", F.col("fragment").cast("long").alias("fragment"), F.col("fragment_count").cast("long").alias("fragment_count"), "status", "description")
    return thin.groupBy("job_id").transformWithStateInPandas(
        _Fragments(_duration_ms(timeout), kind), f"job_id {kind}, status string, description string, fragments long", "Append", "ProcessingTime")


def store_fragments(fragments: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream of fragment rows, ``data`` included, to a table that all readers share."""
    writer = fragments.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def reassemble_stream(spark: SparkSession, table: str, schema, out: str, checkpoint: str, timeout="10 minutes", **trigger) -> StreamingQuery:
    """Jobs from the fragment table that :func:`store_fragments` fills, written to ``out`` when they are
    complete: (job_id, status, description, data), ``data`` in fragment order, every fragment once; and
    jobs that timed out, failed, without data.

    The stream reads only the numbers of fragments; what they hold stays in the table and is joined
    to the jobs that a batch completes. A batch that runs again replaces its own files."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    jobs = track_fragments(spark.readStream.schema(schema).parquet(table), timeout)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        done = batch.where(F.col("description").isNull() | (F.col("description") != TIMED_OUT))
        rows = spark.read.schema(schema).parquet(table)
        whole = reassemble_responses(rows.join(done.select(F.col("job_id").alias("_job")), F.col("job_id").eqNullSafe(F.col("_job")), "left_semi"))
        late = batch.where(F.col("description") == TIMED_OUT).select("job_id", "status", "description", F.lit(None).cast(whole.schema["data"].dataType).alias("data"))
        result = whole.select("job_id", "status", "description", "data").unionByName(late)
        result.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")
        batch.unpersist()

    writer = jobs.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()
