"""Job intake: what breaks which rule, in batches and in a stream."""

import json

import pytest
from pyspark.sql import functions as F

from folio.operators import intake
from folio.streaming import jobs as SJ

PAYLOAD = {"content": ["c1", "c2"], "source_name": ["n1", "n2"], "source_id": ["id1", 2], "document_type": ["pdf", "text"]}
SPLIT = {"split_by": "sentence", "split_length": 10, "split_overlap": 0, "max_character_length": 100, "sentence_window_size": None}
GOOD = [
    {"type": "split", "task_properties": SPLIT}, {"type": "SPLIT", "task_properties": {"split_by": "word", "split_length": "100", "split_overlap": 0}},
    {"type": "eXtRaCt", "task_properties": {"document_type": "PDF", "method": "m", "params": {}}, "raise_on_failure": True},
    {"type": "store", "task_properties": {"images": True, "structured": True, "method": "minio", "params": {"endpoint": "e"}}},
    {"type": "embed", "task_properties": {"text": True, "tables": "yes"}}, {"type": "vdb_upload", "task_properties": {}}, {"type": "caption", "task_properties": {"n_neighbors": 3}},
    {"type": "filter", "task_properties": {"content_type": "image", "params": {"min_size": 256, "max_aspect_ratio": 5.0, "min_aspect_ratio": 0.2, "filter": True}}},
    {"type": "dedup", "task_properties": {"content_type": "image", "params": {"filter": True}}},
]


def job(**changes):
    out = {"job_payload": PAYLOAD, "job_id": "123", "tasks": GOOD} | changes
    return {k: v for k, v in out.items() if v != "absent"}


def task(kind, props, **more):
    return job(tasks=[{"type": kind, "task_properties": props} | more])


CASES = [
    (job(), []), (job(job_id=7), []), (job(tracing_options={"trace": True, "ts_send": 5, "trace_id": None}), []), (job(tasks=[]), []),
    (job(tasks="absent"), ["job: missing tasks"]), (job(job_payload="absent"), ["job: missing job_payload"]), (job(extra=1), ["job: unknown field extra"]),
    (job(job_payload="text", tasks="text"), ["job: job_payload must be object", "job: tasks must be array"]),
    (job(job_payload=PAYLOAD | {"content": "c"}), ["payload: content must be strings"]), (job(job_payload=PAYLOAD | {"more": []}), ["payload: unknown field more"]),
    (job(job_payload=PAYLOAD | {"source_id": ["only"]}), ["payload: lists of different lengths"]), (job(job_payload=PAYLOAD | {"document_type": [1, 2]}), ["payload: document_type must be strings"]),
    (job(tracing_options={"trace": True}), ["tracing_options: missing ts_send"]), (job(tracing_options={"ts_send": "soon"}), ["tracing_options: ts_send must be int"]),
    (task("split", SPLIT | {"split_length": {"not": 1}}), ["split: split_length must be int > 0"]), (task("split", SPLIT | {"split_length": 0}), ["split: split_length must be int > 0", "split: split_overlap must be < split_length"]),
    (task("split", {"split_by": "sentence", "split_overlap": 0}), ["split: missing split_length"]), (task("split", SPLIT | {"split_overlap": -1}), ["split: split_overlap must be int >= 0"]),
    (task("split", SPLIT | {"split_by": "word", "sentence_window_size": 5}), ["split: sentence_window_size needs split_by sentence"]),
    (task("split", SPLIT | {"split_by": "page"}), ["split: split_by must be one of word, sentence, passage"]), (task("split", SPLIT | {"color": 1}), ["split: unknown field color"]),
    (task("extract", {"document_type": "xyz", "method": 1, "params": []}), ["extract: document_type must be one of", "extract: method must be string", "extract: params must be object"]),
    (task("filter", {"params": {"min_size": "big", "size": 1}}), ["filter: params: unknown field size", "filter: params: min_size must be int"]),
    (task("filter", {"content_type": "sound"}), ["filter: content_type must be content type"]), (task("dedup", {"params": {"filter": 3}}), ["dedup: params: filter must be flag"]),
    (task("embed", {"text": "maybe"}), ["embed: text must be flag"]), (task("fly", {}), ["task: unknown type fly"]), (job(tasks=[{"type": "split"}]), ["task: missing task_properties"]),
    (job(tasks=[{"task_properties": {}}]), ["task: missing type"]), (job(tasks=[{"type": 5, "task_properties": {}}]), ["task: type must be string"]), (job(tasks=["split"]), ["task: missing"]),
    (task("embed", {}, raise_on_failure="perhaps", x=1), ["task: unknown field x", "task: raise_on_failure must be flag"]),
]


def test_every_rule(spark):
    rows = [(i, json.dumps(c)) for i, (c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, value string")
    got = {r.i: r.v for r in df.select("i", intake.job_violations(F.try_parse_json("value")).alias("v")).collect()}
    for i, (c, want) in enumerate(CASES):
        assert bool(got[i]) == bool(want), (c, got[i])
        assert all(any(w in v for v in got[i]) for w in want), (c, got[i])


def test_jobs_without_an_id_go_and_bad_ones_are_answered(spark):
    values = [json.dumps(job(job_id="ok")), json.dumps(job(job_id="bad", tasks="x")), json.dumps(job(job_id="absent")), "not json", "[1]", json.dumps(job(job_id=12)), None, "{}"]
    jobs = intake.parse_jobs(spark.createDataFrame([(v,) for v in values], "value string"))
    rows = {r.job_id: r for r in jobs.collect()}
    assert set(rows) == {"ok", "bad", "12"} and not rows["ok"].cm_failed and rows["bad"].cm_failed and rows["ok"].response_channel == "response_ok"
    assert rows["ok"].job_payload.source_id == ["id1", "2"] and len(rows["ok"].tasks) == len(GOOD)
    sent = intake.failed_responses(jobs).collect()
    assert [(r.job_id, r.status) for r in sent] == [("bad", "failed")] and "tasks must be array" in sent[0].description
    assert {r.job_id for r in intake.accepted(jobs).collect()} == {"ok", "12"}


def test_stream_intake_gives_the_same(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/jobs.json").write_text("\n".join(json.dumps(c | {"job_id": f"j{i}"}) for i, (c, _) in enumerate(CASES)))
    q = SJ.read_job_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("intake_rules").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.job_id: r.cm_failed for r in spark.sql("SELECT job_id, cm_failed FROM intake_rules").collect()}
    assert got == {f"j{i}": bool(want) for i, (_, want) in enumerate(CASES)}


@pytest.mark.parametrize("value", ["{}", '{"job_id": null}', '{"job_id": {"a": 1}}'])
def test_no_id(spark, value):
    assert intake.parse_jobs(spark.createDataFrame([(value,)], "value string")).where("NOT cm_failed").count() == 0
