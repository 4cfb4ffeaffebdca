"""Job intake: JSON text against the job rules, with what is wrong as data.

A job is parsed as VARIANT, so every field keeps the type it was sent with; the rules below are a
table of fields, and a job's violations are one array column, an expression over its row: no
exception, no shuffle, the same in batches and streams. Jobs with violations become failed
responses for their senders; what has no ``job_id`` has no sender and is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio import schema as S
from folio.operators.responses import DESC_FAILED

# The fields of a job and of each task's properties, their kinds, and (True) the required ones
JOB_FIELDS = {"job_payload": ("object", True), "job_id": ("id", True), "tasks": ("array", True), "tracing_options": ("object", False)}
PAYLOAD_FIELDS = {"content": ("strings", True), "source_name": ("strings", True), "source_id": ("ids", True), "document_type": ("strings", True)}
TRACING_FIELDS = {"trace": ("flag", False), "ts_send": ("int", True), "trace_id": ("string", False)}
TASK_FIELDS = {"type": ("string", True), "task_properties": ("object", True), "raise_on_failure": ("flag", False)}
PROPERTIES = {
    "split": {"split_by": ("one of word|sentence|passage", True), "split_length": ("int > 0", True), "split_overlap": ("int >= 0", True),
              "max_character_length": ("int > 0", False), "sentence_window_size": ("int >= 0", False)},
    "extract": {"document_type": ("one of pdf|text|txt|docx|pptx|jpeg|bmp|png|svg|html|md|sh|json|tiff|jpg", True), "method": ("string", True), "params": ("object", True)},
    "store": {"structured": ("flag", False), "images": ("flag", False), "method": ("string", True), "params": ("object", True)},
    "caption": {"content_type": ("string", False), "n_neighbors": ("int", False)},
    "filter": {"content_type": ("content type", False), "params": ("object", False)},
    "dedup": {"content_type": ("content type", False), "params": ("object", False)},
    "embed": {"text": ("flag", False), "tables": ("flag", False), "filter_errors": ("flag", False)},
    "vdb_upload": {"filter_errors": ("flag", False)},
}
PARAMS = {
    "filter": {"min_size": ("int", False), "max_aspect_ratio": ("number", False), "min_aspect_ratio": ("number", False), "filter": ("flag", False)},
    "dedup": {"filter": ("flag", False)},
}
_INT, _NUMBER = r"^\s*[+-]?\d+\s*$", r"^\s*[+-]?(\d+([.]\d*)?|[.]\d+)([eE][+-]?\d+)?\s*$"
_FLAG = r"(?i)^(true|false|yes|no|on|off|t|f|y|n|1|0)$"


def _part(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def _type(v: Column) -> Column:
    """What the value is: OBJECT, ARRAY, STRING, BOOLEAN, VOID or a number's type; null where it is absent."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _is(v: Column, kind: str) -> Column:
    """Whether a value that is there is of the kind; a number may come as text, as may a flag."""
    t, s = _type(v), _text(v)
    number = t.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
    whole = number & (s.try_cast("double") == F.floor(s.try_cast("double"))) | (t == "STRING") & s.rlike(_INT)
    if kind.startswith("int"):
        bound = kind.partition(" ")[2]
        value = s.try_cast("double")
        return whole & (value > 0 if bound == "> 0" else value >= 0) if bound else whole
    if kind == "number":
        return number | (t == "STRING") & s.rlike(_NUMBER)
    if kind == "flag":
        return (t == "BOOLEAN") | number & s.isin("0", "1") | (t == "STRING") & s.rlike(_FLAG)
    if kind == "string":
        return t == "STRING"
    if kind == "id":
        return (t == "STRING") | whole
    if kind in ("object", "array"):
        return t == kind.upper()
    if kind in ("strings", "ids"):
        items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
        return (t == "ARRAY") & F.forall(items, lambda x: F.coalesce(_is(x, kind[:-1]), F.lit(False)))
    if kind == "content type":
        return (t == "STRING") & F.lower(s).isin(*S.CONTENT_TYPES)
    if kind.startswith("one of "):
        return (t == "STRING") & F.lower(s).isin(*kind[7:].split("|"))
    raise ValueError(kind)


def _fields(v: Column, name: str, fields: dict) -> list[Column]:
    """Violations of an object: fields that are missing, of another kind, or not known."""
    keys = F.json_object_keys(F.to_json(v))
    out = [F.when(F.exists(keys, lambda k: ~k.isin(*fields)), F.concat(F.lit(f"{name}: unknown field "), F.array_join(F.array_except(keys, F.array(*map(F.lit, fields))), ", ")))]
    for key, (kind, required) in fields.items():
        part = _part(v, key)
        missing = part.isNull() | (_type(part) == "VOID")
        wrong = F.when(~F.coalesce(_is(part, kind), F.lit(False)), F.lit(f"{name}: {key} must be {kind.replace('|', ', ')}"))
        out.append(F.when(missing, F.lit(f"{name}: missing {key}") if required else F.lit(None).cast("string")).otherwise(wrong))
    return out


def _task_violations(task: Column) -> Column:
    kind = F.lower(_text(_part(task, "type")))
    props = _part(task, "task_properties")
    msgs = _fields(task, "task", TASK_FIELDS)
    msgs.append(F.when(_type(_part(task, "type")).isin("STRING") & ~kind.isin(*PROPERTIES), F.concat(F.lit("task: unknown type "), kind)))
    for name, fields in PROPERTIES.items():
        mine = (kind == name) & (_type(props) == "OBJECT")
        msgs += [F.when(mine, m) for m in _fields(props, name, fields)]
        if name in PARAMS:
            params = _part(props, "params")
            msgs += [F.when(mine & (_type(params) == "OBJECT"), m) for m in _fields(params, f"{name}: params", PARAMS[name])]
    size = _text(_part(props, "sentence_window_size")).try_cast("double")
    by = F.lower(_text(_part(props, "split_by")))
    msgs.append(F.when((kind == "split") & (size > 0) & (by != "sentence"), F.lit("split: sentence_window_size needs split_by sentence")))
    length, overlap = (_text(_part(props, f"split_{x}")).try_cast("double") for x in ("length", "overlap"))
    msgs.append(F.when((kind == "split") & (overlap >= length), F.lit("split: split_overlap must be < split_length")))
    return F.array_compact(F.array(*msgs))


def job_violations(job: Column) -> Column:
    """Array of what is wrong with a job given as VARIANT (null: not JSON)."""
    payload, tasks, tracing = _part(job, "job_payload"), _part(job, "tasks"), _part(job, "tracing_options")
    msgs = [F.when(job.isNull(), F.lit("job: not JSON")), F.when(_type(job) != "OBJECT", F.lit("job: not an object"))]
    top = _type(job) == "OBJECT"
    msgs += [F.when(top, m) for m in _fields(job, "job", JOB_FIELDS)]
    msgs += [F.when(_type(payload) == "OBJECT", m) for m in _fields(payload, "payload", PAYLOAD_FIELDS)]
    msgs += [F.when(_type(tracing) == "OBJECT", m) for m in _fields(tracing, "tracing_options", TRACING_FIELDS)]
    sizes = [F.size(F.try_variant_get(payload, f"$.{k}", "array<variant>")) for k in PAYLOAD_FIELDS]
    uneven = sizes[0] != sizes[1]
    for s in sizes[2:]:
        uneven = uneven | (s != sizes[0])
    msgs.append(F.when(uneven, F.lit("payload: lists of different lengths")))
    each = F.when(_type(tasks) == "ARRAY", F.flatten(F.transform(F.try_variant_get(tasks, "$", "array<variant>"), _task_violations)))
    return F.concat(F.array_compact(F.array(*msgs)), F.coalesce(each, F.array().cast("array<string>")))


def parse_jobs(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> job rows: parsed columns, ``response_channel``, ``violations`` and ``cm_failed``.

    A job that has a ``job_id`` but breaks a rule is kept as failed; one without a ``job_id`` is dropped
    (nobody could receive its answer). A payload's document types are free text: one that no stage
    knows fails where it is used, not here."""
    raw = F.col(value_col)
    v = F.try_parse_json(raw)
    parsed = F.from_json(raw, S.JOB, {"mode": "PERMISSIVE"})
    jid = _part(v, "job_id")
    name = F.when(F.coalesce(_is(jid, "id"), F.lit(False)), _text(jid)).otherwise(F.get_json_object(raw, "$.job_id"))
    j = df.select(parsed.alias("j"), name.alias("job_id"), job_violations(v).alias("violations")).where(F.col("job_id").isNotNull())
    return j.select("job_id", F.col("j.job_payload").alias("job_payload"), F.col("j.tasks").alias("tasks"), F.col("j.tracing_options").alias("tracing_options"),
                    F.concat(F.lit("response_"), F.col("job_id")).alias("response_channel"), (F.size("violations") > 0).alias("cm_failed"), "violations")


def failed_responses(jobs: DataFrame) -> DataFrame:
    """The side output of intake: a failed response for each job with violations, which say why."""
    reason = F.concat(F.lit(DESC_FAILED + " "), F.array_join("violations", "; "))
    return jobs.where("cm_failed").select("job_id", "response_channel", F.lit("failed").alias("status"), reason.alias("description"),
                                          F.lit(0).alias("fragment"), F.lit(1).alias("fragment_count"))


def accepted(jobs: DataFrame) -> DataFrame:
    """Jobs that go on to the stages."""
    return jobs.where(~F.col("cm_failed"))
