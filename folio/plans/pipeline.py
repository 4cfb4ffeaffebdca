"""A task list -> one composed, lazy DataFrame plan in the reference's fixed stage order.

Stage order is fixed by the pipeline, not by the task list: metadata and extract -> dedup -> filter -> split ->
embed -> store -> vdb_upload. A task that has no stage here (caption needs a model), or whose stage lacks what it
needs (``registry``, ``vector_table``), is an error, never skipped. Jobs that have failed skip all stages after that. Tasks are literal (the same
for every job, as the command line attaches them); a job whose ``tasks`` column lacks a
task skips that stage (``route_by_task``) when ``gate_by_job_tasks`` is set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators import chunk, dedup, embed, extract, filters, metadata, vectors
from folio.operators.filters import has_task, route_by_task, skip_failed
from folio.session import cut_lineage
from folio.sources import sinks

STAGE_ORDER = ["extract", "dedup", "filter", "split", "embed", "store", "vdb_upload"]


def run_tasks(jobs: DataFrame, tasks: list[dict], gate_by_job_tasks: bool = False,
              embedder=None, registry: dict | None = None, vector_table: str | None = None) -> DataFrame:
    """jobs (job_id, pos, document_type, content, source_id, source_name [, tasks]) ->
    elements after the listed tasks. ``tasks``: [{"type": ..., "task_properties": {...}}]; there may be an
    ``extract`` for each document type. ``registry``: parsers by type or (type, method); ``vector_table``: where
    ``vdb_upload`` writes the embedded rows."""
    names = [t["type"].lower() for t in tasks]
    by_type = {n: t.get("task_properties", {}) or {} for n, t in zip(names, tasks)}
    unknown = set(names) - set(STAGE_ORDER)
    if unknown:
        raise ValueError(f"task types that no stage runs: {sorted(unknown)}")
    twice = sorted({n for n in names if names.count(n) > 1 and n != "extract"})
    if twice:
        raise ValueError(f"several tasks of one type: {twice}")
    el = _extracted(jobs, [t.get("task_properties") or {} for t in tasks if t["type"].lower() == "extract"], gate_by_job_tasks, registry)

    def stage(name, op):
        nonlocal el
        if name not in by_type:
            return
        run = (lambda d: route_by_task(d, name, op)) if gate_by_job_tasks and "tasks" in el.columns else op
        el = skip_failed(el, run) if "cm_failed" in el.columns else run(el)

    if "dedup" in by_type:
        stage("dedup", lambda d: dedup.dedup_images(d, drop=bool(by_type["dedup"].get("params", {}).get("filter"))))
    if "filter" in by_type:
        fp = by_type["filter"].get("params", {})
        stage("filter", lambda d: filters.filter_images(
            d, fp.get("min_size", 128), fp.get("max_aspect_ratio", 5.0), fp.get("min_aspect_ratio", 0.2),
            drop=bool(fp.get("filter", False))))
    if "split" in by_type:
        sp = {**chunk.SPLIT_DEFAULTS, **by_type["split"]}
        stage("split", lambda d: chunk.split_documents(
            d, sp["split_by"], sp["split_length"], sp["split_overlap"], sp["max_character_length"],
            sp["sentence_window_size"] or 0))
    if "embed" in by_type:
        ep = by_type["embed"]
        stage("embed", lambda d: embed.merge_embedded(embed.embed_elements(
            d, embedder, text=ep.get("text", True), tables=ep.get("tables", True),
            filter_errors=ep.get("filter_errors", False))))
    if "store" in by_type:
        st = by_type["store"]
        params = st.get("params", {})
        if "base_uri" not in params:
            raise ValueError("store task needs params.base_uri (a shared object store or file system)")
        stage("store", lambda d: sinks.store_objects(
            d, params["base_uri"], params.get("bucket", "ingest"),
            structured=st.get("structured", True), images=st.get("images", False)))
    if "vdb_upload" in by_type:
        if vector_table is None:
            raise ValueError("vdb_upload needs vector_table, the table that takes the vectors")
        el = cut_lineage(el, "table")  # written below and returned
        good = el.where(~F.coalesce(F.col("cm_failed"), F.lit(False))) if "cm_failed" in el.columns else el
        if gate_by_job_tasks and "tasks" in el.columns:
            good = good.where(F.coalesce(has_task("vdb_upload"), F.lit(False)))
        sinks.write_vectors(vectors.to_vector_rows(good, drop_filtered=by_type["vdb_upload"].get("filter_errors", True)), vector_table)
    return el


def _extracted(jobs: DataFrame, extracts: list[dict], gated: bool, registry: dict | None) -> DataFrame:
    """Elements of all jobs: documents of the types that an ``extract`` task names are parsed, others (texts
    go straight to the splitter) get their metadata as they are."""
    rest, parts = jobs, []
    for props in extracts:
        kind = str(props.get("document_type", "")).lower()
        mine = F.lower("document_type") == kind
        if gated and "tasks" in jobs.columns:
            mine = mine & has_task("extract", {"document_type": props.get("document_type")})
        mine = F.coalesce(mine, F.lit(False))
        own, rest = rest.where(mine), rest.where(~mine)
        params = {k.removeprefix("extract_"): v for k, v in (props.get("params") or {}).items()}
        parts.append((own, extract.extract_elements(own, registry, props.get("method"), **params)))
    el = metadata.inject_metadata(rest)
    if parts and "cm_failed" not in el.columns:
        el = el.withColumn("cm_failed", F.lit(False))
    for own, found in parts:
        if "tasks" in jobs.columns:
            of = own.select(F.col("job_id").alias("_job"), "tasks").dropDuplicates(["_job"])
            found = found.join(of, F.col("job_id").eqNullSafe(F.col("_job")), "left").drop("_job")
        el = el.unionByName(found, allowMissingColumns=True)
    if parts:  # a job fails as a whole
        bad = el.where("cm_failed").select(F.col("job_id").alias("_job")).distinct().withColumn("_bad", F.lit(True))
        el = el.join(bad, F.col("job_id").eqNullSafe(F.col("_job")), "left").withColumn("cm_failed", F.coalesce("_bad", F.lit(False))).drop("_job", "_bad")
    return el
