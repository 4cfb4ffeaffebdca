"""Inputs that the driver tables don't hold: equal positions in several jobs, oversize items, text where numbers belong."""

import json

import pytest
from pyspark.sql import functions as F

from folio import session
from folio.functions.predicates import is_subset
from folio.operators import assemble, chunk, dedup, detect, embed, extract, layout, metadata, ranking, responses, sampling, validate, vectors
from folio.plans import pipeline
from folio.sources import sinks


def test_corpus_dedup_keeps_one_of_equal_positions(spark):
    df = metadata.inject_metadata(spark.createDataFrame([(j, 0, "png", "same", "s", "n") for j in ("a", "b", "c")] + [("d", 5, "png", "other", "s", "n")],
                                                        "job_id string, pos long, document_type string, content string, source_id string, source_name string"))
    df = df.withColumn("document_type", F.lit("image"))
    assert sorted(r.job_id for r in dedup.dedup_images(df, drop=True, scope=()).collect()) == ["a", "d"]


def elements(spark, rows):
    """(job, pos, piece, chars) as elements."""
    df = spark.createDataFrame([(j, p, k, "é" * n) for j, p, k, n in rows], "job_id string, pos long, piece int, c string")
    return df.select("job_id", "pos", "piece", F.lit("text").alias("document_type"), F.struct(F.col("c").alias("content")).alias("metadata"))


def test_fragments_of_pieces_with_string_ids(spark):
    rows = [("a1", 0, k, 20) for k in range(6)] + [("big", 0, 0, 500), ("big", 1, 0, 1), ("small", 0, None, 1)]
    el = elements(spark, rows)
    fr = responses.fragment_responses(el, size_limit=400, overhead_bytes=0).collect()
    assert len(fr) == len(rows)
    assert len({r.fragment for r in fr if r.job_id == "a1"}) == 2  # 80-odd bytes each, not 60-odd characters
    jobs = spark.createDataFrame([(j, False) for j in ("a1", "big", "small")], "job_id string, cm_failed boolean")
    out = responses.build_responses(jobs, el, size_limit=400, overhead_bytes=0)
    big = sorted((r.fragment, r.fragment_count, len(r.data)) for r in out.where("job_id = 'big'").collect())
    assert big == [(0, 3, 0), (1, 3, 1), (2, 3, 1)]  # the oversize first item leaves an empty fragment
    whole = responses.reassemble_responses(out.union(out.where("fragment = 0 AND job_id = 'a1'").limit(0)))
    assert {r.job_id: len(r.data) for r in whole.collect()} == {"a1": 6, "big": 2, "small": 1}


def test_violations_instead_of_exceptions(spark):
    task = {"type": "split", "task_properties": json.dumps({"split_by": "word", "split_length": "ten", "split_overlap": "x"})}
    df = spark.createDataFrame([("a", {"document_type": ["pdf"]}, [task])],
                               "job_id string, job_payload struct<document_type:array<string>>, tasks array<struct<type:string,task_properties:string>>")
    assert "split: split_length must be > 0" in validate.validate_jobs(df).first().violations
    p = spark.createDataFrame([('{"a": "text"}',), ('{"a": 3}',)], "p string")
    assert [r[0] for r in p.select(F.coalesce(is_subset("p", {"a": 3}), F.lit(False))).collect()] == [False, True]


def test_embedding_needs_no_ids(spark):
    df = spark.createDataFrame([(1, 0, "text", "alpha", None), (1, 0, "structured", "aW1n", "table text"), (1, 1, "text", "", None)],
                               "job_id long, pos long, document_type string, content string, cells string")
    el = df.select("job_id", "pos", "document_type", F.lit(None).cast("string").alias("uuid"), F.col("content"), "cells")
    el = metadata.inject_metadata(el.withColumn("source_id", F.lit("s")).withColumn("source_name", F.lit("n")))
    el = el.withColumn("metadata", F.when(F.col("cells").isNotNull(), F.col("metadata").withField("table_metadata", F.from_json(
        F.concat(F.lit('{"table_content": "'), F.col("cells"), F.lit('"}')), el.schema["metadata"].dataType["table_metadata"].dataType.simpleString()))).otherwise(F.col("metadata")))
    done = embed.embed_elements(el, embed.hashing_embedder(8))
    assert done.count() == 3 and done.where("_contains_embeddings").count() == 2
    assert sorted(r.text for r in vectors.to_vector_rows(done).collect()) == ["alpha", "table text"]

    def broken(texts):
        raise RuntimeError("no model")

    bad = embed.embed_elements(el, broken)
    assert bad.where("document_type = 'info_message'").count() == 2 and bad.where("_contains_embeddings").count() == 0


def test_null_cells_keep_their_column(spark):
    df = spark.createDataFrame([(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 0, None), (1, 1, 1, "y")], "t long, row int, col int, text string")
    assert assemble.render_table(df, "csv", ("t",)).first()["table"] == ",a,b\n0,,y\n"


def test_pieces_do_not_carry_the_document(spark):
    df = metadata.inject_metadata(spark.createDataFrame([(1, 0, "text", "a b c d " * 50, "s", "n"), (2, 0, "text", None, "s", "n"), (3, 0, "png", "img", "s", "n")],
                                                        "job_id long, pos long, document_type string, content string, source_id string, source_name string"))
    out = chunk.split_documents(df, "word", 10, 0, None)
    pieces = out.where("job_id = 1").collect()
    assert len(pieces) > 5 and all(r.content is None and len(r.metadata.content) < 40 for r in pieces)
    assert out.where("job_id = 3").first().content == "img" and out.where("job_id = 2").first().metadata.error_metadata.status == "error"


def test_objects_appear_together_or_not_at_all(spark, tmp_path):
    from pyspark.errors import PySparkException

    from folio.sources import objects
    rows = spark.createDataFrame([(f"a b/{i}.png", bytes([i]) * 1000) for i in range(40)] + [("empty", None)], "key string, bytes binary").repartition(5)
    assert objects.write_objects(rows, f"file://{tmp_path}/x") == 41 and objects.write_objects(rows, str(tmp_path / "x")) == 41  # again: the same objects
    assert (tmp_path / "x/a b/7.png").read_bytes() == bytes([7]) * 1000 and (tmp_path / "x/empty").read_bytes() == b""
    assert len([f for f in (tmp_path / "x").rglob("*") if f.is_file()]) == 41 and not (tmp_path / "x/_uncommitted").exists()
    bad = rows.union(spark.createDataFrame([("../out", b"1")], "key string, bytes binary"))
    with pytest.raises(PySparkException):
        objects.write_objects(bad, str(tmp_path / "y"))
    assert not [f for f in (tmp_path / "y").rglob("*") if f.is_file()] and not (tmp_path / "out").exists()
    assert objects.write_objects(rows.limit(0), str(tmp_path / "z")) == 0
    with pytest.raises(ValueError):
        objects.write_objects(rows, "nosuch://store/x")


def test_files_by_content_type_are_cut_by_size(spark, tmp_path):
    rows = [(1, i, "text", f"t{i}", "big.pdf") for i in range(50)] + [(2, 0, "text", "u", "x/small.pdf"), (2, 1, "structured", "s", "x/small.pdf"), (3, 0, "text", "n", None)]
    df = metadata.inject_metadata(spark.createDataFrame(rows, "job_id long, pos long, document_type string, content string, source_id string").withColumn("source_name", F.col("source_id")))
    size = max(r[0] for r in df.select(F.length(F.to_json(F.struct("document_type", "metadata")))).collect()) + 1
    n = sinks.write_by_content_type(df, str(tmp_path / "out"), file_bytes=10 * size)
    files = {str(f.relative_to(tmp_path / "out")): json.loads(f.read_text()) for f in (tmp_path / "out").rglob("*.json")}
    assert n == len(files)
    big = [files[k] for k in sorted((k for k in files if "big" in k), key=lambda k: (len(k), k))]
    assert 5 <= len(big) <= 7 and [e["metadata"]["content"] for f in big for e in f] == [f"t{i}" for i in range(50)]
    assert {k for k in files if "big" not in k} == {"text/small.pdf.metadata.json", "unknown/small.pdf.metadata.json", "text/unknown.metadata.json"}


def test_no_scratch_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_leading_blank_runs_join_the_first_group(spark):
    df = spark.createDataFrame([("a", 0, 0, " ", False), ("a", 0, 1, "x", True), ("a", 0, 2, " ", False), ("a", 0, 3, "y", False), ("b", 0, 0, " ", True)],
                               "job_id string, paragraph int, pos int, text string, bold boolean")
    m = assemble.merge_styled_runs(df.withColumn("italic", F.lit(False)).withColumn("underline", F.lit(None).cast("boolean")))
    assert sorted((r.job_id, r.run_group, r.text, r.bold) for r in m.collect()) == [("a", 0, " x ", True), ("a", 1, "y", False), ("b", 0, " ", False)]


def test_sampling_with_replacement_fills_its_budget(spark):
    files = spark.createDataFrame([("a.pdf", 0, 100), ("b.md", 1, 30), ("c.md", 2, 50), ("d.md", 3, 0)], "path string, pos long, size long")
    got = sampling.sample_files(files, {"pdf": 50, "md": 40, "txt": 10}, 2000, replacement=True, seed=1)
    rows = got.collect()
    assert sum(r.size for r in rows if r.ext == "pdf") == 1000 and len([r for r in rows if r.ext == "pdf"]) == 10
    assert 750 < sum(r.size for r in rows if r.ext == "md") <= 800 and {r.path for r in rows if r.ext == "md"} == {"b.md", "c.md"}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sampling.sample_files(files.repartition(3), {"pdf": 50, "md": 40, "txt": 10}, 2000, replacement=True, seed=1).collect()))
    check = {r.ext: (r.achieved_bytes, r.ok) for r in sampling.check_sample(got, {"pdf": 50, "md": 40, "txt": 10}, 2000).collect()}
    assert check["txt"] == (0, False) and check["pdf"][0] == 1000
    assert [r.ok for r in sampling.check_sample(got.limit(0), {"pdf": 100}, 10).collect()] == [False]


def test_median_of_a_frequent_value(spark):
    df = spark.createDataFrame([("a", v) for v in [0.0] * 50 + [2.0, 3.0]] + [("b", 1.0), ("b", 2.0), ("c", 7.0), ("c", None), ("d", None)], "g string, v double")
    assert {r.g: r.m for r in ranking.exact_median(df, ["g"], "v", "m", num_slices=3).collect()} == {"a": 0.0, "b": 1.5, "c": 7.0}


def test_boxes_of_images_with_string_ids_in_any_order(spark):
    rows = [(f"i{i % 40}", i // 40, ("chart", "title", "table")[i % 3], (i % 7) / 10, (i % 5) / 10, (i % 7) / 10 + 0.3, (i % 5) / 10 + 0.3, (i % 11) / 11) for i in range(400)]
    df = spark.createDataFrame(rows, "image_id string, box_id long, label string, x1 double, y1 double, x2 double, y2 double, score double")
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    whole = sorted(map(tuple, detect.match_titles(detect.fuse_boxes(detect.nms(df))).collect()))
    try:
        spark.conf.set(conf, "7")  # images run over several batches
        cut = sorted(map(tuple, detect.match_titles(detect.fuse_boxes(detect.nms(df.orderBy("score")))).collect()))
    finally:
        spark.conf.set(conf, before)
    assert whole == cut and len({r[0] for r in whole}) == 40
    assert detect.nms(df.limit(0)).collect() == []


def test_figures_types_and_tasks(spark):
    paths = ["//Document/P", "//Document/Figure", "//Document/Figure/P", "//Document/Table/TR/P"]
    js = json.dumps([{"Path": p, "Text": "t", "Page": 0, "Bounds": [0, 0, 1, 1]} for p in paths])
    ce = extract.cloud_elements(spark.createDataFrame([("a1", js)], "job_id string, elements string")).collect()
    assert [(r.piece, r.kind) for r in ce] == [(0, "text"), (1, "image"), (3, "table")]
    jobs = spark.createDataFrame([("a1", "md", "x\n\ny"), ("a2", "odd", "z")], "job_id string, document_type string, content string")
    got = extract.extract_documents(jobs).collect()
    assert sorted((r.job_id, r.piece, r.text) for r in got) == [("a1", 0, "x"), ("a1", 1, "y"), ("a2", -1, None)]
    for tasks in ([{"type": "caption"}], [{"type": "filter"}, {"type": "filter"}]):
        with pytest.raises(ValueError):
            pipeline.run_tasks(jobs, tasks)


def test_plain_text_of_other_blanks_and_line_ends(spark):
    df = spark.createDataFrame([("#\u00a0T",), ("*a\u2028b*",), ("*a\nb*",)], "t string")
    assert [r[0] for r in df.select(layout.markdown_to_plain("t")).collect()] == ["T", "a\u2028b", "*a\nb*"]


def image_rows(spark, rows):
    """(job, pos, piece, content, page) as image elements."""
    from folio import schema as S
    from folio.functions.structs import build_struct
    df = spark.createDataFrame(rows, "job_id string, pos long, piece int, c string, page int")
    md = build_struct(S.METADATA, content=F.col("c"), content_metadata=build_struct(S.CONTENT_METADATA, page_number=F.col("page")))
    return df.select("job_id", "pos", "piece", F.lit("image").alias("document_type"), F.lit("u").alias("uuid"), md.alias("metadata"))


def test_dedup_keeps_every_row_that_is_no_copy(spark):
    rows = [("a", 0, None, None, 0), ("a", 1, None, None, 0), ("a", 2, None, "x", 0), (None, 0, None, "x", 0), (None, 1, None, "x", 0), ("b", 0, None, "x", 1), ("b", 0, None, "x", 0),
            ("b", 0, 1, "y", 0), ("b", 0, 0, "y", 0)] + [("same", 3, None, "z", 0)] * 5
    el = image_rows(spark, rows)
    tagged = dedup.dedup_images(el).collect()
    assert len(tagged) == len(rows)
    kept = sorted(((r.job_id or "", r.pos, r.piece, r.metadata.content, r.metadata.content_metadata.page_number) for r in tagged if r.document_type == "image"), key=str)
    want = sorted([("a", 0, None, None, 0), ("a", 1, None, None, 0), ("a", 2, None, "x", 0), ("", 0, None, "x", 0), ("b", 0, 0, "y", 0), ("same", 3, None, "z", 0)], key=str)
    assert [k for k in kept if k[:4] != ("b", 0, None, "x")] == want and sum(k[:4] == ("b", 0, None, "x") for k in kept) == 1
    assert sum(r.document_type == "info_message" for r in tagged) == 7
    assert dedup.dedup_images(el, drop=True).count() == 7 and dedup.dedup_images(el, drop=True, scope=()).count() == 5
    assert dedup.dedup_images(el.limit(0)).count() == 0


def test_search_leaves_broken_vectors_out(spark):
    v = spark.createDataFrame([("p1", [1.0, 0.0]), ("p2", None), ("p3", [1.0]), ("p4", [None, 1.0]), ("p5", [float("nan"), 1.0]), ("p6", [0.0, 2.0]), (None, [1.0, 0.0]), ("p7", [])],
                              "pk string, vector array<double>")
    q = spark.createDataFrame([("q1", [1.0, 0.0]), ("q2", None), ("q3", [1.0, 0.0, 0.0]), ("q4", [0.0, 1.0])], "query_id string, query array<double>")
    got = {(r.query_id, r.rank): r.pk for r in vectors.vector_search(v, q, k=5).collect()}
    assert got == {("q1", 1): "p1", ("q1", 2): "p6", ("q4", 1): "p6", ("q4", 2): "p1"}
    assert vectors.vector_search(v, q.limit(0)).count() == 0 and vectors.vector_search(v.limit(0), q).count() == 0


def test_draws_follow_the_bytes_wanted(spark):
    files = spark.createDataFrame([("a.pdf", 1, 0), ("b.pdf", 1_000_000, 1), ("c.pdf", 900_000, 2), ("d.txt", 10, 3)], "path string, size long, pos long")
    got = sampling.sample_files(files, {"pdf": 99.999, "txt": 0.001}, 200_000_000, replacement=True, seed=5).collect()
    pdf = sum(r.size for r in got if r.path.endswith("pdf"))
    assert 198_000_000 < pdf <= 199_998_000 and len(got) < 1000 and sum(r.size for r in got if r.path == "d.txt") == 2000
    made = sampling._draws(sampling.with_ext(files).withColumn("budget", F.lit(200_000_000.0)).where("ext = 'pdf'"), "path", 5).count()
    assert made < 800  # not budget / 1 byte


def test_dates_of_other_shapes(spark):
    from folio.functions.dates import parse_pdf_date
    want = {"D:20211222141131-07'00'": "2021-12-22T21:11:31", "D:20211222141131Z": "2021-12-22T14:11:31", "D:20211222141131+05'30": "2021-12-22T08:41:31", "D:20211222": "2021-12-22T00:00:00",
            "D:202112221411": "2021-12-22T14:11:00", "2021-12-22T14:11:31+02:00": "2021-12-22T12:11:31", "2021-12-22 14:11:31": "2021-12-22T14:11:31", "2021-12-22T14:11:31.25Z": "2021-12-22T14:11:31",
            "Wed Dec 22 14:11:31 2021": "2021-12-22T14:11:31", "Wednesday, December 22, 2021": "2021-12-22T00:00:00", "22 Dec 2021 14:11:31 +0100": "2021-12-22T13:11:31", "12/22/2021": "2021-12-22T00:00:00",
            "Dec 22nd 2021": "2021-12-22T00:00:00", "2021": "2021-01-01T00:00:00", "2021-12": "2021-12-01T00:00:00", "nonsense": None, "": None, None: None, "D:20211322000000Z": None}
    df = spark.createDataFrame([(k,) for k in want], "d string")
    got = {r.d: (r.u, r.k) for r in df.select("d", parse_pdf_date("d").alias("u"), parse_pdf_date("d", keep_tz=True).alias("k")).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert got["D:20211222141131-07'00'"][1] == "2021-12-22T14:11:31-07:00" and got["2021-12-22 14:11:31"][1] == "2021-12-22T14:11:31"


def test_violations_of_dates_tasks_and_states(spark):
    from folio import schema as S
    from folio.functions.structs import build_struct
    rows = [(0, "2021-12-22T14:11:31", "split", "error"), (1, "yesterday", "split", "error"), (2, None, "fly", "maybe")]
    df = spark.createDataFrame(rows, "i int, d string, task string, status string")
    md = build_struct(S.METADATA, source_metadata=build_struct(S.SOURCE_METADATA, source_id=F.lit("s"), date_created=F.col("d"), last_modified=F.lit("")),
                      content_metadata=build_struct(S.CONTENT_METADATA, type=F.lit("text")),
                      error_metadata=build_struct(S.ERROR_METADATA, task=F.col("task"), status=F.col("status")))
    got = {r.i: set(r.metadata_violations) for r in metadata.validate_metadata(df.select("i", md.alias("metadata"))).collect()}
    assert got == {0: set(), 1: {"source_metadata.date_created"}, 2: {"error_metadata.task", "error_metadata.status"}}


def test_list_prefix_table_tags_and_target_sizes(spark):
    runs = spark.createDataFrame([("a", True, True, 2), ("b", False, False, 1), ("c", None, True, None)], "text string, bold boolean, in_list boolean, level int")
    runs = runs.withColumns({"italic": F.lit(False), "underline": F.lit(False)})
    assert [r.markdown for r in assemble.render_markdown_text(runs).collect()] == ["    * **a**", "b", "* c"]
    cells = spark.createDataFrame([(j, t, r, c, "x") for j, t in ((1, 7), (1, 9), (2, 3)) for r in range(2) for c in range(2)], "job_id int, table_id int, row int, col int, text string")
    assert sorted((r.job_id, r.table_id, r.table) for r in assemble.render_table(cells, "tag").collect()) == [(1, 7, "<table 1>"), (1, 9, "<table 2>"), (2, 3, "<table 1>")]
    files = spark.createDataFrame([("a.pdf", 60), ("b.pdf", 20), ("c.txt", 20)], "path string, size long")
    got = {r.ext: (r.n_files, r.total_bytes, r.target_bytes) for r in sampling.dataset_stats(files, shares={"PDF": 50, "txt": 40, "md": 10}).collect()}
    assert got == {"pdf": (2, 80, 50.0), "txt": (1, 20, 40.0), "md": (0, 0, 10.0), None: (3, 100, None)}


def test_the_runner_extracts_uploads_and_skips_failed_jobs(spark, tmp_path):
    def pages(content, params):
        if content == "bad":
            raise ValueError("broken file")
        return [{"kind": "text", "text": f"{params['document_type']} {w}", "page": i} for i, w in enumerate(content.split())] + [{"kind": "image", "text": "img", "page": 0}, {"kind": "table", "text": "tab", "page": 1}]

    def shout(content, params):
        return [{"kind": "text", "text": content.upper(), "page": 0}]

    registry = {"pdf": pages, ("pdf", "shout"): shout, "docx": pages}
    rows = [("a", 0, "pdf", "one two", "p1"), ("a", 1, "text", "plain text here", "t1"), ("b", 0, "pdf", "bad", "p2"), ("b", 1, "text", "other text", "t2"), ("c", 0, "docx", "bad", "d1"), ("c", 1, "text", "third", "t3"), ("d", 0, "PDF", "x", None)]
    jobs = spark.createDataFrame(rows, "job_id string, pos long, document_type string, content string, source_id string").withColumn("source_name", F.col("source_id"))
    tasks = [{"type": "extract", "task_properties": {"document_type": "pdf", "method": "none", "params": {"extract_text": True, "extract_images": True, "extract_tables": True, "text_depth": "page"}}},
             {"type": "extract", "task_properties": {"document_type": "docx", "method": "m", "params": {}}},
             {"type": "split", "task_properties": {"split_by": "word", "split_length": 1, "split_overlap": 0}}, {"type": "embed", "task_properties": {}}, {"type": "vdb_upload", "task_properties": {}}]
    table = str(tmp_path / "vectors")
    out = pipeline.run_tasks(jobs, tasks, embedder=embed.hashing_embedder(4), registry=registry, vector_table=table).collect()
    texts = {j: sorted(r.metadata.content.strip() for r in out if r.job_id == j and r.document_type == "text") for j in "abcd"}
    assert texts == {"a": ["here", "one", "pdf", "pdf", "plain", "text", "two"], "b": ["other text"], "c": ["third"], "d": ["pdf", "x"]}
    assert {r.job_id for r in out if r.cm_failed} == {"b"} and not any(r.cm_failed for r in out if r.job_id != "b")
    errors = {(r.job_id, r.metadata.error_metadata.error_msg) for r in out if r.document_type is None}
    assert errors == {("b", "ValueError: broken file"), ("c", "ValueError: broken file")}
    assert sorted(r.document_type for r in out if r.job_id == "a" and r.document_type != "text") == ["image", "structured"]
    stored = spark.read.parquet(table)
    assert {r.job_id for r in stored.collect()} == {"a", "c", "d"} and stored.where("vector IS NULL").count() == 0
    loud = pipeline.run_tasks(jobs.where("job_id = 'a'"), [{"type": "extract", "task_properties": {"document_type": "pdf", "method": "shout", "params": {}}}], registry=registry).collect()
    assert sorted(r.metadata.content for r in loud) == ["ONE TWO", "plain text here"]
    with pytest.raises(ValueError):
        pipeline.run_tasks(jobs, [{"type": "vdb_upload"}])
