"""Sources, small structural operators and extraction jobs on hand-made rows."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from folio import schema as S
from folio.functions.predicates import is_subset
from folio.functions.structs import build_struct
from folio.operators import assemble, chunk, embed, extract, layout, metadata, responses
from folio.sources import files


def test_read_files_infer_and_encode(spark):
    d = tempfile.mkdtemp(prefix="folio-files-")
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "a.md"), "w") as fh:
        fh.write("hello")
    with open(os.path.join(d, "sub", "b.PNG"), "wb") as fh:
        fh.write(b"\x89PNG")
    with open(os.path.join(d, "c.exe"), "wb") as fh:
        fh.write(b"x")
    df = files.encode_content(files.infer_document_type(files.read_files(spark, d)))
    got = {r.source_id: (r.document_type, r.content, r.type_error) for r in df.collect()}
    assert got["a.md"] == ("text", "hello", None)
    assert got["b.PNG"][0] == "png" and got["b.PNG"][1] == "iVBORw=="
    assert got["c.exe"][0] is None and got["c.exe"][2] == "Unsupported file type: exe"


def test_manifest_and_unpack(spark):
    d = tempfile.mkdtemp(prefix="folio-manifest-")
    p = os.path.join(d, "m.json")
    with open(p, "w") as fh:
        json.dump({"sampled_files": ["x.pdf", "y.docx"], "metadata": {"sampling_method": "none"}}, fh)
    assert [r.path for r in files.read_manifest(spark, p).orderBy("pos").collect()] == ["x.pdf", "y.docx"]
    jobs = spark.createDataFrame([("j", {"content": ["c1", "c2"], "source_name": ["n1", "n2"],
                                         "source_id": ["i1", "i2"], "document_type": ["PDF", "text"]})],
                                 "job_id string, job_payload struct<content:array<string>, source_name:array<string>, "
                                 "source_id:array<string>, document_type:array<string>>")
    rows = files.unpack_payload(jobs).orderBy("pos").collect()
    assert [(r.pos, r.content, r.document_type) for r in rows] == [(0, "c1", "pdf"), (1, "c2", "text")]


def test_is_subset(spark):
    props = json.dumps({"method": "native", "params": {"a": 1, "list": ["x", "y"]}})
    df = spark.createDataFrame([(props,)], "p string")
    cases = [({"method": "native"}, True), ({"method": "*"}, True), ({"method": "other"}, False),
             ({"params": {"a": 1}}, True), ({"params": {"list": ["y"]}}, True), ({"params": {"list": ["z"]}}, False),
             ({"missing": "*"}, True), ("*", True)]
    for subset, want in cases:
        assert df.select(is_subset("p", subset)).first()[0] is want, subset


def test_merge_styled_runs(spark):
    rows = [(1, 1, 0, "Hello ", True, False, False), (1, 1, 1, "world", True, False, False),
            (1, 1, 2, "  ", False, False, False), (1, 1, 3, "!", True, False, False),
            (1, 1, 4, "plain", False, False, False)]
    df = spark.createDataFrame(rows, "job_id long, paragraph long, pos long, text string, bold boolean, "
                                     "italic boolean, underline boolean")
    got = [(r.text, r.bold) for r in assemble.merge_styled_runs(df).orderBy("pos").collect()]
    assert got == [("Hello world  !", True), ("plain", False)]


def test_explode_extractions_and_tag_error(spark):
    df = spark.createDataFrame([(1, [("a", 1), ("b", 2)]), (2, [])], "job_id long, extracted array<struct<t:string,n:int>>")
    out = chunk.explode_extractions(df).collect()
    assert [(r.job_id, r.piece, r.t) for r in out] == [(1, 0, "a"), (1, 1, "b")]
    el = spark.createDataFrame([(1, 0, "text", None)], "job_id long, pos long, document_type string, content string")
    el = el.withColumn("metadata", build_struct(S.METADATA, content=F.col("content")))
    r = chunk.split_documents(el).first()
    assert r.document_type is None and r.metadata.error_metadata.task == "split"


def test_fragments_reassemble(spark):
    frag = spark.createDataFrame(
        [(5, 1, 2, "failed", "d1", [("text", 3)]), (5, 0, 2, "success", "d0", [("text", 1), ("text", 2)]),
         (6, 0, 2, "success", "x", [("text", 9)])],
        "job_id long, fragment int, fragment_count int, status string, description string, "
        "data array<struct<document_type:string, n:int>>")
    out = {r.job_id: r for r in responses.reassemble_responses(frag).collect()}
    assert set(out) == {5} and out[5].status == "success" and [d.n for d in out[5].data] == [1, 2, 3]


def test_extract_documents_registry_and_errors(spark):
    jobs = spark.createDataFrame([(1, "text", "para one\n\npara two"), (2, "pdf", "%PDF"), (3, "html", "<p>a &amp; b</p>")],
                                 "job_id long, document_type string, content string")

    def fake_pdf(content, params):
        return [{"kind": "text", "text": "page text", "page": 0}, {"kind": "image", "text": "", "page": 0}]
    raw = extract.extract_documents(jobs, {"pdf": fake_pdf}).collect()
    got = sorted((r.job_id, r.kind, r.text) for r in raw)
    assert got == [(1, "text", "para one"), (1, "text", "para two"), (2, "text", "page text"), (3, "text", "a & b")]
    bad = extract.extract_documents(jobs.where("job_id = 2")).first()
    assert bad.error.startswith("ValueError")
    texts = assemble.rollup_text(extract.extract_documents(jobs, {"pdf": fake_pdf}).where("error IS NULL")
                                 .withColumnRenamed("piece", "pos"), "document", " ")
    assert {r.job_id: r.text for r in texts.collect()}[1] == "para one para two"


def test_layout_and_cloud_elements(spark):
    raw = spark.createDataFrame([(1, "<x_10><y_20>**Hi** there<x_30><y_40><class_Text><x_0><y_0>hdr<x_1><y_1><class_Page-header>"
                                     "<x_5><y_5>|a|b|<x_9><y_9><class_Table>", 0, 0)],
                                "job_id long, raw string, pad_x int, pad_y int")
    el = {r.token: r for r in layout.layout_elements(raw).collect()}
    assert el[0].text == "Hi there" and el[0].bbox == [10, 20, 30, 40]
    assert el[1].text == "" and el[2].kind == "table" and el[2].text == "|a|b|"
    cj = json.dumps([{"Path": "//Document/P", "Text": "t", "Page": 0, "Bounds": [1, 2, 3, 4]},
                     {"Path": "//Document/Figure", "Page": 1, "Bounds": [0, 0, 1, 1]}])
    ce = extract.cloud_elements(spark.createDataFrame([(1, cj)], "job_id long, elements string")).collect()
    assert [(r.kind, r.page) for r in ce] == [("text", 0), ("image", 1)]


def test_embed_errors_become_info_rows(spark):
    el = spark.createDataFrame([(1, 0, "u1", "good text"), (1, 1, "u2", "boom")],
                               "job_id long, pos long, uuid string, t string")
    el = el.select("job_id", "pos", "uuid", F.lit("text").alias("document_type"),
                   build_struct(S.METADATA, content=F.col("t")).alias("metadata"))

    def flaky(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("model down")
        return embed.hashing_embedder(8)(texts)
    out = {r.pos: r for r in embed.embed_text(el, flaky, batch_size=1, filter_errors=True).collect()}
    assert out[0]._contains_embeddings and len(out[0].metadata.embedding) == 8
    assert out[1].document_type == "info_message" and out[1].metadata.info_message_metadata.filter
    assert metadata.project_results(embed.merge_embedded(el)).columns == ["job_id", "pos", "document_type", "metadata"]


def test_store_objects_writes_bytes_and_output_by_type(spark):
    import base64

    from folio.sources import sinks
    d = tempfile.mkdtemp(prefix="folio-store-")
    payload = base64.b64encode(b"\x89PNGdata").decode()
    el = spark.createDataFrame([(1, 0, "structured", payload, "doc a.pdf"), (1, 1, "text", "hello", "doc a.pdf")],
                               "job_id long, pos long, document_type string, c string, src string")
    el = el.select("job_id", "pos", "document_type", build_struct(
        S.METADATA, content=F.col("c"),
        source_metadata=build_struct(S.SOURCE_METADATA, source_id=F.col("src"), source_name=F.col("src")),
        content_metadata=build_struct(S.CONTENT_METADATA, type=F.col("document_type")),
        table_metadata=F.when(F.col("document_type") == "structured",
                              build_struct(S.TABLE_METADATA, table_format=F.lit("image")))).alias("metadata"))
    out = {r.pos: r for r in sinks.store_objects(el, "file://" + d, bucket="b", write=True).collect()}
    url = out[0].metadata.table_metadata.uploaded_image_uri
    assert url == f"file://{d}/b/doc%20a.pdf/0.png" and out[1].metadata.source_metadata.source_location is None
    with open(f"{d}/b/doc%20a.pdf/0.png", "rb") as fh:
        assert fh.read() == b"\x89PNGdata"
    sinks.write_by_content_type(el, d + "/by_type")
    assert sorted(os.listdir(d + "/by_type")) == ["structured", "text"]
    with open(d + "/by_type/text/doc_a.pdf.metadata.json") as fh:
        assert [e["metadata"]["content"] for e in json.load(fh)] == ["hello"]
