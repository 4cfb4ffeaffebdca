"""Hand-made cases with known answers (FIXTURES.md part 3) and small restatements."""

from pyspark.sql import functions as F

from folio import schema as S
from folio.functions.dates import parse_pdf_date, validate_iso8601
from folio.functions.geometry import bbox_center
from folio.functions.structs import build_struct
from folio.functions.text import chunk_text
from folio.operators import assemble, dedup, filters, metadata, telemetry


def _images(spark, sizes, content=None):
    rows = []
    for i, (w, h) in enumerate(sizes):
        rows.append((1, i, "image", content or f"img{i}", w, h))
    df = spark.createDataFrame(rows, "job_id long, pos long, document_type string, content string, width int, height int")
    md = build_struct(S.METADATA, content=F.col("content"),
                      image_metadata=build_struct(S.IMAGE_METADATA, width=F.col("width"), height=F.col("height")),
                      content_metadata=build_struct(S.CONTENT_METADATA, type=F.lit("image")))
    return df.select("job_id", "pos", "document_type", md.alias("metadata"), F.lit("u").alias("uuid"))


def test_dedup_three_equal_images(spark):
    df = _images(spark, [(300, 300)] * 3, content="same")
    assert dedup.dedup_images(df, drop=True).count() == 1
    marked = dedup.dedup_images(df, drop=False).groupBy("document_type").count().collect()
    assert {r["document_type"]: r["count"] for r in marked} == {"image": 1, "info_message": 2}


def test_filter_small_and_thin_images(spark):
    df = _images(spark, [(1, 1), (1, 100), (100, 1)])
    assert filters.filter_images(df, min_size=256, drop=True).count() == 0
    marked = filters.filter_images(df, min_size=256).select("document_type").collect()
    assert [r[0] for r in marked] == ["info_message"] * 3


def test_bbox_center(spark):
    df = spark.createDataFrame([([0.0, 0.0, 10.0, 10.0],), ([1.0, 2.0, 3.0, 4.0],)], "b array<double>")
    got = [tuple(r[0]) for r in df.select(bbox_center("b")).collect()]
    assert got == [(5.0, 5.0), (2.0, 3.0)]


def test_rolling_window_three(spark):
    rows = [("s", i, i * 1000, (i + 1) * 10.0) for i in range(4)]
    df = spark.createDataFrame(rows, "stage string, pos long, entry_us long, latency_ms double")
    r = telemetry.rolling_stage_stats(df, window=3, block=3).orderBy("pos").collect()
    assert (r[-1]["rolling_mean"], r[-1]["rolling_median"]) == (30.0, 30.0)
    assert [x["rolling_mean"] for x in r] == [10.0, 15.0, 20.0, 30.0]


def test_pdf_date(spark):
    df = spark.createDataFrame([("D:20211222141131-07'00'",), ("garbage",)], "d string")
    got = [r[0] for r in df.select(parse_pdf_date("d")).collect()]
    assert got == ["2021-12-22T21:11:31", None]
    kept = df.select(parse_pdf_date("d", keep_tz=True)).first()[0]
    assert kept == "2021-12-22T14:11:31-07:00"


def test_iso8601(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02",), ("yesterday",)], "d string")
    assert [r[0] for r in df.select(validate_iso8601("d")).collect()] == [True, True, False]


def _py_chunks(text, split_by, n, overlap, max_len):
    """Plain-Python restatement of the splitting rule (from the blueprint)."""
    d = {"word": " ", "sentence": ".", "passage": "\n\n"}[split_by]
    units = text.split(d)
    units = [u + d for u in units[:-1]] + units[-1:]
    step = n - overlap
    L = len(units)
    k = 1 if L <= n else 1 + -(-(L - n) // step)
    out = []
    for w in range(k):
        t = "".join(units[w * step: w * step + n])
        if max_len and len(t) > max_len:
            out += [t[i:i + max_len] for i in range(0, len(t), max_len)]
        elif t:
            out.append(t)
    return out


def test_chunking_edge_cases_and_random(spark):
    import random
    rnd = random.Random(7)
    words = ["a", "bb", "ccc.", "dd..", "é", " ", "", "x\n\ny", "zz."]
    texts = ["", "   ", "a.b..c. ", "one"] + ["".join(rnd.choice(words) + rnd.choice([" ", ".", "", "\n\n"])
                                                  for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    settings = [("word", 60, 10, 450), ("word", 3, 1, 5), ("sentence", 2, 1, 7), ("passage", 1, 0, 4),
                ("sentence", 3, 2, None)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for sb, n, o, m in settings:
        got = {r["i"]: list(r["p"]) for r in df.select("i", chunk_text(F.col("t"), sb, n, o, m).alias("p")).collect()}
        for i, t in enumerate(texts):
            assert got[i] == _py_chunks(t, sb, n, o, m), (sb, n, o, m, t)


def test_result_failed(spark):
    df = spark.createDataFrame([(1, None), (2, "success"), (3, "failed")], "job_id long, status string")
    got = {r["job_id"]: r["failed"] for r in filters.result_failed(df).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_text_elements_default_location(spark):
    df = spark.createDataFrame([(1, 0, "hello world")], "job_id long, pos long, text string")
    el = metadata.build_text_elements(df).first()
    assert el["metadata"]["text_metadata"]["text_location"] == [-1.0, -1.0, -1.0, -1.0]
    assert el["metadata"]["content_metadata"]["type"] == "text"


def test_rollup_joins_with_space(spark):
    df = spark.createDataFrame([(1, 0, 0, "first"), (1, 0, 1, "second")], "job_id long, page int, pos long, text string")
    r = assemble.rollup_text(df, "document", " ").first()
    assert r["text"] == "first second"


def test_apply_text_style_and_format(spark):
    df = spark.createDataFrame([("Heading 2", "T", 1), ("Title", "Ab", 0), ("List Bullet", "x", 0)],
                               "style string, text string, level int")
    got = [r["styled"] for r in assemble.apply_text_style(df).collect()]
    assert got == ["\t## T", "Ab\n==", "- x"]
    runs = spark.createDataFrame([("  hi ", True, False, False, None), ("a.b", False, True, False, "http://u")],
                                 "text string, bold boolean, italic boolean, underline boolean, url string")
    md = [r["markdown"] for r in assemble.render_markdown_text(runs).collect()]
    assert md == ["  **hi** ", "*[a\\.b](http://u)*"]


def test_join_chart_text(spark):
    df = spark.createDataFrame([('{"chart_title": "Sales", "caption": "c"}', "model"), ("plain", None), (None, "m")],
                               "cached string, model string")
    got = [r[0] for r in df.select(assemble.join_chart_text("cached", "model")).collect()]
    assert got[0] == "Sales model c" + " " * 10
    assert got[1] == "plain"
    assert got[2] == " m"
