"""Work and memory that must not outgrow the input, on small rows that show it."""

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa

from folio.operators import assemble, detect, extract, language, responses, spatial


def most_rows(df) -> int:
    """Most rows that one operator of the plan put out in the last run of ``df``."""
    most, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            left.append(node.plan())
            continue
        metric = node.metrics().get("numOutputRows")
        most = max(most, metric.get().value() if metric.isDefined() else 0)
        left += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_nearest_texts_of_crowded_places_meet_few_rows(spark):
    rnd = random.Random(4)
    box = "job_id long, page long, pos long, x1 double, y1 double, x2 double, y2 double"
    at = [(rnd.choice((10.0, 20.0, 30.0)), rnd.uniform(0, 4)) for _ in range(600)] + [(10.0, 2.0)] * 900 + [(900.0, 900.0)]
    texts = [(1, 0, i, x - 1, y - 1, x + 1, y + 1) for i, (x, y) in enumerate(at)]
    rnd.shuffle(texts)
    places = [(10.0, 2.0)] * 60 + [(rnd.uniform(0, 40), rnd.uniform(-5, 5)) for _ in range(60)] + [(450.0, 450.0), (-999.0, 5.0), (900.0, 899.0)]
    images = [(1, 0, 5000 + i, x - 2, y - 2, x + 2, y + 2) for i, (x, y) in enumerate(places)] + [(1, 0, 9000, 1.0, None, 2.0, 2.0)]
    found = spatial.knn_blocks(spark.createDataFrame(images, box), spark.createDataFrame(texts, box), k=5)
    got = {}
    for r in found.collect():
        got.setdefault(r.image_pos, []).append((r.rank, r.text_pos))
    for i, (x, y) in enumerate(places):
        want = sorted(((p[0] - x) ** 2 + (p[1] - y) ** 2, j) for j, p in enumerate(at))[:5]
        assert sorted(got[5000 + i]) == [(n, j) for n, (_, j) in enumerate(want, 1)]
    assert sorted(got[9000]) == [(n, n - 1) for n in range(1, 6)]
    assert most_rows(found) < 20 * len(images)  # lists of k, not an image's neighbourhood


def test_texts_without_a_centre_come_first_where_they_are_met(spark):
    box = "job_id long, page long, pos long, x1 double, y1 double, x2 double, y2 double"
    texts = [(1, 0, i, float(i), 0.0, i + 2.0, 2.0) for i in range(8)] + [(1, 0, 50, 3.0, None, 5.0, None)]
    images = [(1, 0, 100, 0.0, 0.0, 2.0, 2.0), (1, 0, 101, None, 0.0, 2.0, 2.0)]
    got = sorted((r.image_pos, r.rank, r.text_pos) for r in spatial.knn_blocks(spark.createDataFrame(images, box), spark.createDataFrame(texts, box), k=3).collect())
    assert got == [(100, 1, 50), (100, 2, 0), (100, 3, 1), (101, 1, 0), (101, 2, 1), (101, 3, 2)]


def test_images_taken_together_give_what_each_gives():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9):
        rows = 40 * n
        xy = np.round(rng.uniform(0, 0.8, (rows, 2)), 1)
        boxes = np.concatenate([xy, xy + np.round(rng.uniform(-0.05, 0.5, (rows, 2)), 1)], axis=1)
        boxes[rng.random(boxes.shape) < 0.02] = np.nan
        label = np.array(["chart", "title", "table"], dtype=object)[rng.integers(0, 3, rows)]
        a = {"image_id": np.repeat(np.arange(40), n), "box_id": np.tile(np.arange(n), 40), "label": label, "score": np.round(rng.uniform(0, 1, rows), 1), "boxes": boxes}
        for few, each in ((detect._nms_few(0.3, True), detect._nms_kernel(0.3, True)), (detect._nms_few(0.3, False), detect._nms_kernel(0.3, False)),
                          (detect._fuse_few(0.01, 0.2), detect._fuse_kernel(0.01, "biggest", "max", 0.2)), (detect._match_few(0.01, 0.1), detect._match_kernel(0.01, 0.1))):
            at, box, score, *rest = few({**a, "code": pd.factorize(label)[0]}, np.arange(rows).reshape(40, n))
            got = sorted(repr((int(a["image_id"][i]), int(a["box_id"][i]), label[i], *map(float, b), float(s), *[bool(r[j]) for r in rest])) for j, (i, b, s) in enumerate(zip(at, box, score)))
            want = [r for g in range(40) for r in each({k: v[g * n:(g + 1) * n] for k, v in a.items()})]
            assert got == sorted(repr((int(r[0]), r[1], r[2], *map(float, r[3:8]), *map(bool, r[8:]))) for r in want)


def test_pieces_go_out_before_the_next_documents_are_parsed(monkeypatch):
    monkeypatch.setattr(extract, "TAKEN", 40, raising=False)
    batch = pa.RecordBatch.from_pydict({"job_id": pa.array([1, None, 3], pa.int64()), "document_type": ["md", "md", "odd"], "content": ["a" * 30 + "\n\nb", "c" * 30, None]})
    out = list(extract._run_parsers(extract.DEFAULT_REGISTRY, {})(iter([batch])))
    assert [b.num_rows for b in out] == [2, 2]
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["job_id"], r["piece"], r["text"], r["page"]) for r in rows[:3]] == [(1, 0, "a" * 30, 0), (1, 1, "b", 0), (None, 0, "c" * 30, 0)]
    assert rows[3]["job_id"] == 3 and rows[3]["error"].startswith("ValueError")


def test_trigrams_are_held_for_a_bounded_text(monkeypatch):
    held, whole = [], language.trigrams
    monkeypatch.setattr(language, "trigrams", lambda texts: (held.append(sum(map(len, texts))), whole(texts))[1])
    profiles = pd.DataFrame({"language": ["en"] * 2, "gram": [1, 2], "n": [3, 4], "total": [7, 7]})
    found = language.detector(SimpleNamespace(toPandas=lambda: profiles))(pd.Series(["some words " * 2000] * 60))
    assert len(found) == 60 and max(held) <= 1 << 18


def test_items_of_large_jobs_are_ordered_by_thin_rows(spark, monkeypatch):
    seen, whole = [], responses.scan
    monkeypatch.setattr(responses, "scan", lambda df, *a, **k: (seen.append(df.columns), whole(df, *a, **k))[1])
    rows = [(1, i, "text", ("x" * 50,)) for i in range(30)] + [(None, 0, "text", ("y",))]
    df = spark.createDataFrame(rows, "job_id long, pos long, document_type string, metadata struct<content:string>")
    got = {(r.job_id, r.pos): (r.fragment, r.fragment_count) for r in responses.fragment_responses(df, 1000).collect()}
    assert seen and not any("metadata" in c for c in seen)
    assert len(got) == 31 and got[None, 0] == (0, 1) and got[1, 0][0] == 0 and got[1, 29][0] == got[1, 29][1] - 1 > 1


def test_tables_are_rendered_in_shares_of_their_cells(spark, monkeypatch):
    monkeypatch.setattr(assemble, "ROWS_TASK", 40)
    rows = [(t if t != 5 else None, r if t != 9 else r + 1, c, f"{t}.{r}.{c}" if c or r else None) for t in range(90) for r in range(1 + t % 6) for c in range(1 + t % 3)]
    rows += [(7, None, 0, "x"), (7, None, 1, "y"), (8, -1, 0, "z")]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "t long, row int, col int, text string")
    want = {}
    for t in {r[0] for r in rows}:
        lines = []
        for row in sorted({r[1] for r in rows if r[0] == t}, key=lambda x: -2 if x is None else x):
            texts = [r[3] or "" for r in sorted((r for r in rows if r[:2] == (t, row)), key=lambda r: r[2])]
            lines.append("| " + " | ".join(texts) + " |")
            if row == 0:
                lines.append("|" + "|".join(["---"] * len(texts)) + "|")
        want[t] = "\n".join(lines)
    found = assemble.render_table(df, scope=("t",))
    assert {r.t: r.table for r in found.collect()} == want
    assert found.rdd.getNumPartitions() == -(-len(rows) // 40) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert assemble.render_table(df, "csv", ("t",)).rdd.getNumPartitions() == -(-len(rows) // 40)
