"""The registered queries of the package and the pipeline on the smallest driver tables."""

import sys
import zlib
from pathlib import Path

import duckdb
import pytest
from brute import KneserNey, near_components, words
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import rows_key
from folio.llm import minhash, mixing, queries
from folio.llm.shared import load, stage
from folio.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [sum(q.startswith(f"op{n}_") for q in entry.queries()) for n in range(1, 11)] == [1] * 10
    assert set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.SQL[name])
    order = [rel.columns.index(c) for c in df.columns]
    assert rows_key([tuple(r) for r in df.collect()]) == rows_key([tuple(r[i] for i in order) for r in rel.fetchall()])


def test_near_duplicate_query(spark):
    got = queries.op7_minhash_components(spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in load(spark, SF, "documents").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_components(rows, 4, 80)


def test_language_model_query_beats_single_words(spark):
    got = queries.op10_kneser_ney(spark, SF).collect()
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) and {r.doc_id: r.held_out for r in got} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in got}
    texts = {r.doc_id: r.text for r in load(spark, SF, "documents").collect()}
    assert all(r.n_tokens == len(words(texts[r.doc_id])) + 1 for r in got)


def test_language_model_query_is_of_order_three(spark):
    rows = [(r.doc_id, r.text) for r in load(spark, SF, "documents").collect()]
    got = {r.doc_id: r.score for r in queries.op10_kneser_ney(spark, SF).collect()}
    model = KneserNey([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2], 3)
    assert all(abs(got[i] - model.score(t)) < 1e-6 * max(1, abs(got[i])) for i, t in rows[:30])


def test_pipeline_stages(spark):
    docs = load(spark, SF, "documents")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in load(spark, SF, "labels").collect()}
    kept = [docs]
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(function(spark, kept[-1], SF), "test-stage"))
        assert kept[-1].columns == columns
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in kept]
    junk = [i for i in ids[1] if labels.get(i) == 0]
    assert len(junk) <= 2 and sum(labels.get(i) == 1 for i in ids[1]) >= 0.97 * sum(labels.get(i) == 1 for i in ids[0])
    groups = near_components([(r.doc_id, r.text) for r in kept[2].collect()], 5, 80)
    assert sorted(ids[3]) == sorted(i for i, (_, c) in groups.items() if i == c)
    copies = {r.doc_id: r.copies for r in mixing.plan_mix(kept[3]).collect()}
    assert sorted(ids[4]) == sorted(i for i, c in copies.items() for _ in range(c))
    encoded = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF)
    assert encoded.where("lossless").count() == len(ids[4])
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "ids_crc32").collect())) == sorted(map(tuple, encoded.select("doc_id", "ids_crc32").collect()))


def test_pipeline_of_no_documents_and_clashing_columns(spark):
    docs = load(spark, SF, "documents").withColumn("score", F.lit("s")).withColumn("rank", F.lit(1)).withColumn("bucket", F.lit(2))
    for given in (docs.limit(0), docs.limit(60).union(docs.limit(20))):
        now = given
        for _, function in corpus_pipeline.STAGES[:-1]:
            now = stage(function(spark, now, SF), "test-stage")
            assert now.columns == given.columns
        corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert minhash.keep_one(docs.limit(40).union(docs.limit(40))).count() == minhash.keep_one(docs.limit(40)).count()
