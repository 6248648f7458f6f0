import importlib.util
import sys

import duckdb
import pytest
from brute import SF, edges, empty

import corpus_pipeline
from flakeform.llm.oracles import ORACLES
from flakeform.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    columns = sorted(want.columns)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.select(*columns).fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_on_the_table(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())
    ids = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} <= ids


@pytest.mark.parametrize("make", [edges, empty])
def test_stages_keep_the_columns_on_odd_tables(spark, make):
    docs = make(spark)
    clashing = [name for name in docs.columns if name not in ("doc_id", "text", "lang", "source", "n_chars")]
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SF)
        assert out.schema == docs.schema or out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert {row[name] for row in out.collect() for name in clashing} <= {"other"}
        docs = spark.createDataFrame(out.collect(), out.schema)
    corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_stages_act_as_their_operators(spark):
    from flakeform.llm import decoding, jaccard

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()}
    assert kept == {r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["secrets"](spark, docs, SF).collect()}
    for r in docs.collect():
        spans = decoding.all_spans(r["text"])
        assert (clean[r["doc_id"]] == r["text"]) == (not spans)
        for start, end, _ in spans:
            assert r["text"][start:end] not in clean[r["doc_id"]] or end - start < 12


def test_entry_adds_the_queries():
    assert importlib.util.find_spec("__spark_entry__")
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and sys.path
