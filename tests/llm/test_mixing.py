from collections import defaultdict

import pytest
from brute import edge_rows, edges, empty, sources, words
from pyspark.sql import functions as F

from flakeform.llm.mixing import mix_sources, with_copies


def targets(sizes, share=1.5, cap=2.0):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]] if open_ else []
        if not over:
            return full | {s: left * weight[s] / total for s in open_}
        for s in over:
            full[s] = cap * sizes[s]
        left = share * sum(sizes.values()) - sum(full.values())


@pytest.mark.parametrize("make", [edges, sources])
def test_targets_and_copies(spark, make):
    docs = make(spark)
    sizes = defaultdict(int)
    for row in docs.select("source", "text").collect():
        sizes[row["source"]] += len(words(row["text"]))
    want = targets(sizes)
    got = with_copies(docs).collect()
    assert len(got) == docs.count()
    for row in got:
        assert row["target"] == pytest.approx(want[row["source"]], rel=1e-9, abs=1e-9)
        assert row["source_size"] == sizes[row["source"]]
        rate = want[row["source"]] / sizes[row["source"]] if sizes[row["source"]] else 0
        assert int(rate + 1e-9) <= row["copies"] <= min(2, int(rate - 1e-9) + 1)
    assert sorted(r["size"] for r in got) == sorted(len(words(r["text"])) for r in docs.select("text").collect())


def test_rates_hold_over_many_documents_and_reruns_agree(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), F.lit(3)).alias("text"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
    )
    first = {r["doc_id"]: r["copies"] for r in with_copies(docs).collect()}
    again = {r["doc_id"]: r["copies"] for r in with_copies(docs.repartition(7)).collect()}
    assert first == again
    by_source = with_copies(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    for row in by_source.collect():
        assert row["taken"] == pytest.approx(row["target"], rel=0.03)


def test_mixed_rows_keep_the_columns(spark):
    docs = edges(spark)
    mixed = mix_sources(docs)
    assert mixed.columns == docs.columns
    copies = {(r["doc_id"], r["source"]): r["copies"] for r in with_copies(docs.drop("copies")).collect()}
    counts = {(r["doc_id"], r["source"]): r["count"] for r in mixed.groupBy("doc_id", "source").count().collect()}
    single = {k for k in copies if sum(k == (d, s) for d, _, _, s, _ in edge_rows()) == 1}
    assert {k: counts.get(k, 0) for k in single} == {k: copies[k] for k in single}


def test_empty(spark):
    assert mix_sources(empty(spark)).count() == 0
