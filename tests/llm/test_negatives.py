from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from flakeform.llm import negatives
from flakeform.llm.negatives import Packed, best, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=3, positives=5, most=10, band=(30, 90)):
    """By brute force, with Python's whole numbers; rows of one id in the order given."""
    kept = [
        (i, label, [floor(256 * float(x)) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = []
    for at, (i, label, x) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), j, k) for k, (j, _, y) in enumerate(kept)]
        same = sorted([s for s in scored if kept[s[2]][1] == label and s[2] != at], key=order)[:positives]
        other = sorted([s for s in scored if kept[s[2]][1] != label], key=order)
        for p, j, _ in same:
            found = [s for s in other if band[0] * p <= 100 * s[0] <= band[1] * p][:most]
            out += [(i, j, rank, s[1], p, s[0]) for rank, s in enumerate(found, 1)]
    return sorted(out, key=str)


def found(spark, rows, every=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % every == 0, **options).select(COLUMNS).collect()), key=str)


def table(n, seed, width=6, labels=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0.1, 0.4, width).astype(np.float32)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("cell", [(2048, 8192), (7, 20)])
def test_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(negatives, "ANCHORS", cell[0])
    monkeypatch.setattr(negatives, "CANDIDATES", cell[1])
    rows = table(150, 1)
    want = plain(rows)
    assert len(want) > 500 and found(spark, rows) == want
    assert found(spark, rows, positives=2, negatives=3, band=(10, 50)) == plain(rows, positives=2, most=3, band=(10, 50))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(40, 2, width=3)
    rows += [(3, [0.5, 0.5, 0.5], 1), (3, [0.5, 0.5, 0.5], 1), (None, [0.5, 0.25, 0.5], 2), (None, [0.4, 0.4, 0.4], 1)]
    rows += [(60, None, 1), (63, [nan, 0.0, 0.0], 1), (66, [inf, 0.0, 0.0], 1), (69, [None, 0.0, 0.0], 1), (72, [0.5, 0.5, 0.5], None)]
    rows += [(75, [], 0), (78, [0.5], 0), (81, [0.0, 0.0, 0.0], 0), (84, [1.0] * 3, 9)]
    assert found(spark, rows) == plain(rows)


def test_one_hot_label_ties_and_empty(spark):
    same = [(i, [0.5, 0.25], 1 if i % 3 else 0) for i in range(60)]
    assert found(spark, same) == plain(same)
    zero = [(i, [1.0 if i % 2 else 0.5, 0.5], i % 2) for i in range(60)]
    assert found(spark, zero) == plain(zero) != []
    assert found(spark, []) == []
    assert found(spark, [(0, [0.5], 1)]) == []


def test_wide_components_are_exact(spark):
    rows = [(i, [x * 3e5 for x in v], label) for i, v, label in table(60, 3)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert found(spark, rows) == plain(rows) != []


def _ended(rows):
    least, most = -(1 << 63), (1 << 63) - 1
    return sorted([(*r[:4], min(max(r[4], least), most), min(max(r[5], least), most)) for r in rows], key=str)


@pytest.mark.parametrize("cell", [(2048, 8192), (7, 20)])
@pytest.mark.parametrize("scale", [1e15, 1e18, 1e25])
def test_scores_beyond_a_long_are_judged_exactly(spark, monkeypatch, cell, scale):
    monkeypatch.setattr(negatives, "ANCHORS", cell[0])
    monkeypatch.setattr(negatives, "CANDIDATES", cell[1])
    rows = [(i, [float(np.float32(x * (scale if i % 3 else 1))) for x in v], label) for i, v, label in table(60, 5)]
    want = plain(rows)
    assert any(abs(r[4]) >= 1 << 63 for r in want)
    assert found(spark, rows) == _ended(want)


def test_clashing_columns(spark):
    df = spark.createDataFrame(table(60, 4), SCHEMA).withColumns({c: F.lit("z") for c in ("row", "id", "x", "anchor", "place", "score")})
    got = hard_negatives(df.coalesce(1), F.col("vec_id") % 3 == 0)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(table(60, 4))


@pytest.mark.parametrize("most", [3, 200, 40_000, 1 << 30, 1 << 40, 1 << 62])
def test_packed_products_are_exact(most):
    rng = np.random.default_rng(most % 1000)
    a, c = rng.integers(-most, most, (5, 9)), rng.integers(-most, most, (23, 9))
    a[0], c[0], c[1] = -most, -most, most - 1
    packed = Packed(c, -most, most)
    assert packed.fields >= 2 or packed.bits > 26
    want = a.astype(object) @ c.astype(object).T
    assert (packed.scores(a) == want).all()


def test_best_takes_the_first_of_equal_scores():
    scores = np.array([5, 7, 5, 7, 1, 5, 9])
    assert best(scores, np.arange(7), 4).tolist() == [6, 1, 3, 0]
    assert best(scores, np.array([0, 2, 5]), 2).tolist() == [0, 2]
    assert best(scores, np.zeros(0, int), 2).tolist() == []
