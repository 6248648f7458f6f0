from math import floor, isfinite

import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from flakeform.llm import vectors
from flakeform.llm.whitening import Spectrum, fit_whitening, secular_roots, spectrum, whitened

SCHEMA = "vec_id long, embedding array<float>"


def scatter(x):
    centred = x - x.mean(axis=0)
    return centred.T @ centred


def covers(s, x):
    want = scatter(x)
    scale = max(1.0, np.abs(want).max())
    assert np.allclose(s.vectors * s.values @ s.vectors.T, want, atol=1e-11 * scale)
    assert np.allclose(s.vectors.T @ s.vectors, np.eye(x.shape[1]), atol=1e-11)
    assert np.allclose(s.mean, x.mean(axis=0), atol=1e-11 * max(1, np.abs(x).max())) and s.count == len(x)


def tables():
    rng = np.random.default_rng(3)
    line = np.outer(np.arange(40), [1, 2, 0, 5, 0]).astype(float)
    return {
        "random": np.floor(256 * rng.normal(size=(300, 12)) * np.linspace(0.01, 1, 12)),
        "equal spectra": np.vstack([np.eye(6) * 10] * 5),
        "one line": line,
        "two values": line + rng.integers(0, 2, (40, 5)),
        "constant": np.full((20, 4), 7.0),
        "single": np.array([[1.0, 2.0, 3.0]]),
        "wide scales": rng.normal(size=(80, 6)) * [1e-6, 1, 1, 1e3, 1e3, 1e6],
    }


@pytest.mark.parametrize("name", tables())
def test_updates_give_the_scatter(name):
    x = tables()[name]
    s = Spectrum(x.shape[1])
    for row in x:
        s.add(row)
    covers(s, x)
    parts = [Spectrum(x.shape[1]) for _ in range(4)]  # one stays empty
    for k, row in enumerate(x):
        parts[k % 3].add(row)
    for part in parts[1:]:
        parts[0].merge(part)
    covers(parts[0], x)


def test_secular_roots_interlace():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 20):
        d, z, rho = np.sort(rng.normal(size=n)) + np.arange(n) * 1e-3, rng.normal(size=n), 0.7
        roots, gaps = secular_roots(d, z, rho)
        want = np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z))
        assert np.allclose(roots, want, atol=1e-13 * max(1, np.abs(want).max()))
        assert np.allclose(gaps, d[None, :] - roots[:, None])
        assert np.allclose(1 + (rho * z * z / gaps).sum(axis=1), 0, atol=1e-9)


def grid(rows):
    return [(i, [floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]


def check(rows, got, most=4):
    """Against numpy's eigenvectors, and exact sums in Python's whole numbers."""
    kept = grid(rows)
    width = max(len(x) for _, x in kept)
    kept = [(i, tuple(x) + (0,) * (width - len(x))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float)
    covariance = scatter(x) / n
    values, vectors_ = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values)[:most] if values[k] > 1e-9 * values.max()]
    assert len(got) == len(kept) * len(order)
    seen = {}
    for row in got:
        seen.setdefault((row["vec_id"], row["component"]), []).append(row)
    signs = {}
    for i, v in kept:
        deviation = min(sum((n * a - s) ** 2 for a, s in zip(v, sums)), (1 << 63) - 1)
        for c, k in enumerate(order, 1):
            want = (np.array(v) - np.array(sums) / n) @ vectors_[:, k] / np.sqrt(values[k])
            some = [r for r in seen[(i, c)] if r["deviation"] == deviation]
            assert some and all(r["n"] == n for r in some)
            nearest = min(some, key=lambda r: abs(abs(r["whitened"]) - abs(want)))
            assert abs(nearest["whitened"]) == pytest.approx(abs(want), abs=1e-7)
            if abs(want) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(want) == np.sign(nearest["whitened"]))
            assert nearest["explained"] == pytest.approx(values[k] / np.trace(covariance), rel=1e-8)
            assert nearest["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_the_table(spark):
    df = vectors.embeddings(spark, SF)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(rows, whitened(df.repartition(20)).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5) * [3, 2, 1, 0.5, 0.2]]) for i in range(60)]
    rows += [(7, rows[0][1])] * 40 + [(None, rows[1][1]), (None, [1.0, -2.0, 0.5, 0.5, 0.0]), (90, [-0.001, 0.5])]
    bad = [(91, None), (92, [float("nan")] * 5), (93, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (94, [None, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({c: F.lit("z") for c in ("x", "n", "component", "place", "part")})
    check(rows, whitened(df).collect())


def test_no_variance_no_component(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SCHEMA)).collect() == []
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.75])]
    check(rows, whitened(spark.createDataFrame(rows, SCHEMA)).collect())


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x)) for x in (1e6 + 1e4 * i * i, -2e6 + 3e5 * i, 1e3 * (i % 3))]) for i in range(30)]
    check(rows, whitened(spark.createDataFrame(rows, SCHEMA)).collect())


def test_spectra_of_many_tasks_meet(spark):
    x = tables()["random"]
    df = spark.createDataFrame([([int(v) for v in row],) for row in x], "x array<long>").repartition(30)
    covers(spectrum(df, x.shape[1]), x)


def test_fit_needs_whole_numbers_only_once(spark):
    df = spark.createDataFrame([(1, [0.5]), (2, [0.501]), (3, [1.0])], SCHEMA)
    assert fit_whitening(df).count == 2
