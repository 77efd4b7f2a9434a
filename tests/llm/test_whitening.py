"""Whitening: eigenvectors against a plain solver, exact covariances, odd vectors, clashing names."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborflow.llm import spectral, whitening
from harborflow.llm.queries import QUERIES


def orthogonal(n, rng):
    return np.linalg.qr(rng.standard_normal((n, n)))[0]


@pytest.mark.parametrize("kind", ["random", "clusters", "low rank", "scalar", "diagonal", "one", "graded"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(3)
    n = 1 if kind == "one" else 60
    values = {
        "random": rng.random(n), "clusters": np.repeat([5.0, 2.0, 1.0], 20), "low rank": np.r_[rng.random(7), np.zeros(53)],
        "scalar": np.full(n, 4.0), "diagonal": rng.random(n), "one": np.array([3.0]), "graded": 10.0 ** -np.linspace(0, 14, 60),
    }[kind]
    q = np.eye(n) if kind == "diagonal" else orthogonal(n, rng)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = spectral.eigenvectors(a)
    size = np.linalg.norm(a)
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * size
    assert np.linalg.norm(x.T @ x - np.eye(n)) <= 1e-13
    assert np.linalg.norm(a @ x - x * e) <= 1e-13 * size
    assert (np.diff(e) <= 0).all()


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((30, 30))
    u = spectral.polar(a)
    h = u.T @ a
    assert np.linalg.norm(u.T @ u - np.eye(30)) < 1e-13 and np.linalg.norm(h - h.T) < 1e-12 and np.linalg.eigvalsh((h + h.T) / 2).min() > 0


SCHEMA = "vec_id long, embedding array<float>, whitened string, n int, doubles int"


def odd_rows(rng, count=500, dims=9):
    base = rng.standard_normal((count, dims)) @ rng.standard_normal((dims, dims))
    base[:, 3] = base[:, 2]  # a component without variance
    rows = [(i if i % 50 else None, [float(np.float32(v)) for v in line]) for i, line in enumerate(base)]
    rows += [rows[7]] * 3 + [(900, None), (901, [1.0, None, *[0.0] * 7]), (902, [math.nan, *[0.0] * 8]), (903, [math.inf, *[0.0] * 8]), (904, []), (905, [1.0, 2.0])]
    return [(*r, "x", 1, 2) for r in rows]


def test_against_plain_solver(spark):
    rows = odd_rows(np.random.default_rng(8))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = whitening.fit(frame)
    taken = [r for r in rows if r[1] is not None and len(r[1]) == 9 and all(v is not None and math.isfinite(v) for v in r[1])]
    x = np.array([[math.floor(64 * v) + 1_000_000 for v in r[1]] for r in taken])
    n, total = len(x), x.sum(0)
    assert model.n == n and model.sums == total.tolist()
    centred = x - total / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    assert len(model.values) == 8
    assert np.allclose(model.values, values[::-1][:8], rtol=1e-10) and math.isclose(model.trace, np.trace(cov), rel_tol=1e-12)
    assert (np.abs(np.abs(np.sum(model.vectors * vectors[:, ::-1][:, :8], 0)) - 1) < 1e-10).all()
    out = whitening.apply(frame, model)
    assert out.columns == ["vec_id", "embedding", "n", "doubles", "whitened", "deviation"]
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.embedding, r.whitened, r.deviation) for r in out.collect()), key=repr)
    want = sorted(
        ((r[0] is None, r[0] or 0, r[1], list((c @ model.vectors) / np.sqrt(model.values)), int(((n * v - total) ** 2).sum())) for r, v, c in zip(taken, x, centred)),
        key=repr,
    )
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a[4] == b[4] and np.allclose(a[3], b[3], atol=1e-8)
    assert whitening.identity_error(out) < 1e-10


def test_covariance_is_exact_for_large_entries(spark):
    """Entries beyond one piece, and beyond the bound; sums as fractions."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(-(1 << 40), 1 << 40, 3) / 64]) for i in range(40)] + [(99, [1e300, -1e300, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    model = whitening.fit(frame)
    clip = [[int(max(-(1 << 40), min(1 << 40, math.floor(64 * v)))) + 1_000_000 for v in r[1]] for r in rows]
    mean = [Fraction(sum(c), len(clip)) for c in zip(*clip)]
    trace = sum(sum((v - m) ** 2 for v in c) for c, m in zip(zip(*clip), mean)) / len(clip)
    assert model.trace == float(trace)
    # A deviation beyond 64 bits is null.
    assert {r.deviation for r in whitening.apply(frame, model).collect()} == {None}


def test_nothing_to_whiten(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    model = whitening.fit(frame)
    out = whitening.apply(frame, model)
    assert [list(r.whitened) for r in out.collect()] == [[], []] and whitening.identity_error(out) is None
    for empty in (frame.limit(0), frame.withColumn("embedding", F.lit(None).cast("array<float>"))):
        assert whitening.fit(empty) is None and whitening.apply(empty, None).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op13_embedding_whitening"](spark, sf)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert len(rows) == vectors * 32 and {r.component for r in rows} == set(range(1, 33)) and {r.n for r in rows} == {vectors}
    assert {r.identity_error <= 1e-10 for r in rows} == {True}
    explained = [v for _, v in sorted({(r.component, r.explained) for r in rows})]
    assert len(explained) == 32 and explained == sorted(explained, reverse=True)
