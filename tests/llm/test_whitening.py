import numpy as np
import pytest

from lexspark.llm import whitening
from lexspark.llm.bidiagonal import bidiagonalise, right_singular, squared_singular_values
from lexspark.llm.whitening import deviations, whiten_embeddings

DRAW = np.random.default_rng(11)


def with_values(values):
    n = len(values)
    left, right = (np.linalg.qr(DRAW.normal(size=(n, n)))[0] for _ in range(2))
    return left @ np.diag(values) @ right


MATRICES = {
    "one": np.array([[3.0]]),
    "random": DRAW.normal(size=(40, 40)),
    "graded": np.triu(DRAW.normal(size=(40, 40))) * np.logspace(0, -12, 40),
    "identity": np.eye(20),
    "zero": np.zeros((5, 5)),
    "equal values": with_values([3.0] * 15 + [2.0] * 10 + [1.0] * 15),
    "close values": with_values(list(1 + 1e-9 * np.arange(20)) + list(5 + 1e-6 * np.arange(20))),
    "deficient": with_values([1.0] * 20 + [0.0] * 20),
    "constant": np.ones((30, 30)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_against_the_svd(name):
    matrix = MATRICES[name]
    values, vectors = right_singular(matrix)
    want = np.linalg.svd(matrix, compute_uv=False) ** 2
    assert np.allclose(values, want, rtol=1e-10, atol=1e-25 * max(want[0], 1e-300))
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    assert np.abs(matrix.T @ matrix @ vectors - vectors * values).max() <= 1e-13 * max(want[0], 1e-300)


def test_small_values_are_found_to_high_relative_accuracy():
    diagonal, upper = np.logspace(0, -15, 30), np.logspace(-1, -16, 29)
    product = squared_singular_values(diagonal, upper).prod() ** 0.5
    assert product == pytest.approx(diagonal.prod(), rel=1e-12)


def test_bidiagonal_form():
    matrix = DRAW.normal(size=(9, 9))
    diagonal, upper, v = bidiagonalise(matrix)
    form = np.diag(diagonal) + np.diag(upper, 1)
    assert np.allclose(v @ form.T @ form @ v.T, matrix.T @ matrix)


def check(rows, dimensions, found, components=32):
    """``rows`` are the usable (id, vector)."""
    x = np.floor(64 * np.array([np.array(v, np.float32) for _, v in rows], float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    apart = x * n - sums
    want = sorted((i, int((a.astype(object) ** 2).sum())) for (i, _), a in zip(rows, apart, strict=True))
    count = min(components, dimensions)
    got = found.collect()
    assert len(got) == n * count and {r["n"] for r in got} == {n}
    assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == want
    centred = apart / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(covariance), rel=1e-6)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-6
    whitened = centred @ vectors / np.sqrt(values)
    by_id = {i: w for (i, _), w in zip(rows, whitened, strict=True)}
    for c in range(count):
        own = [(by_id[r["vec_id"]][c], r["whitened"]) for r in got if r["component"] == c + 1]
        sign = np.sign(sum(a * b for a, b in own))
        assert max(abs(a - sign * b) for a, b in own) < 1e-6


def test_embeddings_against_numpy(spark, monkeypatch):
    """The table as it is, and with so few triangles per task that they are folded in several rounds."""
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    check(rows, 64, whiten_embeddings(vectors))
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    check(rows, 64, whiten_embeddings(vectors.repartition(9)))


def test_odd_rows(spark):
    good = [(i, DRAW.normal(size=5).tolist()) for i in range(30)] + [(7, [0.0] * 5)]
    bad = [(50, None), (51, []), (52, [1.0]), (53, [float("nan")] * 5), (54, [None] * 5), (55, [float("-inf")] * 5)]
    rows = [(*r, 1, 2.0) for r in [*good, *bad]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, whitened double")
    found = whiten_embeddings(vectors)
    assert found.count() == 31 * 5 and found.select("vec_id").distinct().count() == 30
    assert whiten_embeddings(vectors.limit(0)).count() == 0
    assert whiten_embeddings(vectors.filter("vec_id > 49 AND vec_id <> 52")).count() == 0


def test_directions_without_spread_are_null(spark):
    rows = [(i, [float(i), 1.0, 2.0 * i]) for i in range(20)]
    found = whiten_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in found)
    assert found[0]["identity_error"] < 1e-9
    same = whiten_embeddings(spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>"))
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in same.collect()] == [(None, 0.0, 0)] * 2


def test_deviations_are_exact_or_null():
    rows = np.array([[1 << 20, 0], [0, 1 << 20]])
    n = 1 << 12
    assert deviations(rows, n, np.zeros(2, np.int64)) == [None, None]
    assert deviations(rows, 1 << 10, np.zeros(2, np.int64)) == [1 << 60, 1 << 60]
