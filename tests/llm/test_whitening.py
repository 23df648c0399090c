import math

import numpy as np
import pytest

from roentra.llm import bidiagonal, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows):
    return [
        (i, [float(np.float32(c)) for c in v])
        for i, v, *_ in rows
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)
    ]


def brute(rows, most=32):
    """n, deviations by id, and (e, directions, mean) from the whole covariance in memory."""
    kept = usable(rows)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    apart = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    e, w = np.linalg.eigh(apart.T @ apart / n)
    return [i for i, _ in kept], deviations, apart, e[::-1][:most], w[:, ::-1][:, :most], e.sum()


def against_brute(found, rows, most=32):
    ids, deviations, apart, e, w, total = brute(rows, most)
    n = len(ids)
    by_component = {}
    for r in found:
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by_component) == list(range(1, len(e) + 1))
    for k, own in by_component.items():
        assert sorted(own) == sorted(ids)
        expected = apart @ w[:, k - 1] / np.sqrt(e[k - 1])
        white = np.array([own[i]["whitened"] for i in ids])
        sign = np.sign(white @ expected)
        assert np.abs(sign * white - expected).max() < 1e-9
        for i, d in zip(ids, deviations):
            assert (own[i]["n"], own[i]["deviation"]) == (n, d)
            assert own[i]["explained"] == pytest.approx(e[k - 1] / total, rel=1e-9)
            assert own[i]["identity_error"] < 1e-9


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(7)
    rows = df.select("vec_id", "embedding").collect()
    against_brute(whitening.whiten(df).collect(), [tuple(r) for r in rows])


def test_small_variances_keep_their_digits(spark):
    """Variances from 1e8 to 1: products of the whole steps would lose the small ones."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * np.array([1e4, 1e3, 300, 100, 30, 1]) @ np.linalg.qr(
        rng.normal(size=(6, 6))
    )[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = whitening.whiten(df, most=6).collect()
    kept = [(i, v) for i, v in rows]
    n, steps = len(kept), np.floor(64 * np.array([v for _, v in kept]))
    white = np.zeros((n, 6))
    for r in found:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    white -= white.mean(axis=0)
    assert np.abs(white.T @ white / n - np.eye(6)).max() < 1e-9
    squares = np.linalg.svd(steps - steps.mean(axis=0), compute_uv=False) ** 2
    shares = {r["component"]: r["explained"] for r in found}
    assert [shares[k] for k in range(1, 7)] == pytest.approx(list(squares / squares.sum()), rel=1e-9)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).tolist(), 0) for i in range(30)]
    # Repeated rows and ids, a null id, and vectors that do not count.
    odd = [good[0], (3, [1.0, 2.0, 3.0, 4.0], 1), (None, [0.5, 0.0, -1.0, 2.0], 1)]
    bad = [
        (100, None, 1),
        (101, [1.0, None, 1.0, 1.0], 1),
        (102, [float("nan"), 1.0, 1.0, 1.0], 1),
        (103, [float("inf"), 1.0, 1.0, 1.0], 1),
        (104, [], 1),
        (105, [1.0, 2.0], 1),
        (106, [3e38, 1.0, 1.0, 1.0], 1),
    ]
    df = spark.createDataFrame(good + odd + bad, SCHEMA)
    for name in ("component", "n", "payload", "id", "vector", "part"):
        df = df.withColumn(name, df["label"])
    found = whitening.whiten(df).collect()
    assert len(found) == 4 * 33 and {r["n"] for r in found} == {33}
    assert sum(r["vec_id"] is None for r in found) == 4
    assert sum(r["vec_id"] == 0 for r in found) == sum(r["vec_id"] == 3 for r in found) == 8
    assert {r["vec_id"] for r in found} == {None, *range(30)}
    assert max(r["identity_error"] for r in found) < 1e-12


def test_no_variance_no_rows(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(9)]):
        found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert found.collect() == []
        assert found.columns[0] == "vec_id" and len(found.columns) == 7


def test_dependent_entries_have_fewer_components(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 5.0, float(i % 3)], 0) for i in range(40)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1, 2}
    assert sum({r["component"]: r["explained"] for r in found}.values()) == pytest.approx(1)


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [1e9 * i, -1e9], 0) for i in range(4)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {r["deviation"] for r in found.collect()} == {None}
    rows = [(i, [1e6 * i, -1e6], 0) for i in range(4)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    steps = [64 * 10**6 * i for i in range(4)]
    assert {r["vec_id"]: r["deviation"] for r in found.collect()} == {
        i: (4 * s - sum(steps)) ** 2 for i, s in enumerate(steps)
    }


def test_many_parts_are_joined_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ARITY", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).tolist(), 0) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(11)
    against_brute(whitening.whiten(df).collect(), rows)


SPECTRA = {
    "random": lambda rng, n: np.sort(rng.random(n))[::-1],
    "graded": lambda rng, n: np.geomspace(1, 1e-7, n),
    "equal": lambda rng, n: np.repeat([3.0, 1.0], n // 2),
    "near": lambda rng, n: 2 - 1e-8 * np.arange(n),
    "chain": lambda rng, n: 2 - 1e-4 * np.arange(n),
    "zeros": lambda rng, n: np.concatenate([np.arange(n // 2, 0, -1), np.zeros(n - n // 2)]),
    "outlier": lambda rng, n: np.array([1e6, *np.linspace(2, 1, n - 1)]),
}


@pytest.mark.parametrize("kind", sorted(SPECTRA))
@pytest.mark.parametrize("n", [2, 16, 40])
def test_solver(kind, n):
    rng = np.random.default_rng(n)
    s = SPECTRA[kind](rng, n)
    left, right = (np.linalg.qr(rng.normal(size=(n, n)))[0] for _ in range(2))
    matrix = np.linalg.qr(left * s @ right, mode="r")
    squares, vectors = bidiagonal.right_singular(matrix, n)
    assert len(squares) == np.count_nonzero(s)
    assert np.abs(vectors.T @ vectors - np.eye(len(squares))).max() < 1e-11
    assert np.sqrt(squares) == pytest.approx(s[s > 0], rel=0, abs=1e-13 * s[0])
    images = matrix @ vectors
    assert np.abs(images.T @ images - np.diag(squares)).max() < 1e-12 * squares[0]


@pytest.mark.parametrize("n", [3, 12, 30])
def test_dqds_keeps_the_digits_of_small_values(n):
    """A bidiagonal matrix fixes its singular values to high relative accuracy, however small:
    compared with its inverse's, whose largest are their reciprocals."""
    rng = np.random.default_rng(n)
    a, b = np.geomspace(1, 1e-40, n) * (1 + rng.random(n)), np.geomspace(1, 1e-40, n)[:-1] * rng.random(n - 1)
    found = bidiagonal.squared_singular_values(a, b)
    # The inverse of B is triangular with entries that are products, exact to a few roundings.
    inverse = np.zeros((n, n))
    for j in range(n):
        inverse[j, j] = 1 / a[j]
        for i in range(j - 1, -1, -1):
            inverse[i, j] = -b[i] * inverse[i + 1, j] / a[i]
    largest = np.linalg.svd(inverse, compute_uv=False)[0] ** 2
    assert found[-1] == pytest.approx(1 / largest, rel=1e-13)
    assert np.log(found).sum() == pytest.approx(2 * np.log(a).sum(), rel=1e-13)
