import math
import random

import numpy as np
import pytest

from tidewatch.llm import whitening
from tidewatch.llm.bidiagonal import bidiagonalise, singular_pairs, squared_values
from tidewatch.llm.whitening import fit_whitening, whiten, whitening_report


def spectra():
    rng = np.random.default_rng(7)
    q, p = (np.linalg.qr(rng.normal(size=(40, 40)))[0] for _ in range(2))
    yield "plain", rng.normal(size=(40, 40)) * 100
    yield "equal", q * 7
    yield "cluster", q @ np.diag(np.r_[5 + 1e-8 * np.arange(8), np.linspace(3, 1, 32)]) @ p.T
    yield "close", q @ np.diag(5 * (1 + 1e-4 * np.arange(40))) @ p.T
    yield "graded", q @ np.diag(10.0 ** -np.linspace(0, 18, 40)) @ p.T
    yield "rank", rng.normal(size=(40, 6)) @ rng.normal(size=(6, 40))
    yield "zero", np.zeros((5, 5))
    yield "one", np.array([[-3.0]])
    yield "wilkinson", np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1)
    constant = rng.normal(size=(40, 40))
    constant[:, 5], constant[:, 9] = 0, constant[:, 10]
    yield "columns", constant


@pytest.mark.parametrize("name, matrix", list(spectra()))
def test_singular_pairs_to_double_precision(name, matrix):
    n = len(matrix)
    values, vectors = singular_pairs(matrix, n)
    want = np.linalg.svd(matrix, compute_uv=False) ** 2
    assert np.abs(values - want).max() <= 1e-13 * max(want[0], 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
    assert np.abs(matrix.T @ matrix @ vectors - vectors * values).max() <= 1e-13 * max(want[0], 1e-300)


def test_bidiagonal_form_and_relative_accuracy():
    rng = np.random.default_rng(8)
    m = rng.normal(size=(9, 9))
    a, b, v = bidiagonalise(m)
    square = np.diag(a) + np.diag(b, 1)
    assert np.allclose(square.T @ square, v.T @ m.T @ m @ v, atol=1e-13 * 100)
    # A graded bidiagonal matrix: even its least value has all digits.
    a, b = 10.0 ** -np.arange(0, 60, 6.0), 10.0 ** -np.arange(1, 55, 6.0)
    from fractions import Fraction

    got = squared_values(a, b)
    product = math.prod(Fraction(float(x)) ** 2 for x in a)
    assert abs(float(math.prod(Fraction(float(x)) for x in got) / product) - 1) < 1e-13


def table(spark, vectors, ids=None, parts=3):
    rows = [(ids[i] if ids else i, None if v is None else [None if c is None else float(c) for c in v], 1.0, 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened double, n int").repartition(parts)


def check(spark, vectors, k=8, parts=3):
    """Against exact sums and numpy's eigenvectors."""
    kept = [(i, v) for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), [int(s) for s in x.astype(object).sum(axis=0)]
    centred = x - np.array(sums) / n
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1], vec[:, ::-1]
    got = whitening_report(table(spark, vectors, parts=parts), k).collect()
    k = min(k, x.shape[1])
    assert len(got) == n * k
    w = np.full((len(vectors), k), np.nan)
    for r in got:
        i, c = r["vec_id"], r["component"]
        w[i, c - 1] = r["whitened"]
        assert r["n"] == n and abs(r["explained"] - e[c - 1] / e.sum()) < 1e-9 and r["identity_error"] < 1e-9
    places = [i for i, _ in kept]
    deviations = {r["vec_id"]: r["deviation"] for r in got}
    for i, row in zip(places, x.tolist(), strict=True):
        assert deviations[i] == sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
    want = centred @ vec[:, :k] / np.sqrt(e[:k])
    want *= np.sign((want * w[places]).sum(axis=0))
    assert np.abs(want - w[places]).max() < 1e-7
    return got


def test_report_equals_numpy(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vectors = (rng.normal(size=(400, 12)) * np.linspace(1, 3, 12) + rng.normal(size=12) * 5).tolist()
    vectors += [None, [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, vectors[3], vectors[3]]
    check(spark, vectors)
    monkeypatch.setattr(whitening, "STACK_BYTES", 2 * 8 * 12 * 12)
    check(spark, vectors, parts=9)


def test_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    check(spark, [r["embedding"] for r in rows])


def test_flat_directions_and_few_rows(spark):
    got = whitening_report(table(spark, [[1.0, 2.0, 3.0]] * 5)).collect()
    assert len(got) == 15 and {(r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in got} == {(None, 0, None, None)}
    got = whitening_report(table(spark, [[1.0, 2.0, 5.0], [2.0, 2.0, 5.0]])).collect()
    assert sorted((r["component"], r["whitened"]) for r in got if r["component"] == 1) == [(1, pytest.approx(-1)), (1, pytest.approx(1))]
    assert {r["whitened"] for r in got if r["component"] > 1} == {None}
    assert whitening_report(table(spark, [[4.0]])).collect()[0]["n"] == 1


def test_awkward_rows(spark):
    rng = random.Random(10)
    vectors = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(30)]
    odd = vectors + [[1.0, 2.0], [], [1e30, 0, 0, 0], None]
    got = whitening_report(table(spark, odd, ids=[None, 1, 1, *range(3, len(odd))])).collect()
    assert len(got) == 120 and sum(r["vec_id"] is None for r in got) == 4 and sum(r["vec_id"] == 1 for r in got) == 8
    for empty in (table(spark, vectors).limit(0), table(spark, [None, []])):
        report = whitening_report(empty)
        assert report.count() == 0 and report.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
        ]


def test_deviations_beyond_64_bits_are_null(spark):
    big = [[2.0**40, 0.0], [-(2.0**40), 0.0], [0.0, 1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(big)], "vec_id long, embedding array<double>")
    fitted = fit_whitening(df)
    got = {r["vec_id"]: r["deviation"] for r in whiten(df, fitted).collect()}
    sums = [300_000, 300_000 + 1024]
    assert got[0] is None and got[1] is None
    assert got[2] == (3 * 100_000 - sums[0]) ** 2 + (3 * 101_024 - sums[1]) ** 2
