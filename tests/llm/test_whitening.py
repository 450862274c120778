import math

import numpy as np
import pytest

from cases import SMALL, table
from inkwell.llm import whitening as W
from inkwell.llm.queries import QUERIES


def plain(vectors, components=8):
    """(deviations, whitened, explained) by whole numbers and a library's eigenvectors."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return deviation, centred @ axes / np.sqrt(values), values / np.trace(covariance)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_query_against_a_library(spark):
    source = [r for r in table("embeddings")]
    deviation, whitened, explained = plain([r["embedding"] for r in source])
    rows = QUERIES["op11_whitening"](spark, SMALL).collect()
    assert len(rows) == 8 * len(source)
    at = {r["vec_id"]: i for i, r in enumerate(source)}
    got = np.zeros((len(source), 8))
    for r in rows:
        i = at[r["vec_id"]]
        got[i, r["component"] - 1] = r["whitened"]
        assert r["n"] == len(source) and r["deviation"] == deviation[i]
        assert abs(r["explained"] - explained[r["component"] - 1]) <= 1e-9 and r["identity_error"] <= 1e-9
    for k in range(8):
        assert min(np.abs(got[:, k] - whitened[:, k]).max(), np.abs(got[:, k] + whitened[:, k]).max()) < 1e-6
    assert np.abs(np.cov(got.T, bias=True) - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("size", [1, 2, 3, 8, 64, 120])
def test_components_of_random_matrices(size):
    rng = np.random.default_rng(size)
    made = rng.standard_normal((size, size))
    matrix = made @ made.T
    values, vectors = W.components_of(matrix)
    want, axes = np.linalg.eigh(matrix)
    assert np.allclose(values, want[::-1], rtol=0, atol=1e-12 * want[-1])
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-13
    assert np.abs(np.abs((vectors * axes[:, ::-1]).sum(0)) - 1).max() < 1e-10


def test_components_of_hard_matrices():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    for values in (np.ones(40), np.zeros(40), np.repeat([1000.0, 999.9999999, 1.0, 1e-6], 10), np.geomspace(1e12, 1e-6, 40),
                   np.r_[1e5, np.ones(39)], np.r_[np.ones(39), 0], 1 + 1e-13 * np.arange(40)):
        matrix = (turn * values) @ turn.T
        matrix = (matrix + matrix.T) / 2
        got, vectors = W.components_of(matrix)
        top = max(values.max(), 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-10
        assert np.abs(matrix @ vectors - vectors * got).max() <= 1e-11 * top
        assert np.abs(got - np.sort(values)[::-1]).max() <= 1e-11 * top


def test_polar_factor():
    rng = np.random.default_rng(1)
    made = rng.standard_normal((30, 30))
    made = made + made.T
    factor = W.polar(made)
    values, axes = np.linalg.eigh(made)
    assert np.abs(factor - (axes * np.sign(values)) @ axes.T).max() < 1e-12


def test_rows_left_out(spark):
    bad = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("inf"), 0.0]), (6, [1e30, 0.0]),
           (7, [1.0, 2.0, 3.0])]
    good = [(None, [0.0, 1.0]), (8, [1.0, 0.5]), (8, [1.0, 0.5]), (9, [-1.0, 3.0])]
    rows = W.whiten(frame(spark, bad + good)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in rows) == [
        (False, 8, 1), (False, 8, 1), (False, 8, 2), (False, 8, 2), (False, 9, 1), (False, 9, 2), (True, 0, 1), (True, 0, 2)]
    deviation, _, explained = plain([v for _, v in good])
    assert {r["deviation"] for r in rows} == set(deviation) and rows[0]["n"] == 4
    assert abs(rows[0]["identity_error"]) < 1e-9


def test_no_variance_and_no_rows(spark):
    flat = W.whiten(frame(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in flat] == [(0, None, None, None)] * 4
    line = W.whiten(frame(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.0])])).collect()
    assert {r["component"]: r["explained"] for r in line} == {1: 1.0, 2: 0.0}
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line) and line[0]["identity_error"] < 1e-9
    assert W.whiten(frame(spark, [])).collect() == [] == W.whiten(frame(spark, [(1, None)])).collect()


def test_sums_beyond_64_bits(spark):
    rows = [(i, [float(2 ** 32 * (i % 3)), float(i)]) for i in range(50)]
    got = {(r["vec_id"], r["component"]): r for r in W.whiten(frame(spark, rows)).collect()}
    x = np.array([[math.floor(1024 * float(np.float32(c))) for c in v] for _, v in rows], object)
    centred = (50 * x - x.sum(0)) ** 2
    for i in range(50):
        want = int(centred[i].sum())
        assert got[i, 1]["deviation"] == (want if want < 2 ** 63 else None)
    assert got[0, 1]["identity_error"] < 1e-6


def test_clashing_columns_and_types(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], 1, "x"), ("b", [2.0, 1.0], 2, "y")],
                               "component string, deviation array<double>, n int, id_ string")
    rows = W.whiten(df, "component", "deviation", 1)
    assert rows.columns[0] == "component" and rows.count() == 2
