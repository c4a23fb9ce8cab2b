"""Whitening against numpy's eigenvalues and exact whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from martflow.llm import queries, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<double>, n string, whitened string, __vector string"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, "own", "own", None) for k, v in enumerate(vectors)], SCHEMA)


def naive(vectors, k=4):
    """(n, sums, whole vectors, eigenvalues, eigenvectors, trace) of the distinct whole vectors."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), float)
    centred = fit - fit.mean(axis=0)
    cov = centred.T @ centred / len(fit)
    values, vectors = np.linalg.eigh(cov)
    return len(fit), [int(s) for s in fit.sum(axis=0)], x, values[::-1][:k], vectors[:, ::-1][:, :k], np.trace(cov)


def same_whitened(found, x, n, sums, values, vectors):
    expected = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
    got = np.array(found)
    signs = np.sign((got * expected).sum(axis=0))
    np.testing.assert_allclose(got, expected * signs, rtol=1e-8, atol=1e-8)


def test_equals_numpy_on_random_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 7)) @ np.diag([5, 3, 2, 1, 0.5, 0.3, 0.1]) + 2
    vectors = [*base.tolist(), *base[:40].tolist(), *([base[7].tolist()] * 30)]
    rows = sorted(whitening.whiten(frame(spark, vectors)).collect(), key=lambda r: r["vec_id"])
    n, sums, x, values, components, trace = naive(vectors)
    assert len(rows) == len(vectors) and {r["n"] for r in rows} == {n}
    same_whitened([r["whitened"] for r in rows], x, n, sums, values, components)
    np.testing.assert_allclose(rows[0]["explained"], values / trace, rtol=1e-10)
    assert [int(r["deviation"]) for r in rows] == [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert rows[0]["identity_error"] < 1e-9 and rows[0]["__vector"] is None


def test_query_over_the_whole_table(spark):
    rows = queries.op13_whitening(spark, str(SF_SMALL)).collect()
    table = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pydict()
    usable = {i: v for i, v in zip(table["vec_id"], table["embedding"]) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    n, sums, x, values, components, trace = naive(list(usable.values()))
    by_id = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(by_id) == 4 * len(usable)
    same_whitened([[by_id[i, k + 1]["whitened"] for k in range(4)] for i in usable], x, n, sums, values, components)
    for i, v in zip(usable, x):
        r = by_id[i, 2]
        assert (r["n"], r["deviation"]) == (n, sum((n * c - s) ** 2 for c, s in zip(v, sums)))
        assert abs(r["explained"] - values[1] / trace) < 1e-10 and r["identity_error"] < 1e-9


def test_unusable_vectors_go_and_other_lengths_have_nulls(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [-1.0, 0.5], [1.0, 2.0]]
    bad = [None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [1e300, 0.0]]
    rows = whitening.whiten(frame(spark, good + bad + [[], [1.0, 2.0, 3.0]])).collect()
    assert sorted(r["vec_id"] for r in rows) == [0, 1, 2, 3, 9, 10]
    for r in rows:
        assert (r["whitened"] is None) == (r["vec_id"] > 3) == (r["deviation"] is None)
    assert all(len(r["whitened"]) == 2 and r["n"] == 3 for r in rows if r["vec_id"] < 4)


def test_no_variance_and_no_rows(spark):
    rows = whitening.whiten(frame(spark, [[1.0, 1.0, 1.0, 1.0, 1.0]] * 3)).collect()
    assert [r["whitened"] for r in rows] == [[None] * 4] * 3 and rows[0]["explained"] == [0.0] * 4
    assert rows[0]["identity_error"] is None and rows[0]["deviation"] == 0
    line = whitening.whiten(frame(spark, [[float(k), 2.0 * k, 0.0] for k in range(9)])).collect()
    assert line[0]["whitened"][1:] == [None, None] and abs(line[0]["explained"][0] - 1) < 1e-12
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [None, [None]])).count() == 0


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**40 + k, -(2.0**41) * k] for k in range(5)]
    rows = sorted(whitening.whiten(frame(spark, vectors)).collect(), key=lambda r: r["vec_id"])
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    assert [int(r["deviation"]) for r in rows] == [sum((5 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]


@pytest.mark.parametrize("size, rank", [(1, 1), (5, 5), (6, 3), (33, 33), (20, 20)])
def test_eigen_pairs_of_a_matrix(size, rank):
    rng = np.random.default_rng(size)
    half = rng.normal(size=(size, rank)) * 10.0 ** rng.uniform(-3, 3, rank)
    matrix = half @ half.T
    values, vectors = whitening.eigen_pairs(matrix)
    scale = np.abs(matrix).max()
    assert len(values) <= size and (np.diff(values) <= 0).all()
    np.testing.assert_allclose((vectors * values) @ vectors.T, matrix, atol=1e-11 * scale)
    live = values > 1e-9 * values[0]
    np.testing.assert_allclose((vectors.T @ vectors)[live][:, live], np.eye(live.sum()), atol=1e-10)


def test_packed_vectors_are_equal_only_if_the_vectors_are():
    x = np.array([[1, -1], [127, -128], [128, 0], [-32769, 5], [1 << 40, -(1 << 61)]])
    packed = whitening._packed(x)
    import pyarrow as pa

    assert (whitening._unpacked(pa.array(packed, pa.binary()), 2) == x).all()
    assert [p[0] for p in packed] == [1, 1, 2, 4, 8]
