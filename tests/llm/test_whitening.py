"""Whitening against exact integers and numpy's eigensolver."""

import math
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from daypulse.llm import whitening as W
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, n long, x string"


def brute(rows, components=4):
    """Integers, then eigh of the covariance computed as fractions."""
    whole = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
             if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, dims = len(fit), len(fit[0])
    sums = [sum(col) for col in zip(*fit)]
    centred = [[Fraction(v) - Fraction(s, n) for v, s in zip(x, sums)] for x in fit]
    v = np.array([[float(sum(r[a] * r[b] for r in centred) / n) for b in range(dims)] for a in range(dims)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for k, (i, x) in enumerate(whole):
        at = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums)])
        out[i] = (sum((n * a - s) ** 2 for a, s in zip(x, sums)), at @ vectors[:, :components])
    return n, values[:components], values.sum(), out


def agree(got, rows, components=4):
    n, values, trace, want = brute(rows, components)
    k = len(values)
    assert len(got) == k * sum(1 for i, _ in rows if i in want)
    signs = {}
    for r in got:
        assert r.n == n and r.deviation == want[r.vec_id][0]
        e = values[r.component - 1]
        assert abs(r.explained - e / trace) <= 1e-9
        if e > 1e-9 * values[0]:
            expected = want[r.vec_id][1][r.component - 1] / math.sqrt(e)
            if abs(expected) > 0.5:
                signs.setdefault(r.component, math.copysign(1, expected * r.whitened))
            assert abs(abs(expected) - abs(r.whitened)) < 1e-7
            if r.component in signs and abs(expected) > 1e-6:
                assert math.copysign(1, expected * r.whitened) == signs[r.component]
        else:
            assert r.whitened is None
        assert r.identity_error is None or r.identity_error <= 1e-9


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def test_small_vectors_and_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(40)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, [1.0, None] + [0.0] * 4),
             (104, [float("nan")] + [0.0] * 5), (105, [float("inf")] + [0.0] * 5), (106, []),
             (107, [-0.0] * 6), (108, [-0.001] * 6)]
    got = W.op11_embedding_whitening(spark, frame(spark, rows).repartition(5)).collect()
    agree(got, rows)
    assert {r.vec_id for r in got}.isdisjoint({102, 103, 104, 105, 106})


def test_given_embeddings(spark):
    rows = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pydict()
    rows = [(i, v[:12]) for i, v in zip(rows["vec_id"], rows["embedding"])]
    agree(W.op11_embedding_whitening(spark, frame(spark, rows).repartition(20)).collect(), rows)


def test_rank_one_table_and_fewer_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i]) for i in range(10)]
    got = W.op11_embedding_whitening(spark, frame(spark, rows)).collect()
    agree(got, rows)
    assert {r.component for r in got} == {1, 2}
    one = W.op11_embedding_whitening(spark, frame(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in one)


def test_other_lengths_huge_entries_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 0.0]), (3, [1.0]), (4, [1.0, 2.0, 3.0]), (5, [1e30, -1e30])]
    got = W.op11_embedding_whitening(spark, frame(spark, rows)).collect()
    assert sorted({r.vec_id for r in got}) == [1, 2, 5]
    assert all(r.deviation is None for r in got)    # beyond a long
    for empty in ([], [(1, None)], [(2, [float("nan")])]):
        assert W.op11_embedding_whitening(spark, frame(spark, empty)).collect() == []


CASES = {
    "random": np.random.default_rng(1).normal(size=(400, 16)),
    "fewer vectors than dimensions": np.floor(np.random.default_rng(2).normal(size=(9, 24)) * 30),
    "repeated vectors": np.tile(np.random.default_rng(4).integers(-2, 3, size=(5, 12)), (20, 1)).astype(float),
    "equal eigenvalues": np.eye(16) * 7.0,
    "dead dimensions": np.hstack([np.zeros((50, 3)), np.random.default_rng(5).integers(-1, 2, size=(50, 4))]).astype(float),
    "one vector many times": np.ones((10, 4)),
    "scales far apart": np.random.default_rng(6).normal(size=(300, 12)) * np.logspace(0, -10, 12),
    "one dimension": np.array([[5.0], [7.0], [7.5]]),
}


@pytest.mark.parametrize("name", CASES)
def test_incremental_spectrum(name):
    x = CASES[name]
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    parts = [W.Spectrum.empty(x.shape[1]) for _ in range(3)]
    for k, row in enumerate(x[:len(x) // 2]):       # one by one, then in blocks
        parts[k % 3].add(row[None, :])
    for k, rows in enumerate(np.array_split(x[len(x) // 2:], 5)):
        parts[k % 3].add(rows)
    whole = W.Spectrum.empty(x.shape[1])
    for part in parts:
        whole.merge(part)
    size = max(1.0, np.abs(scatter).max())
    assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - scatter).max() < 1e-12 * size
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert whole.n == len(x) and np.abs(whole.mean - x.mean(axis=0)).max() < 1e-12 * max(1, np.abs(x).max())


def test_secular_roots_close_poles():
    d = np.array([1.0, 1.0 + 1e-9, 1.0 + 2e-9, 5.0])
    z = np.array([1e-3, 2.0, 1e-6, 0.5])
    origin, x = W.secular_roots(d, z * z, 0.7)
    want = np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z))
    assert np.abs(d[origin] + x - want).max() < 1e-14 * 5
    roots = d[origin] + x
    assert (roots[:-1] >= d[:-1]).all() and (roots[:-1] <= d[1:]).all() and roots[-1] > d[-1]
