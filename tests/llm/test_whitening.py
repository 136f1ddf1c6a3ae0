import math

import numpy as np
import pytest

from tidemark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, index int, deviation string, n int, part double"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 3, "x", 1, 0.5) for i, v in rows], SCHEMA)


def _plain(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    off = n * x - s
    centred = off / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    return off, centred @ u[:, :k] / np.sqrt(e[:k]), e / e.sum()


def _vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(0.5, 8, d) + 3).astype(np.float32).tolist()


@pytest.mark.parametrize("rows, columns", [(1024, 256), (16, 3)])
def test_against_numpy(spark, monkeypatch, rows, columns):
    """Also with small blocks, so that several row and column blocks meet."""
    monkeypatch.setattr(W, "ROWS", rows)
    monkeypatch.setattr(W, "COLUMNS", columns)
    vectors = _vectors(150, 7)
    odd = [(900, None), (901, []), (902, [1.0, None] + [0.0] * 5), (903, [math.nan] * 7), (904, [math.inf] + [0.0] * 6), (905, [-math.inf] + [0.0] * 6)]
    got = W.whitened(_table(spark, [*enumerate(vectors), *odd]), components=5).collect()
    off, want, share = _plain(vectors, 5)
    assert len(got) == 150 * 5 and {r.n for r in got} == {150}
    y = np.zeros((150, 5))
    for r in got:
        y[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == (off[r.vec_id] ** 2).sum()
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
    assert np.abs(y * np.sign((y * want).sum(0)) - want).max() < 1e-8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_null_and_repeated_ids(spark):
    vectors = _vectors(40, 3)
    got = W.whitened(_table(spark, [(None if i % 3 == 0 else 7, v) for i, v in enumerate(vectors)])).collect()
    assert len(got) == 120 and sum(r.vec_id is None for r in got) == 14 * 3


def test_components_without_variance(spark):
    """A constant entry, and a table of one vector."""
    vectors = [[a, 5.0] for a in (1.0, 2.0, 4.0)]
    got = {(r.vec_id, r.component): r for r in W.whitened(_table(spark, enumerate(vectors))).collect()}
    assert got[0, 1].whitened is not None and got[0, 2].whitened is None and got[0, 2].explained < 1e-12 and got[0, 1].identity_error < 1e-9
    one = W.whitened(_table(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in one] == [(None, None, 0, None)] * 2


def test_large_values_stay_exact(spark):
    """Sums of squares beyond a long are null, others exact through decimals."""
    got = {r.vec_id: r.deviation for r in W.whitened(_table(spark, [(1, [1e15]), (2, [0.0]), (3, [5e14])])).collect()}
    x = [int(64 * float(np.float32(v))) + 1_000_000 for v in (1e15, 0.0, 5e14)]
    want = [(3 * v - sum(x)) ** 2 for v in x]
    assert [got[i] for i in (1, 2, 3)] == [w if w < 1 << 63 else None for w in want]


def test_empty_and_mixed(spark):
    assert W.whitened(_table(spark, [])).collect() == []
    assert W.whitened(_table(spark, [(1, None), (2, [])])).collect() == []
    with pytest.raises(ValueError, match="no common covariance"):
        W.whitened(_table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
