"""Whitening, against eigenvectors of the covariance matrix."""

from __future__ import annotations

import math

import numpy as np
import pytest

from batchgate.llm import queries, whitening
from batchgate.llm.qd import bidiagonal, singular

SCHEMA = "vec_id long, embedding array<float>, n long, whitened string, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x", None) for i, v in rows], SCHEMA)


def kept(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def check(spark, rows, components=32, grid=whitening.Grid(64.0, 1_000_000)):
    got = whitening.whiten(table(spark, rows), components, grid).collect()
    rows = kept(rows)
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in rows)
    if not rows:
        return
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v] for _, v in rows])
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    m = min(components, int((e > 1e-9 * max(e[0], 1e-300)).sum()))
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), r)
    for (i, _), row, c in zip(rows, x, centred, strict=True):
        deviation = sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, total, strict=True))
        r = by_row[i, deviation]
        assert r.n == n and len(r.whitened) == len(r.explained) == m
        for k in range(m):
            assert r.explained[k] == pytest.approx(e[k] / e.sum(), rel=1e-6)
            alone = all(abs(e[k] - e[j]) > 1e-6 * e[0] for j in range(len(e)) if j != k)
            if alone:
                assert abs(r.whitened[k]) == pytest.approx(abs(c @ u[:, k]) / math.sqrt(e[k]), abs=1e-5)
    white = np.array([r.whitened for r in got]).reshape(len(got), m)
    assert np.abs(white.T @ white / n - np.eye(m)).max(initial=0) < 1e-6
    assert all(r.identity_error < 1e-6 for r in got)


def test_whole_vectors(spark):
    rng = np.random.default_rng(1)
    mixed = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6))
    check(spark, list(enumerate(mixed.tolist())), components=4)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((50, 3)).tolist())]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [math.nan, 1.0, 1.0]), (104, [math.inf, 1.0, 1.0])]
    rows += [(None, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (3, rows[3][1]), (3, rows[3][1])]
    check(spark, rows)


def test_vectors_with_fewer_directions(spark):
    rng = np.random.default_rng(3)
    plane = rng.integers(-40, 40, (80, 2)) @ rng.integers(-3, 4, (2, 7)) / 64.0
    check(spark, list(enumerate(plane.tolist())))


def test_equal_and_few_vectors(spark):
    check(spark, [(1, [0.5, 0.25])] * 5)
    check(spark, [(1, [0.5, 0.25])])
    check(spark, [(1, [0.5, 0.25]), (2, [0.5, 1.25])])
    check(spark, [])
    check(spark, [(1, None), (2, [None, 1.0])])


def test_equal_variances(spark):
    """Directions are not unique then, but still orthogonal."""
    rows = [(i, [float(j == i % 5) * (1 if i % 2 else -1) for j in range(5)]) for i in range(100)]
    check(spark, rows)


def test_many_tasks_are_merged_in_rounds(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate((rng.standard_normal((400, 3)) * [1, 2, 5]).tolist()))
    one = whitening.fit(table(spark, rows).coalesce(1), 3, whitening.Grid(64.0, 7))
    many = whitening.fit(table(spark, rows).repartition(40), 3, whitening.Grid(64.0, 7))
    assert (one.n, one.total) == (many.n, many.total)
    assert np.allclose(one.deviations, many.deviations, rtol=1e-12)
    assert np.allclose(np.abs(one.directions), np.abs(many.directions), atol=1e-9)


def test_vectors_of_different_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_deviations_beyond_a_long(spark):
    far = [(1, [1e16]), (2, [0.0]), (3, [64.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, far)).collect()}
    assert got == {1: None, 2: None, 3: None}
    near = [(1, [2.0**30]), (2, [0.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, near)).collect()}
    assert got == {1: 1 << 60, 2: 1 << 60}


def test_singular_values_and_vectors():
    rng = np.random.default_rng(5)
    turn = [np.linalg.qr(rng.standard_normal((30, 30)))[0] for _ in range(2)]
    cases = [rng.standard_normal((n, n)) for n in (1, 2, 3, 17, 64)]
    cases += [np.eye(6), np.zeros((3, 3)), np.ones((9, 9)), np.diag([3.0, 3, 3, 2, 2, 0, 0])]
    cases += [turn[0] @ np.diag(s) @ turn[1] for s in (np.logspace(0, -14, 30), [5.0] * 15 + [1.0] * 15)]
    cases += [turn[0] @ np.diag([1.0] * 8 + [1 + 1e-9] * 8 + [0.0] * 14) @ turn[1]]
    for a in cases:
        s, v = singular(a)
        want = np.linalg.svd(a)[1]
        assert np.allclose(s, want, atol=1e-13 * max(want[0], 1))
        assert np.abs(v.T @ v - np.eye(len(a))).max() < 1e-10
        assert np.abs(a.T @ (a @ v) - v * s**2).max() <= 1e-12 * max(want[0] ** 2, 1)


def test_small_singular_values_are_found_to_their_own_accuracy():
    """Of a bidiagonal matrix, whose entries fix each value to all digits."""
    main, upper = np.logspace(0, -12, 13), np.logspace(-1, -13, 12)
    a = np.diag(main) + np.diag(upper, 1)
    s, _ = singular(a)
    # The product of the values is that of the diagonal.
    assert np.sum(np.log(s)) == pytest.approx(np.sum(np.log(main)), rel=1e-9)


def test_bidiagonal_form():
    a = np.random.default_rng(6).standard_normal((8, 8))
    main, upper, right = bidiagonal(a)
    b = np.diag(main) + np.diag(upper, 1)
    assert np.allclose(b.T @ b, right.T @ a.T @ a @ right)
    assert np.allclose(right.T @ right, np.eye(8))


def test_the_query(spark, llm):
    got = queries.QUERIES["op13_whitening"](llm, "/root/testdata/sf0.001").toPandas()
    vectors = llm.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()
    x = np.floor(64 * np.stack(vectors.embedding.tolist()).astype(np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    e, u = np.linalg.eigh((x - total / n).T @ (x - total / n) / n)
    e, u = e[::-1], u[:, ::-1]
    white = got.pivot(index="vec_id", columns="component", values="whitened").loc[vectors.vec_id].to_numpy()
    want = (x - total / n) @ u[:, :32] / np.sqrt(e[:32])
    assert white.shape == want.shape
    assert np.allclose(np.abs(white), np.abs(want), atol=1e-7)
    signs = np.sign(white * want).sum(axis=0)
    assert (np.abs(signs) > n - 5).all()
    first = got[got.component == 1].set_index("vec_id").loc[vectors.vec_id]
    assert (first.deviation.to_numpy() == ((n * x - total) ** 2).sum(axis=1)).all()
    share = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(share, e[:32] / e.sum(), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
