import numpy as np
import pytest

from sparkmine.operators import cur as CUR
from sparkmine.operators import tall_qr as Q


def cells(spark, m, parts=11):
    rows = [(i, j, float(v)) for i, row in enumerate(m) for j, v in enumerate(row) if v]
    return spark.createDataFrame(rows, "i long, j long, v double").repartition(parts)


def table(df, n, m):
    out = np.zeros((n, m))
    for r in df.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def test_factor_has_the_gram_matrix(spark):
    m = np.random.default_rng(1).normal(size=(300, 5))
    m[40:60] = 0
    r = Q.triangular_factor(cells(spark, m), 5)
    assert np.allclose(np.tril(r, -1), 0) and np.allclose(r.T @ r, m.T @ m)


def test_many_partitions_need_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(Q, "FAN_IN", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        m = np.random.default_rng(2).normal(size=(200, 4))
        r = Q.triangular_factor(cells(spark, m), 4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert np.allclose(r, Q._triangle(m))


def test_pseudo_inverse_at_condition_1e7(spark):
    """Within 1e-8 of numpy's; the way over the Gram matrix is far off there."""
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.normal(size=(400, 6)))
    v, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    m = (u * np.logspace(0, -7, 6)) @ v.T
    want = np.linalg.pinv(m)
    b = Q.orthonormal_basis(cells(spark, m), 6)
    q = np.linalg.solve(b.fix.T, table(b.rows, 400, 6).T).T
    assert np.linalg.norm(q.T @ q - np.eye(6)) < 1e-12
    got = Q.small_pinv(b.coords) @ q.T
    assert np.linalg.norm(got - want) / np.linalg.norm(want) < 1e-8
    gram = np.linalg.pinv(m.T @ m) @ m.T
    assert np.linalg.norm(gram - want) / np.linalg.norm(want) > 1e-4


def test_repeated_columns_and_zero_matrix(spark):
    m = np.random.default_rng(4).normal(size=(50, 2))[:, [0, 1, 0]]
    b = Q.orthonormal_basis(cells(spark, m), 3)
    assert b.coords.shape == (2, 3)
    got = Q.small_pinv(b.coords) @ np.linalg.solve(b.fix.T, table(b.rows, 50, 2).T)
    assert np.allclose(got, np.linalg.pinv(m))
    none = Q.orthonormal_basis(spark.createDataFrame([], "i long, j long, v double"), 3)
    assert none.coords.shape == (0, 3) and none.rows.count() == 0


@pytest.mark.parametrize("k", [1, 2, -1])
def test_rank_k_against_numpy(spark, k):
    m = np.random.default_rng(5).normal(size=(14, 7))
    f = CUR.cur(cells(spark, m), 5, 4, k=k, draws_rows=CUR.fixed_draws(spark, 5), draws_cols=CUR.fixed_draws(spark, 4))
    rid = [r["idx"] for r in f["rows"].orderBy("pos").collect()]
    cid = [r["idx"] for r in f["cols"].orderBy("pos").collect()]

    def pinv(x):
        u, s, vt = np.linalg.svd(x, full_matrices=False)
        keep = s > 1e-12 * s[0]
        keep[k if k > 0 else len(s):] = False
        return (vt[keep].T / s[keep]) @ u[:, keep].T

    c, r = m[:, cid], m[rid, :]
    u = pinv(c) @ m @ pinv(r)
    assert np.allclose(table(f["U"], 4, 5), u, atol=1e-9)
    assert f["error"] == pytest.approx(np.linalg.norm(m - c @ u @ r), rel=1e-6)
