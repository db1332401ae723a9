import numpy as np
import pytest

from sparkmine.operators import cur as CUR

DOC = [[1, 0, 2], [0, 1, 1]]


def coo(spark, m):
    return spark.createDataFrame([(i, j, float(v)) for i, row in enumerate(m) for j, v in enumerate(row) if v],
                                 "i long, j long, v double")


def draws(spark, us):
    return spark.createDataFrame(list(enumerate(us, 1)), "draw int, u double")


def test_probabilities(spark):
    a = coo(spark, DOC)
    rows = {r["idx"]: r["p"] for r in CUR.probabilities(a, "i").collect()}
    cols = {r["idx"]: r["p"] for r in CUR.probabilities(a, "j").collect()}
    assert rows[0] == pytest.approx(5 / 7) and rows[1] == pytest.approx(2 / 7)
    assert [cols[j] for j in range(3)] == pytest.approx([1 / 7, 1 / 7, 5 / 7])


def test_row_draws(spark):
    s = CUR.sample_indices(coo(spark, DOC), "i", draws(spark, [0.1, 0.5, 0.72, 0.99]))
    assert [r["idx"] for r in s.orderBy("pos").collect()] == [0, 0, 1, 1]


def test_draw_at_zero_takes_first(spark):
    s = CUR.sample_indices(coo(spark, DOC), "j", draws(spark, [0.0]))
    assert s.first()["idx"] == 0


def test_full_sample_reconstructs(spark):
    a = coo(spark, DOC)
    f = CUR.cur(a, 2, 3, draws_rows=draws(spark, [0.1, 0.9]), draws_cols=draws(spark, [0.1, 0.2, 0.9]))
    assert f["error"] == pytest.approx(0.0, abs=1e-6)
    c = np.zeros((2, 3))
    for r in f["C"].collect():
        c[r["i"], r["j"]] = r["v"]
    assert (c == np.array(DOC)).all()


def test_error_matches_numpy(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(12, 6))
    a = coo(spark, m.tolist())
    f = CUR.cur(a, 4, 3, draws_rows=CUR.fixed_draws(spark, 4), draws_cols=CUR.fixed_draws(spark, 3))
    rid = [r["idx"] for r in f["rows"].orderBy("pos").collect()]
    cid = [r["idx"] for r in f["cols"].orderBy("pos").collect()]
    Cm, Rm = m[:, cid], m[rid, :]
    U = np.linalg.pinv(Cm) @ m @ np.linalg.pinv(Rm)
    assert f["error"] == pytest.approx(np.linalg.norm(m - Cm @ U @ Rm), rel=1e-6, abs=1e-8)


def test_sampling_frequencies(spark):
    a = coo(spark, DOC)
    s = CUR.sample_indices(a, "i", CUR.random_draws(spark, 2000, seed=3))
    share = s.where("idx = 0").count() / 2000
    assert abs(share - 5 / 7) < 0.05
