import numpy as np
from conftest import lines_df

from sparkmine.operators import matrix as M
from sparkmine.sources import text as io


def cells(df):
    return sorted((r["i"], r["j"], r["v"]) for r in df.collect())


def test_small_product(spark):
    lines = ["A,0,0,2", "A,0,1,3", "A,1,0,4", "A,1,1,5", "B,0,0,1", "B,0,1,7", "B,1,0,3", "B,1,1,9", "C,0,0,1"]
    a, b = M.split_tagged(io.parse_tagged_matrix(lines_df(spark, lines)))
    assert cells(M.matmul(a, b)) == [(0, 0, 11), (0, 1, 41), (1, 0, 19), (1, 1, 73)]


def test_sparse_rectangular(spark):
    a = spark.createDataFrame([(0, 0, 1), (0, 2, 2), (1, 1, 3)], "i long, j long, v long")
    b = spark.createDataFrame([(0, 0, 4), (1, 0, 5), (2, 0, 6)], "i long, j long, v long")
    assert cells(M.matmul(a, b)) == [(0, 0, 16), (1, 0, 15)]


def _coo(spark, m):
    return spark.createDataFrame([(i, j, int(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]) if m[i, j]],
                                 "i long, j long, v long")


def _dense(df, shape):
    out = np.zeros(shape, dtype=np.int64)
    for r in df.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def test_associative_and_numpy(spark):
    rng = np.random.default_rng(3)
    a, b, c = (rng.integers(-3, 4, s) * (rng.random(s) < 0.6) for s in [(5, 4), (4, 6), (6, 3)])
    A, B, C = _coo(spark, a), _coo(spark, b), _coo(spark, c)
    left = _dense(M.matmul(M.matmul(A, B), C), (5, 3))
    right = _dense(M.matmul(A, M.matmul(B, C)), (5, 3))
    assert (left == a @ b @ c).all() and (right == a @ b @ c).all()


def test_salted_product_and_duplicates(spark):
    a = spark.createDataFrame([(0, 0, 1), (0, 0, 2), (1, 0, 3), (2, 0, 4)], "i long, j long, v long")
    b = spark.createDataFrame([(0, 0, 5), (0, 1, 6)], "i long, j long, v long")
    want = [(0, 0, 15), (0, 1, 18), (1, 0, 15), (1, 1, 18), (2, 0, 20), (2, 1, 24)]
    assert cells(M.matmul(a, b)) == want
    assert cells(M.matmul(a, b, pairs_per_tile=1)) == want


def test_sorted_lines(spark):
    c = spark.createDataFrame([(1, 0, 3), (0, 1, 2), (0, 0, 1)], "i long, j long, v long")
    assert [r["value"] for r in io.format_matrix_cells(M.sorted_cells(c)).collect()] == ["0,0,1", "0,1,2", "1,0,3"]
