"""Sparse matrix products on coordinate (COO) tables ``(i, j, v)``.

The product is one equi-join on the inner index plus a grouped sum:
    C[i, k] = sum_j A[i, j] * B[j, k]
Spark does a partial sum right after the join (map side), so only one row per
output cell and task crosses the shuffle. An inner index that is dense on both
sides makes its join output ``nA * nB`` rows; such hot indexes are salted over
several tasks. Any shape works; cells present on one side only contribute nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.chunks import CHUNK_ENTRIES, chunked_lists
from sparkmine.operators.skew import hot_keys, salted_join


def coalesce_cells(m: DataFrame) -> DataFrame:
    """Sum duplicate coordinates (the documented input convention)."""
    return m.groupBy("i", "j").agg(F.sum("v").alias("v"))


def matmul(a: DataFrame, b: DataFrame, pairs_per_tile: int | None = None, sum_duplicates: bool = True) -> DataFrame:
    """``A (i, j, v) x B (i, j, v) -> C (i, j, v)``."""
    if sum_duplicates:
        a, b = coalesce_cells(a), coalesce_cells(b)
    left = a.select(F.col("i").alias("row"), F.col("j").alias("k"), F.col("v").alias("va"))
    right = b.select(F.col("i").alias("k"), F.col("j").alias("col"), F.col("v").alias("vb"))
    joined = salted_join(left, right, ["k"], hot_keys(left, ["k"], right, pairs_per_tile))
    return joined.groupBy(F.col("row").alias("i"), F.col("col").alias("j")).agg(F.sum(F.col("va") * F.col("vb")).alias("v"))


def split_tagged(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(mat, i, j, v)`` with tags A/B -> the two COO frames."""
    a = cells.where(F.col("mat") == "A").select("i", "j", "v")
    b = cells.where(F.col("mat") == "B").select("i", "j", "v")
    return a, b


def row_vectors(m: DataFrame) -> DataFrame:
    """``(i, entries array<struct<j, v>>)`` ordered by column index (one row per matrix row)."""
    return m.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("entries"))


def row_vector_chunks(m: DataFrame, size: int = CHUNK_ENTRIES) -> DataFrame:
    """``(i, chunk, entries)``: the row vectors in pieces of at most ``size`` cells, so no task holds a whole row."""
    return chunked_lists(m, ["i"], ["j", "v"], size=size)


def sorted_cells(c: DataFrame) -> DataFrame:
    """Global ``(i, j)`` order: a range-partitioned sort, no single-task step."""
    return c.orderBy("i", "j")
