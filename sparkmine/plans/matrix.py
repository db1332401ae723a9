"""Matrix-product queries: A = supplier x part (summed quantity), B = part x line number (line count)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import matrix as M
from sparkmine.sources import text as io
from sparkmine.sources.tables import table


def supplier_part(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("v")
    )


def part_linenumber(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("i"), F.col("l_linenumber").cast("bigint").alias("j")).agg(
        F.count(F.lit(1)).alias("v")
    )


def matmul_coo(spark, sf_dir):
    return M.matmul(supplier_part(spark, sf_dir), part_linenumber(spark, sf_dir))


def matrix_row_vectors(spark, sf_dir):
    rv = M.row_vectors(supplier_part(spark, sf_dir))
    return rv.select(
        "i",
        F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["j"].cast("string"), e["v"].cast("string"))), ",").alias("entries"),
    )


def matmul_sorted_lines(spark, sf_dir):
    """Tagged CSV lines in text files -> parse -> product -> global sort -> ``row,col,value`` lines."""
    lines = io.through_files(io.format_tagged_matrix(supplier_part(spark, sf_dir), part_linenumber(spark, sf_dir)), "cells")
    a, b = M.split_tagged(io.parse_tagged_matrix(lines))
    return io.format_matrix_cells(M.sorted_cells(M.matmul(a, b)))


ROW_CHUNK = 16


def matrix_row_chunks(spark, sf_dir):
    """Row vectors in rows of at most ``ROW_CHUNK`` cells."""
    rv = M.row_vector_chunks(supplier_part(spark, sf_dir), ROW_CHUNK)
    cells = F.transform("entries", lambda e: F.concat_ws(":", e["j"].cast("string"), e["v"].cast("string")))
    return rv.select("i", "chunk", F.array_join(cells, ",").alias("entries"))


def matmul_written(spark, sf_dir):
    """The product in files ordered by cell, read back with line numbers."""
    c = M.matmul(supplier_part(spark, sf_dir), part_linenumber(spark, sf_dir))
    return io.through_ordered_files(io.format_matrix_cells(c, keep=("i", "j")), "product", ["i", "j"])


_A = "SELECT l_suppkey AS i, l_partkey AS j, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2"
_B = "SELECT l_partkey AS i, CAST(l_linenumber AS BIGINT) AS j, COUNT(*) AS v FROM lineitem GROUP BY 1, 2"
_C = f"""
SELECT a.i AS i, b.j AS j, CAST(SUM(a.v * b.v) AS BIGINT) AS v
FROM ({_A}) a JOIN ({_B}) b ON a.j = b.i GROUP BY a.i, b.j
"""

QUERIES = {
    "matmul_coo": matmul_coo,
    "matrix_row_vectors": matrix_row_vectors,
    "matmul_sorted_lines": matmul_sorted_lines,
    "matrix_row_chunks": matrix_row_chunks,
    "matmul_written": matmul_written,
}

ORACLES = {
    "matmul_coo": _C,
    "matrix_row_vectors": f"SELECT i, string_agg(CAST(j AS VARCHAR) || ':' || CAST(v AS VARCHAR), ',' ORDER BY j) AS entries FROM ({_A}) GROUP BY i",
    "matmul_sorted_lines": f"SELECT CAST(i AS VARCHAR) || ',' || CAST(j AS VARCHAR) || ',' || CAST(v AS VARCHAR) AS value FROM ({_C})",
    "matrix_row_chunks": f"""
SELECT i, CAST(chunk AS BIGINT) AS chunk, string_agg(CAST(j AS VARCHAR) || ':' || CAST(v AS VARCHAR), ',' ORDER BY j) AS entries
FROM (SELECT *, (row_number() OVER (PARTITION BY i ORDER BY j) - 1) // {ROW_CHUNK} AS chunk FROM ({_A})) GROUP BY i, chunk
""",
    "matmul_written": f"""
SELECT row_number() OVER (ORDER BY i, j) - 1 AS line_no, CAST(i AS VARCHAR) || ',' || CAST(j AS VARCHAR) || ',' || CAST(v AS VARCHAR) AS value FROM ({_C})
""",
}
