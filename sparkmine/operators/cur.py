"""CUR matrix decomposition on a coordinate table ``A (i, j, v)``.

  C = A[:, sampled columns],  R = A[sampled rows, :],  U = C+ A R+
with rows/columns drawn with replacement, probability proportional to their
energy (sum of squares). Everything that grows with A runs as Spark jobs:
energies are grouped sums, the inverse-CDF draw is a bucketed range join,
C and R are joins with the sample list, and both get an orthonormal basis by a tree of
local QR factors (``tall_qr``): C = Qc Bc and R^T = Qr Br. A, the samples, C and R are stored once. Only the sample-sized
Bc, Br and M = Qc^T A Qr reach the driver, where numpy forms the rank-k pseudo-inverses:
  U = Bc+ M (Br+)^T
and the error  ||A - CUR||^2 = ||A||^2 - ||Bc U Br^T||^2, as CUR is a projection of A.

Energies are summed in fixed point (``ENERGY_UNITS`` for the largest v^2) as
decimals, so cumulative sums are exact, do not depend on partitioning and can
neither saturate nor vanish with the scale of the matrix.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.operators.matrix import matmul
from sparkmine.operators.ranks import prefix_sums
from sparkmine.operators.tall_qr import orthonormal_basis, small_pinv
from sparkmine.session import materialize

ENERGY_UNITS = 1_000_000_000_000_000
# Sample sizes are bounded: the c x c and r x r factors and the c x r product go to the driver.
MAX_SAMPLES = 2_000
# Fixed draws for reproducible samples: u_d = frac(d * GOLDEN), d = 1..s.
GOLDEN = 0.6180339887


def array_rows_to_coo(df: DataFrame, id_col: str, array_col: str) -> DataFrame:
    """Rows of ``array<float|double>`` -> ``(i, j, v double)`` (``j`` = array position)."""
    return df.select(F.col(id_col).cast("bigint").alias("i"), F.posexplode(array_col).alias("j", "v")).select(
        "i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v")
    )


def energies(a: DataFrame, axis: str) -> DataFrame:
    """``(idx, e)``: fixed-point sum of squares per row (``axis='i'``) or column (``'j'``),
    in units of the largest square / ``ENERGY_UNITS`` (one number on the driver)."""
    largest = a.agg(F.max(F.abs("v"))).first()[0]
    if largest is not None and not (0.0 < largest < math.inf):
        raise ValueError("the matrix has no finite energy: all cells are zero, or one is not finite")
    share = F.col("v") / F.lit(largest)
    units = F.floor(share * share * F.lit(float(ENERGY_UNITS))).cast("decimal(38,0)")
    return a.groupBy(F.col(axis).alias("idx")).agg(F.sum(units).cast("decimal(38,0)").alias("e"))


def probabilities(a: DataFrame, axis: str) -> DataFrame:
    """``(idx, p, p_lo, p_hi)``: sampling probability and its cumulative interval in index order."""
    ps = prefix_sums(energies(a, axis), "idx", "e")
    tot = F.col("total").cast("double")
    return ps.select(
        "idx",
        (F.col("e").cast("double") / tot).alias("p"),
        ((F.col("cum_hi") - F.col("e")).cast("double") / tot).alias("p_lo"),
        (F.col("cum_hi").cast("double") / tot).alias("p_hi"),
    )


def fixed_draws(spark, s: int) -> DataFrame:
    """``(draw, u)`` with ``u = frac(draw * GOLDEN)`` for draw = 1..s (reproducible)."""
    x = F.col("id").cast("double") * F.lit(GOLDEN)
    return spark.range(1, s + 1).select(F.col("id").cast("int").alias("draw"), (x - F.floor(x)).alias("u"))


def random_draws(spark, s: int, seed: int) -> DataFrame:
    return spark.range(1, s + 1, numPartitions=1).select(F.col("id").cast("int").alias("draw"), F.rand(seed).alias("u"))


def sample_indices(a: DataFrame, axis: str, draws: DataFrame) -> DataFrame:
    """``(draw, idx, pos)``: for each draw the first index whose cumulative
    probability reaches ``u``; ``pos`` numbers the draws in index order (repeats kept).

    Range join split by bucket: every bucket of the cumulative table covers a
    contiguous probability range, draws (a bounded list) are matched to buckets
    first, then to rows of their bucket only.
    """
    ps = prefix_sums(energies(a, axis), "idx", "e", keep_bucket=True)
    tot = F.col("total").cast("double")
    iv = ps.select(
        "idx", "_bucket",
        ((F.col("cum_hi") - F.col("e")).cast("double") / tot).alias("p_lo"),
        (F.col("cum_hi").cast("double") / tot).alias("p_hi"),
    )
    brange = iv.groupBy("_bucket").agg(F.min("p_lo").alias("b_lo"), F.max("p_hi").alias("b_hi"))
    d = F.broadcast(draws.select("draw", "u"))  # bounded by the sample size
    db = d.join(F.broadcast(brange), (F.col("u") >= F.col("b_lo")) & (F.col("u") <= F.col("b_hi"))).select("draw", "u", "_bucket")
    hit = iv.join(F.broadcast(db), "_bucket").where((F.col("u") >= F.col("p_lo")) & (F.col("u") <= F.col("p_hi")))
    # Exact cumulative sums make the intervals contiguous from 0 to exactly 1,
    # so every u in [0, 1) hits; at a shared boundary the smaller index wins.
    first = hit.groupBy("draw").agg(F.min("idx").alias("idx"))
    return first.select("draw", "idx", (F.row_number().over(Window.orderBy("idx", "draw")) - 1).alias("pos"))


def select_columns(a: DataFrame, cols: DataFrame) -> DataFrame:
    """``C (i, p, v)``: column ``cols.idx`` of A as column ``cols.pos`` (scale sqrt(1) = 1)."""
    # stored, so that its size is known and Spark broadcasts it only if it is small
    s = materialize(cols.select(F.col("idx").alias("j"), F.col("pos").cast("bigint").alias("p")), "sample")
    return a.where(F.col("v") != 0).join(s, "j").select("i", F.col("p").alias("j"), "v")


def select_rows(a: DataFrame, rows: DataFrame) -> DataFrame:
    """``R (p, j, v)``: row ``rows.idx`` of A as row ``rows.pos``."""
    s = materialize(rows.select(F.col("idx").alias("i"), F.col("pos").cast("bigint").alias("p")), "sample")
    return a.where(F.col("v") != 0).join(s, "i").select(F.col("p").alias("i"), "j", "v")


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def _dense(cells: DataFrame, n: int, m: int) -> np.ndarray:
    out = np.zeros((n, m))
    for r in cells.collect():  # bounded: n, m <= MAX_SAMPLES
        out[int(r["i"]), int(r["j"])] = r["v"]
    return out


def sampled_products(a: DataFrame, c: DataFrame, r: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``C^T C``, ``R R^T`` and ``C^T A R^T`` as cell tables."""
    return matmul(transpose(c), c), matmul(r, transpose(r)), matmul(matmul(transpose(c), a), transpose(r))


def cur(a: DataFrame, rrank: int, crank: int, k: int = -1, draws_rows: DataFrame | None = None,
        draws_cols: DataFrame | None = None, seed: int = 0) -> dict:
    """Factorize ``A (i, j, v)``. Returns frames ``C``, ``R``, ``U``, the samples and the error."""
    if not (0 < rrank <= MAX_SAMPLES and 0 < crank <= MAX_SAMPLES):
        raise ValueError(f"rrank and crank must be in 1..{MAX_SAMPLES}")
    spark = a.sparkSession
    a = materialize(a.groupBy("i", "j").agg(F.sum("v").alias("v")).where(F.col("v") != 0), "matrix")
    rows = materialize(sample_indices(a, "i", draws_rows if draws_rows is not None else random_draws(spark, rrank, seed)), "sample")
    cols = materialize(sample_indices(a, "j", draws_cols if draws_cols is not None else random_draws(spark, crank, seed + 1)), "sample")
    c, r = materialize(select_columns(a, cols), "columns"), materialize(select_rows(a, rows), "rows")
    left, right = orthonormal_basis(c, crank), orthonormal_basis(transpose(r), rrank)
    n_c, n_r = len(left.fix), len(right.fix)
    # rows of both bases are distinct cells; what their factors correct is taken out of the small product
    met = matmul(matmul(transpose(left.rows), a, sum_duplicates=False), right.rows, sum_duplicates=False)
    m = _dense(met, n_c, n_r)
    m = np.linalg.solve(left.fix.T, m) if n_c else m
    m = np.linalg.solve(right.fix.T, m.T).T if n_r else m
    pc, pr = small_pinv(left.coords, k), small_pinv(right.coords, k)
    u = pc @ m @ pr.T
    norm2 = float(a.agg(F.sum(F.col("v") * F.col("v"))).first()[0] or 0.0)
    err2 = norm2 - float(np.sum((left.coords @ u @ right.coords.T) ** 2))
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType()), T.StructField("v", T.DoubleType())])
    u_df = spark.createDataFrame([(int(x), int(y), float(u[x, y])) for x in range(crank) for y in range(rrank)], schema)
    return {"C": c, "R": r, "U": u_df, "rows": rows, "cols": cols, "error": math.sqrt(max(err2, 0.0)), "norm": math.sqrt(norm2)}
