"""QR of tall matrices by a tree of local factors, for pseudo-inverses that Gram matrices cannot give.

A tall matrix is a cell table ``(i, j, v)`` with any number of rows and at most some thousand columns. Every
partition of its rows folds them, block by block, into one triangular factor; factors are merged ``FAN_IN`` at a time, each round
stored, until one is left, which is all the driver sees. A Gram matrix squares the condition number and so loses
singular values under 1e-8 of the largest; a triangular factor keeps them down to about 1e-15.

``orthonormal_basis`` does it twice: rows times the inverse of the first factor are orthonormal up to the condition
number times rounding, and the factor of those rows takes the rest out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import materialize

FAN_IN = 8
# Numbers of one dense block of rows in a task (32 MB).
BLOCK_NUMBERS = 4_000_000
# Singular values below this share of the largest count as zero (sampled columns may repeat).
RCOND = 1e-12


class Basis(NamedTuple):
    """Tall matrix = Q x ``coords``, with Q = ``rows`` x inverse of ``fix``; ``rows`` are cells ``(i, j, v)``."""

    rows: DataFrame
    fix: np.ndarray
    coords: np.ndarray


def _triangle(m: np.ndarray) -> np.ndarray:
    """Triangular factor with a non-negative diagonal."""
    r = np.linalg.qr(m, mode="r")
    return r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]


def _blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Batches ``(i, cells)`` as dense blocks of bounded size with their row ids."""
    step = max(1, BLOCK_NUMBERS // max(n, 1))
    for b in batches:
        for lo in range(0, b.num_rows, step):
            part = b.slice(lo, step)
            cells = part.column(1)
            dense = np.zeros((part.num_rows, n))
            flat = cells.flatten()
            at = np.repeat(np.arange(part.num_rows), np.diff(cells.offsets.to_numpy()))
            dense[at, flat.field("j").to_numpy()] = flat.field("v").to_numpy()
            yield part.column(0), dense


def _cell_rows(cells: DataFrame) -> DataFrame:
    """``(i, cells)``: one row of the tall matrix, bounded by its number of columns."""
    return cells.groupBy("i").agg(F.collect_list(F.struct("j", "v")).alias("cells"))


def _factor(rows: DataFrame, n: int) -> np.ndarray:
    """The n x n triangular factor of ``(i, cells)`` rows."""

    def fold(batches):
        r = np.zeros((0, n))
        for _, dense in _blocks(batches, n):
            r = _triangle(np.vstack([r, dense]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], ["r"])

    def merge(key, group):
        stacked = np.vstack([np.frombuffer(x, np.float64).reshape(-1, n) for x in group["r"]])
        group = group.head(1).copy()
        group["no"], group["r"] = key[0], [np.ascontiguousarray(_triangle(stacked)).tobytes()]
        return group[["no", "r"]]

    local = rows.mapInArrow(fold, "r binary").withColumn("no", F.spark_partition_id().cast("bigint")).select("no", "r")
    local = materialize(local, "factors")
    last = local.agg(F.max("no")).first()[0]
    while last is not None and last > 0:
        up = F.floor(F.col("no") / FAN_IN).cast("bigint").alias("up")
        local = materialize(local.groupBy(up).applyInPandas(merge, "no bigint, r binary"), "factors")
        last //= FAN_IN
    one = local.select("r").first()
    r = np.frombuffer(one["r"], np.float64).reshape(-1, n) if one else np.zeros((0, n))
    return np.vstack([r, np.zeros((max(0, n - len(r)), n))])


def triangular_factor(cells: DataFrame, n: int) -> np.ndarray:
    """R of the QR factorisation of the tall matrix ``(i, j, v)`` with n columns; its diagonal is not negative."""
    return _factor(_cell_rows(cells), n)


def orthonormal_basis(cells: DataFrame, n: int, rcond: float = RCOND) -> Basis:
    """An orthonormal basis of the column space of ``(i, j, v)`` and the matrix's coordinates in it."""
    rows = materialize(_cell_rows(cells), "rows")
    _, s, vt = np.linalg.svd(_factor(rows, n))
    keep = s > rcond * s[0] if n and s[0] > 0 else np.zeros(n, bool)
    s, vt = s[keep], vt[keep]
    turn, rank = vt.T / s, int(keep.sum())

    def turned(batches):
        for ids, dense in _blocks(batches, n):
            flat = (dense @ turn).ravel()
            offsets = pa.array(np.arange(0, flat.size + 1, rank) if rank else np.zeros(len(dense) + 1), pa.int32())
            pair = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(rank), len(dense)), pa.int64()), pa.array(flat)], ["j", "v"])
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, pair)], ["i", "cells"])

    q = materialize(rows.mapInArrow(turned, "i bigint, cells array<struct<j bigint, v double>>"), "basis")
    fix = _factor(q, rank) if rank else np.zeros((0, 0))
    cells_of = q.select("i", F.explode("cells").alias("c")).select("i", "c.j", "c.v")
    return Basis(cells_of, fix, fix @ (s[:, None] * vt))


def small_pinv(m: np.ndarray, k: int | None = None, rcond: float = RCOND) -> np.ndarray:
    """Pseudo-inverse of a small matrix from its ``k`` largest singular values (all for None or k <= 0)."""
    if not m.size:
        return np.zeros(m.shape[::-1])
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    keep = s > rcond * s[0]
    if k is not None and k > 0:
        keep[k:] = False
    return (vt[keep].T / s[keep]) @ u[:, keep].T
