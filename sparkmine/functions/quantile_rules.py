"""Rank rules for exact quantiles as column expressions.

Type 2 (averaged steps, Hyndman & Fan 1996): with ``k = p * n`` (exact decimal
arithmetic), an integer ``k`` averages the order statistics of ranks ``k`` and
``k + 1``, otherwise both ranks are ``ceil(k)``. Ranks are 1-based and clamped
to ``[1, n]``.

``legacy`` reproduces the original job: the same ranks used as 0-based
indexes (so one rank higher), integer average, and no value (null) when an
index falls past the end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _k(p: float, n: Column) -> Column:
    return F.lit(Decimal(str(p))).cast("decimal(20,18)") * n.cast("decimal(20,0)")


def rank_pair(p: float, n: Column, legacy: bool = False) -> tuple[Column, Column]:
    k = _k(p, n)
    whole = k == F.floor(k)
    lo = F.when(whole, k).otherwise(F.ceil(k)).cast("bigint")
    hi = F.when(whole, k + 1).otherwise(F.ceil(k)).cast("bigint")
    if legacy:
        return lo + 1, hi + 1
    return F.greatest(F.least(lo, n), F.lit(1)), F.greatest(F.least(hi, n), F.lit(1))


def average(lo: Column, hi: Column, legacy: bool = False) -> Column:
    if legacy:
        # integer halves truncated toward zero, exact for all of bigint
        both = lo.cast("decimal(20,0)") + hi.cast("decimal(20,0)")
        return ((both - both % 2) / 2).cast("bigint")
    return (lo.cast("double") + hi.cast("double")) / 2
