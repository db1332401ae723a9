"""Exact quantiles (type 2 or legacy), global or per group, and mergeable approximate states.

Plan of the exact ones: a count for each group gives the wanted ranks as column expressions; the values of
these ranks come from histogram refinement (``operators/selection.py``), which reads only the cells that hold a
rank again and never orders values in a window; a small aggregation averages the two ranks.

States are KLL sketches, one for each group and slice (a day, a file, a batch), stored as a table; states of
any slices can be merged later, without the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.quantile_rules import average, rank_pair
from sparkmine.operators.selection import kth_values
from sparkmine.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def _pname(p: float) -> str:
    s = f"{p * 100:.10g}".replace(".", "_")
    return f"p{s}"


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs=QUARTILES,
    by: list[str] | str | None = None,
    legacy: bool = False,
) -> DataFrame:
    """Wide result: ``by... , p25, p50, p75`` (one row per group, one for no group).

    Null values are ignored; an empty input gives no rows (no group).
    """
    by = [by] if isinstance(by, str) else list(by or [])
    keys = by or ["_g"]
    src = (df if by else df.withColumn("_g", F.lit(0))).where(F.col(col).isNotNull())
    pairs = []
    for idx, p in enumerate(probs):
        for which, rank in enumerate(rank_pair(p, F.col("_n"), legacy)):
            pairs.append(F.struct(F.lit(idx).alias("pi"), F.lit(which).alias("which"), rank.alias("rank")))
    counts = materialize(src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "counts")
    wanted = counts.select(*keys, F.explode(F.array(*pairs)).alias("w")).select(*keys, "w.*")
    found = kth_values(src, col, wanted.select(*keys, "rank"), keys)
    same = wanted["rank"] == found["rank"]
    for k in keys:  # null-safe: a null group is a group like any other
        same = same & wanted[k].eqNullSafe(found[k])
    hits = wanted.join(found, same, "left").select(*(wanted[k] for k in keys), "pi", "which", "value")
    aggs = []
    for idx, p in enumerate(probs):
        a = F.max(F.when((F.col("pi") == idx) & (F.col("which") == 0), F.col("value")))
        b = F.max(F.when((F.col("pi") == idx) & (F.col("which") == 1), F.col("value")))
        aggs.append(average(a, b, legacy).alias(_pname(p)))
    out = hits.groupBy(*keys).agg(*aggs)
    return out.drop("_g") if not by else out


def approx_quantiles(df: DataFrame, col: str, probs=QUARTILES, by=None, accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles (``percentile_approx``), named as such."""
    by = [by] if isinstance(by, str) else list(by or [])
    aggs = [F.percentile_approx(col, p, accuracy).alias(_pname(p)) for p in probs]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# Size parameter of a state; the rank error of a query on it, and on merged states, is below RANK_ERROR of n with 99 % confidence.
STATE_K, RANK_ERROR = 400, 0.0075


def quantile_states(df: DataFrame, col: str, slices: list[str], by: list[str] | None = None, k: int = STATE_K) -> DataFrame:
    """``by..., slices..., state``: a mergeable sketch of a numeric column for each group and slice; to be stored."""
    return df.where(F.col(col).isNotNull()).groupBy(*(by or []), *slices).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("state"))


def merged_quantiles(states: DataFrame, probs=QUARTILES, by: list[str] | None = None, k: int = STATE_K) -> DataFrame:
    """``by..., n, p25, ...`` from the states of all slices in ``states``; only states are read."""
    merged = F.kll_merge_agg_double("state", F.lit(k)).alias("state")
    one = states.groupBy(*by).agg(merged) if by else states.agg(merged)
    return one.select(*(by or []), F.kll_sketch_get_n_double("state").alias("n"), *(F.kll_sketch_get_quantile_double("state", F.lit(float(p))).alias(_pname(p)) for p in probs))
