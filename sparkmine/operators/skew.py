"""Hot-key detection and tiled equi-joins.

The work of a key in a join is the product of its rows on both sides. A key whose
product is large (a hub user, a dense inner index, a common token, a full bucket)
would put that work into one task. ``hot_keys`` finds such keys from the counts of
both sides; ``salted_join`` cuts the rows of either side into tiles: every left row
gets one left tile and is repeated for each right tile, every right row the other way
round, so each left/right pair meets exactly once, in the task of its two tiles, and
results are unchanged.

Everything is lazy. The key table is joined like any other table: Spark broadcasts it if
it is small and shuffles otherwise, so no key is left whole for the table's sake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pairs that one task may form for one key.
PAIRS_PER_TILE = 10_000_000
# Rows of one side in one tile; also splits a key that is hot on one side only.
ROWS_PER_TILE = 100_000


def hot_keys(
    left: DataFrame,
    keys: list[str],
    right: DataFrame | None = None,
    pairs_per_tile: int | None = None,
    rows_per_tile: int | None = None,
) -> DataFrame:
    """Lazy table ``keys + [n_left, n_right]``: the tiles of every key that needs more than one.

    Without ``right`` the join is of ``left`` with itself on ``keys``. Defaults come from
    the module settings at call time, so a session can tune them.
    """
    pairs = PAIRS_PER_TILE if pairs_per_tile is None else pairs_per_tile
    rows = ROWS_PER_TILE if rows_per_tile is None else rows_per_tile
    side = int(max(1, min(rows, pairs**0.5)))
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    if right is None:
        counts = counts.withColumn("_nr", F.col("_nl"))
    else:
        counts = counts.join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr")), keys)
    # a side shorter than a square tile's edge leaves the other one more rows
    per_left = F.least(F.lit(rows), F.greatest(F.lit(side), F.floor(F.lit(pairs) / F.col("_nr"))))
    per_right = F.least(F.lit(rows), F.greatest(F.lit(side), F.floor(F.lit(pairs) / F.col("_nl"))))
    tiles = counts.select(
        *keys, F.ceil(F.col("_nl") / per_left).cast("int").alias("n_left"), F.ceil(F.col("_nr") / per_right).cast("int").alias("n_right")
    )
    return tiles.where((F.col("n_left") > 1) | (F.col("n_right") > 1))


def _tile(df: DataFrame, n: F.Column) -> F.Column:
    """Tile of a row by the hash of all its columns (a recomputed task tiles its rows the same way)."""
    return F.pmod(F.xxhash64(*df.columns), n).cast("int")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """Inner equi-join on ``keys`` that spreads the hot keys' pairs over tiles."""
    if hot is None:
        return left.join(right, keys)
    nl, nr = F.coalesce("n_left", F.lit(1)), F.coalesce("n_right", F.lit(1))
    lft = left.join(hot, keys, "left").select(*left.columns, _tile(left, nl).alias("_tl"), F.explode(F.sequence(F.lit(0), nr - 1)).alias("_tr"))
    rgt = right.join(hot, keys, "left").select(*right.columns, F.explode(F.sequence(F.lit(0), nl - 1)).alias("_tl"), _tile(right, nr).alias("_tr"))
    return lft.join(rgt, [*keys, "_tl", "_tr"]).drop("_tl", "_tr")
