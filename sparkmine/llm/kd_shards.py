"""Sharding by a k-d tree over document metadata, with equal bytes in every leaf.

Each node holds a number of shards. It is split along its widest dimension (largest minus
least coordinate, each dimension scaled to the same number of cells) at the weighted quantile
that gives either side bytes in proportion to its shards, until every leaf is one shard. A
text has one coordinate in each dimension, the least of its rows'. The order along a dimension is
the coordinate, then a hash of the text, then a hash of the id, so a cut can fall inside a value
that very many rows share, and equal texts lie side by side in every dimension.

The quantile is found in digits of that order: for all nodes of a level at once, one
distributed sum of bytes by (node, digit) tells in which cell the cut lies, and the next
sum looks into that cell only. A cut that may fall between texts without missing its target by
more than ``TOLERANCE`` of a shard does so; larger groups of equal texts are cut by id, at most
one by a cut (unlike texts with equal coordinate and equal 24-bit hash count as one group).

Defined results: null text is the empty text (size 16); null metadata has coordinate 0; rows
that repeat id and text stay together; slots go by id hash, id, checksum and size; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import local_table, partitions, saved

SHARDS = 40
ROW_BYTES = 16
DIGIT, DIGITS = 12, 5  # the order: 12 bits of coordinate, 24 of text hash, 24 of id hash
TEXT_DIGITS = 3
CELLS = 1 << DIGIT
TOLERANCE = 0.005
SLOT_CELLS = 256


@dataclass
class Node:
    """A node of the tree; ``first`` is its first shard."""

    number: int
    first: int
    shards: int
    dim: int = 0
    target: int = 0  # bytes that go left
    prefix: int = 0  # leading digits of the cut
    below: int = 0  # bytes of rows before that prefix
    cut: int | None = None  # rows whose order is below go left


def _table(spark, nodes: list[Node], *fields: str) -> DataFrame:
    """One row for each node; never more than there are shards."""
    return F.broadcast(local_table(spark, {f: pa.array([getattr(n, f) for n in nodes], pa.int64()) for f in ("number", *fields)}))


def _ordered(rows: DataFrame, nodes: DataFrame, dims: int) -> DataFrame:
    """Rows of these nodes with their place in the order of the node's dimension."""
    own = F.element_at(F.array(*(F.col(f"c{d}") for d in range(dims))), F.col("dim").cast("int") + 1)
    joined = rows.join(nodes, F.col("node") == F.col("number"))
    return joined.withColumn("order", F.shiftleft(own.cast("long"), DIGIT * (DIGITS - 1)) + F.col("tie"))


def scaled(docs: DataFrame, dims: dict[str, Column]) -> list[Column]:
    """Each numeric dimension scaled to whole numbers from 0 to CELLS - 1, other ones by a checksum."""
    kinds = dict(docs.select(*(c.alias(n) for n, c in dims.items())).dtypes)
    numeric = [n for n in dims if kinds[n] not in ("string", "boolean", "date", "timestamp", "binary")]
    ends = docs.select(*(c.cast("double").alias(n) for n, c in dims.items() if n in numeric)).agg(
        F.lit(0), *(f(F.when(~F.isnan(n), F.col(n))).alias(f"{n}_{p}") for n in numeric for f, p in ((F.min, "lo"), (F.max, "hi")))
    ).first()
    out = []
    for n, c in dims.items():
        if n in numeric:
            lo, hi = ends[f"{n}_lo"], ends[f"{n}_hi"]
            cell = F.floor((c.cast("double") - F.lit(lo)) / F.lit(hi - lo) * (CELLS - 1)) if lo is not None and hi > lo else F.lit(0)
            out.append(F.coalesce(F.when(~F.isnan(c.cast("double")), cell), F.lit(0)).cast("int"))
        else:
            out.append(F.coalesce(F.crc32(c.cast("string")) % CELLS, F.lit(0)).cast("int"))
    return out


def _by_text(rows: DataFrame, dims: int, parts: int) -> DataFrame:
    """The rows with each coordinate the least among the rows of equal ``key``.

    Keys with very many rows, fewer than 4 x ``parts``, are broadcast, so none meets in one task.
    """
    own = [f"c{d}" for d in range(dims)]
    least = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(f"least_{c}") for c in own)), "least")
    many = least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // (4 * parts)
    hot = F.broadcast(least.filter(F.col("n") > many).drop("n"))
    few = least.filter((F.col("n") > 1) & (F.col("n") <= many)).drop("n")
    kept = [c for c in rows.columns if c != "key" and c not in own]
    placed = [F.coalesce(f"least_{c}", c).alias(c) for c in own]
    among_many = rows.join(hot, "key").select(*kept, *placed)
    return among_many.union(rows.join(hot, "key", "left_anti").join(few, "key", "left").select(*kept, *placed))


def _find_cuts(rows: DataFrame, nodes: list[Node], dims: int, near: float) -> None:
    """Set dimension and cut of all nodes of a level."""
    spark = rows.sparkSession
    by_number = {n.number: n for n in nodes}
    spread = rows.join(_table(spark, nodes), F.col("node") == F.col("number")).groupBy("node").agg(
        F.sum("size").alias("bytes"), *(f(f"c{d}").alias(f"{p}{d}") for d in range(dims) for f, p in ((F.min, "lo"), (F.max, "hi")))
    )
    for r in spread.collect():
        n = by_number[r["node"]]
        n.dim = max(range(dims), key=lambda d: (r[f"hi{d}"] - r[f"lo{d}"], -d))
        n.target = r["bytes"] * (n.shards // 2) // n.shards
    for step in range(DIGITS):
        seeking = [n for n in nodes if n.cut is None]
        if not seeking:
            break
        shift = DIGIT * (DIGITS - 1 - step)
        inside = _ordered(rows, _table(spark, seeking, "dim", "prefix"), dims).filter(F.shiftright("order", shift + DIGIT) == F.col("prefix"))
        digit = F.shiftright("order", shift).bitwiseAND(F.lit(CELLS - 1))
        cells: dict[int, list] = {n.number: [] for n in seeking}
        for r in inside.groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("bytes")).collect():  # at most CELLS for each node
            cells[r["node"]].append((r["digit"], r["bytes"]))
        for n in seeking:
            at, here = -1, 0
            for at, here in sorted(cells[n.number]):
                if n.below + here > n.target:
                    break
                n.below += here
            else:
                at, here = at + 1, 0
            n.prefix = (n.prefix << DIGIT) + at
            under, over = n.target - n.below, n.below + here - n.target
            if (step >= TEXT_DIGITS - 1 and min(under, over) <= near) or step == DIGITS - 1 or here == 0:
                n.cut = (n.prefix + (over < under)) << shift


def kd_shards(
    docs: DataFrame, dims: dict[str, Column], id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    half = 1 << (DIGIT * 2)
    tie = (F.xxhash64(text).bitwiseAND(F.lit(half - 1)) * F.lit(half)) + F.xxhash64(F.lit(1), F.col(id_col)).bitwiseAND(F.lit(half - 1))
    rows = saved(
        docs.select(
            F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text).alias("crc"),
            tie.alias("tie"), F.xxhash64(text).alias("key"), *(c.alias(f"c{i}") for i, c in enumerate(scaled(docs, dims))),
        ),
        "metadata",
    )
    rows = saved(_by_text(rows, len(dims), partitions(docs)), "placed")
    total = rows.agg(F.sum("size")).first()[0] or 0
    spark = docs.sparkSession
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    leaves, level = [], [Node(0, 0, shards)]
    while level:
        leaves += [n for n in level if n.shards == 1]
        level = [n for n in level if n.shards > 1]
        if not level:
            break
        _find_cuts(rows, level, len(dims), TOLERANCE * total / shards)
        side = F.when(F.col("cut").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(F.col("order") < F.col("cut"), 1).otherwise(2))
        moved = _ordered(rows, _table(spark, leaves + level, "dim", "cut"), len(dims)).withColumn("node", side)
        rows = saved(moved.select(*rows.columns), "nodes")
        level = [
            c for n in level
            for c in (Node(2 * n.number + 1, n.first, n.shards // 2), Node(2 * n.number + 2, n.first + n.shards // 2, n.shards - n.shards // 2))
        ]
    sharded = rows.join(_table(spark, leaves, "first"), F.col("node") == F.col("number")).withColumn("shard", F.col("first").cast("int"))
    sharded = sharded.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(SLOT_CELLS)).cast("int"))
    # slots: rank inside (shard, cell) after the rows of the shard's earlier cells
    cells = sharded.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = cells.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")).drop("n")  # shards x SLOT_CELLS rows
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("id", "crc", "size")) - 1
    return sharded.withColumn("rank", rank).join(F.broadcast(before), ["shard", "cell"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("rank") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
