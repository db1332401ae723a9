"""Order statistics by histogram refinement: the value of a given rank, in every group, for any ordered type.

A value's key is cut into digits that keep the order (16 bits of a 64-bit key, two bytes of a text). The first pass
counts rows by group and first digit; the counts tell which cell holds a wanted rank, and only rows of such
cells are read on, collapsed to different values with their numbers. Each round cuts the cells by the next digit until
every cell has at most ``FEW`` different values, which are then put in order. Running sums go over the digits of one cell or
over so few values, never over a group's values, so neither a hot group nor a narrow range of values lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.session import materialize

DIGIT_BITS = 16
FEW = 4096  # different values of a cell that are put in order at once
_SIGN = -(1 << 63)


def double_key(x: Column) -> Column:
    """A long in the order of doubles: the bits of the number, by exact steps of powers of two (NaN last, both zeros equal)."""
    x = x.cast("double")
    a = F.abs(x)
    small = a < F.lit(2.0**-1022)
    guess = F.least(F.greatest(F.floor(F.log2(a)), F.lit(-1022)), F.lit(1023)).cast("int")
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    e = F.when(power(guess) > a, guess - 1).when((guess < 1023) & (power(guess + 1) <= a), guess + 1).otherwise(guess)
    # mantissa in [1, 2); dividing by a power of two is exact
    mantissa = ((a / power(e) - 1.0) * F.lit(2.0**52)).cast("bigint")
    bits = F.when(a == 0, F.lit(0).cast("bigint")).when(small, (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint"))
    bits = bits.when(a == F.lit(float("inf")), F.lit(2047 << 52)).otherwise((e.cast("bigint") + 1023) * F.lit(1 << 52) + mantissa)
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -bits).otherwise(bits)


def rough_digit(x: Column) -> Column:
    """A whole number that never falls as a double rises: its sign and logarithm. Cheap, for the pass over all rows."""
    x = x.cast("double")
    a = F.abs(x)
    size = F.when(a == 0, F.lit(0)).when(a == F.lit(float("inf")), F.lit(1 << 20)).otherwise(F.floor(F.log2(a) * 32).cast("int") + (1 << 17))
    return F.when(F.isnan(x), F.lit(1 << 21)).when(x < 0, -size).otherwise(size)


def key_words(x: Column, kind: T.DataType) -> list[Column] | None:
    """Longs that, compared one after the other, order values of a type; None for texts, which are read byte by byte."""
    if isinstance(kind, T.StringType):
        return None
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return [x.cast("bigint")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(x).cast("bigint")]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [F.unix_micros(x.cast("timestamp"))]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [double_key(x)]
    if isinstance(kind, T.DecimalType):
        s = kind.scale
        if kind.precision <= 18:
            return [(x * F.lit(10**s).cast(f"decimal({s + 1},0)")).cast("bigint")]
        if kind.precision - s <= 18 and s <= 17:
            part = (x - F.floor(x)).cast(f"decimal({s + 1},{s})")
            return [F.floor(x).cast("bigint"), (part * F.lit(10**s).cast(f"decimal({s + 1},0)")).cast("bigint")]
    raise ValueError(f"no order-preserving key for {kind.simpleString()}")


def text_digit(x: Column, level: int) -> Column:
    """Two bytes of a text, one more than each; 0 past its end."""
    h = F.hex(F.substring(x.cast("binary"), 2 * level + 1, 2))
    byte = lambda i: F.coalesce(F.conv(F.nullif(F.substring(h, i, 2), F.lit("")), 16, 10).cast("int") + 1, F.lit(0))
    return byte(1) * 257 + byte(3)


def _number_digits(rows: DataFrame, words: list[Column]) -> list[Column]:
    """The digits of all words from the first bit in which the rows differ."""
    edges = rows.agg(*(f(w).alias(f"{n}{i}") for i, w in enumerate(words) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    out = []
    for i, w in enumerate(words):
        lo, hi = edges[f"lo{i}"], edges[f"hi{i}"]
        bits = 0 if lo is None else ((lo + (1 << 63)) ^ (hi + (1 << 63))).bit_length()
        flipped = w.bitwiseXOR(F.lit(_SIGN))
        while bits > 0:
            shift = max(0, bits - DIGIT_BITS)
            out.append(F.shiftrightunsigned(flipped, shift).bitwiseAND(F.lit((1 << (bits - shift)) - 1)).cast("int"))
            bits = shift
    return out or [F.lit(0)]


def kth_values(df: DataFrame, col: str, wanted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``by..., rank, value``: for each row ``(by..., rank)`` of ``wanted`` the value of that rank (from 1) in its group.

    Null values are ignored; a rank outside 1..n gives no row; null groups are groups like others.
    """
    by = list(by or [])
    kind = df.schema[col].dataType
    group = F.struct(F.lit(0).alias("_all"), *by).alias("_g")
    x = F.col("_x")
    words = key_words(x, kind)
    rows = df.where(F.col(col).isNotNull()).select(group, F.col(col).alias("_x"))
    rough = isinstance(kind, (T.FloatType, T.DoubleType))
    digits = [rough_digit(x)] if rough else None if words is None else _number_digits(rows, words)
    active = wanted.select(group, F.lit("").alias("_cell"), F.col("rank").cast("bigint").alias("rank"), F.col("rank").cast("bigint").alias("_r")).distinct()
    rows = rows.withColumn("_cell", F.lit("")).withColumn("_n", F.lit(1).cast("bigint"))
    level = 0
    while digits is None or level < len(digits):
        digit = text_digit(x, level) if digits is None else digits[level]
        cut = rows.withColumn("_d", digit)
        counts = cut.groupBy("_g", "_cell", "_d").agg(F.sum("_n").alias("_c"))
        to = F.sum("_c").over(Window.partitionBy("_g", "_cell").orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cells = counts.withColumn("_to", to)
        held = active.join(cells, ["_g", "_cell"]).where((F.col("_r") <= F.col("_to")) & (F.col("_r") > F.col("_to") - F.col("_c")))
        held = materialize(held.select("_g", "_cell", "_d", "rank", (F.col("_r") - F.col("_to") + F.col("_c")).alias("_r")), "held")
        path = F.concat_ws(".", "_cell", F.col("_d").cast("string"))
        kept = cut.join(held.select("_g", "_cell", "_d").distinct(), ["_g", "_cell", "_d"], "left_semi").withColumn("_cell", path).drop("_d")
        rows = materialize(kept.groupBy("_g", "_cell", "_x").agg(F.sum("_n").alias("_n")), "cells")
        active = held.withColumn("_cell", path).drop("_d")
        level += 1
        most = rows.groupBy("_g", "_cell").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= FEW:
            break
        if rough and level == 1:
            digits = [*digits, *_number_digits(rows, words)]
    inside = Window.partitionBy("_g", "_cell").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = rows.withColumn("_to", F.sum("_n").over(inside)).withColumnRenamed("_x", "value")
    found = active.join(values, ["_g", "_cell"]).where((F.col("_r") <= F.col("_to")) & (F.col("_r") > F.col("_to") - F.col("_n")))
    return found.select(*(F.col(f"_g.{c}").alias(c) for c in by), "rank", "value")
