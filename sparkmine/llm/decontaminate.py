"""Benchmark decontamination by SimHash of item-sized windows.

A window is as many words of a text as the benchmark item has (the whole text, if that is
shorter). Its fingerprint is the 64-bit SimHash of its word shingles, each counting as often as
it occurs. Of ``BLOCKS`` blocks of bits a fingerprint within ``RADIUS`` bits of an item's differs from it in at
most one bit in at least one, so an index that files each item under its blocks' values and under all
values one bit away finds all of them; the weighted shingle
similarity (sum of least over sum of largest counts) of window and item then decides.

A window without any shingle of an item has similarity zero, so windows are formed only around
words where some shingle of a same-sized item begins. All texts are hashed once for that, and only those that hold such
a shingle leave the task. All is DataFrame functions: counts
of the 64 bits are summed side by side in the lanes of whole numbers.

Defined results: items and texts that are null or have no word match nothing; items of fewer
than five words are one shingle of all their words; rows that repeat an id are
judged on their own and their findings joined under the id; ties between windows go to
the earliest; empty tables give no rows. At similarity exactly 0.8 the expected distance of
fingerprints is 9.7 bits with a standard error of 2.9, so the radius misses one window in 200 there, fewer above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.llm.common import SHINGLE_WORDS, SIMILARITY, saved

RADIUS, BLOCKS = 17, 9  # fewer than two bits to a block
BITS = 64
MAX_BROADCAST = 200_000


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def shingle_array(hashes: Column, k: int) -> Column:
    """Hash of every run of ``k`` word hashes; empty for fewer words."""
    runs = F.transform(F.sequence(F.lit(0), F.array_size(hashes) - F.lit(k)), lambda i: F.xxhash64(*(F.get(hashes, i + F.lit(j)) for j in range(k))))
    return F.when(F.array_size(hashes) >= k, runs).otherwise(F.array().cast("array<long>"))


def word_hashes(text: Column) -> Column:
    return F.transform(word_array(text), lambda w: F.xxhash64(w))


def simhash(shingles: Column, most: int) -> Column:
    """SimHash of an array of at most ``most`` 64-bit hashes: bit i is set if more than half have it.

    Lanes of a whole number count several bits at once: lane j of the b-th number counts bit b + width * j.
    """
    width = next(w for w in (8, 16, 32) if most < 1 << (w - 2))
    ones = sum(1 << at for at in range(0, BITS, width))
    top = 1 << (width - 2)
    over = F.lit(top) - F.floor(F.array_size(shingles) / F.lit(2)) - F.lit(1)
    out = F.lit(0).cast("long")

    def counted(b: int) -> Column:
        return F.aggregate(shingles, F.lit(0).cast("long"), lambda acc, x: acc + F.shiftrightunsigned(x, b).bitwiseAND(F.lit(ones)))

    for b in range(width):
        lanes = counted(b)
        full = F.shiftrightunsigned((lanes + over * F.lit(ones)).bitwiseAND(F.lit(ones * top)), width - 2)
        out = out.bitwiseOR(F.shiftleft(full, b))
    return out


def block_widths(n: int) -> list[tuple[int, int]]:
    """First bit and width of ``n`` blocks of the bits."""
    cuts = [BITS * j // n for j in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def blocks(fingerprint: Column, n: int = BLOCKS, away: int = 0) -> Column:
    """(block, value) of ``n`` blocks of the bits; with ``away`` = 1 also all values that differ from a block's in one bit."""
    out = []
    for j, (lo, width) in enumerate(block_widths(n)):
        value = F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << width) - 1))
        flips = [0, *(1 << i for i in range(width))] if away else [0]
        out += [F.struct(F.lit(j).alias("block"), value.bitwiseXOR(F.lit(x).cast("long")).alias("value")) for x in flips]
    return F.array(*out)


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of least counts over sum of largest counts of two arrays of hashes."""
    common = F.array_intersect(a, b)
    single = (F.array_size(F.array_distinct(a)) == F.array_size(a)) | (F.array_size(F.array_distinct(b)) == F.array_size(b))
    count = lambda s, d: F.array_size(F.filter(s, lambda x: x == d))
    least = F.when(single, F.array_size(common)).otherwise(F.aggregate(common, F.lit(0), lambda acc, d: acc + F.least(count(a, d), count(b, d))))
    both = F.array_size(a) + F.array_size(b) - least
    return F.when(both > 0, least / both).otherwise(F.lit(0.0))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Tables made of the benchmark are broadcast while they are small; nothing made of the texts ever is."""
    return F.broadcast(df) if rows <= MAX_BROADCAST else df


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    threshold: float = SIMILARITY,
) -> DataFrame:
    """(id, item, start, words, similarity): for each text and item the most similar window at or over ``threshold``."""
    bench = items.select(F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("w")).filter(F.array_size("w") > 0)
    sizes = sorted(r[0] for r in bench.select(F.array_size("w").alias("m")).distinct().collect())
    found = [
        _contaminated(docs, bench.filter(F.array_size("w") >= k) if k == SHINGLE_WORDS else bench.filter(F.array_size("w") == k), k, max(m for m in sizes if min(m, SHINGLE_WORDS) == k), id_col, text_col, threshold)
        for k in sorted({min(m, SHINGLE_WORDS) for m in sizes})
    ]
    if not found:
        names = (docs.schema[id_col].dataType, items.schema[item_col].dataType, T.IntegerType(), T.IntegerType(), T.DoubleType())
        fields = zip((id_col, item_col, "start", "words", "similarity"), names, strict=True)
        return docs.sparkSession.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in fields]))
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    best = F.max_by(F.struct("start", "words", "similarity"), F.struct("similarity", -F.col("start")))
    return out.groupBy("id", "item").agg(best.alias("b")).select(F.col("id").alias(id_col), F.col("item").alias(item_col), "b.start", "b.words", "b.similarity")


def hashed(texts: DataFrame, k: int) -> DataFrame:
    return texts.withColumn("w", word_hashes(F.col("text"))).withColumn("s", shingle_array(F.col("w"), k)).select("id", "row", "s")


def marked_texts(own: DataFrame, marks: DataFrame, n_marks: int, k: int) -> DataFrame:
    """(id, row, s, places array<struct<m, pos>>): the texts with a shingle of ``marks`` (m, sh), their shingles, and where.

    While the marks are few, shingles meet them in the task that has hashed the text, and only texts with a
    mark leave it. A larger benchmark makes this join a shuffle of shingles; then ids of texts with a
    mark come back, and only these texts are hashed again.
    """
    # (the outer form: Spark would otherwise test the shingles' number below, computing them again and again)
    place = F.collect_set(F.struct("m", "pos")).alias("places")
    if n_marks <= MAX_BROADCAST:
        met = hashed(own, k).select("id", "row", "s", F.posexplode_outer("s").alias("pos", "sh")).join(F.broadcast(marks), "sh")
        return met.groupBy("id", "row").agg(F.first("s").alias("s"), place)
    met = hashed(own, k).select("id", "row", F.posexplode_outer("s").alias("pos", "sh")).join(marks, "sh")
    hits = saved(met.groupBy("id", "row").agg(place), "hits")
    same = own["id"].eqNullSafe(hits["id"]) & (own["row"] == hits["row"])
    texts = hashed(own.join(hits.select("id", "row"), same, "left_semi").dropDuplicates(["id", "row"]), k)
    return texts.join(hits, texts["id"].eqNullSafe(hits["id"]) & (texts["row"] == hits["row"])).select(texts["id"], texts["row"], "s", "places")


def _contaminated(docs, bench, k, longest, id_col, text_col, threshold) -> DataFrame:
    most = longest - k + 1
    bench = saved(
        bench.withColumn("s", shingle_array(F.col("w"), k)).select("item", F.array_size("w").alias("m"), "s", simhash(F.col("s"), most).alias("fp")), "items"
    )
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text"))

    # texts that hold a shingle of some item, and where, by the size of the item
    marks = bench.select("m", F.explode("s").alias("sh")).distinct()
    n_marks = marks.count()
    texts = saved(marked_texts(own, marks, n_marks, k), "texts")

    # windows around those places
    there = texts.withColumn("m", F.explode(F.array_distinct(F.transform("places", lambda p: p["m"]))))
    last = F.greatest(F.lit(0), F.array_size("s") + F.lit(k - 1) - F.col("m"))
    around = lambda p: F.sequence(F.greatest(F.lit(0), F.least(last, p["pos"] - F.col("m") + F.lit(k))), F.least(last, p["pos"]))
    starts = F.array_distinct(F.flatten(F.transform(F.filter("places", lambda p: p["m"] == F.col("m")), around)))
    window = F.slice("s", F.col("start") + F.lit(1), F.col("m") - F.lit(k - 1))
    windows = saved(
        there.withColumn("start", F.explode_outer(starts)).withColumn("window", window).select("id", "row", "m", "start", simhash(F.col("window"), most).alias("fp")), "windows"
    )

    # equal windows are looked up once
    index = bench.select("item", "m", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), away=1)).alias("b")).select("item", "m", "item_fp", "b.block", "b.value")
    n_index = bench.count() * sum(1 + width for _, width in block_widths(BLOCKS))
    asked = windows.select("m", "fp").distinct().withColumn("b", F.explode(blocks(F.col("fp")))).select("m", "fp", "b.block", "b.value")
    near = asked.join(_small(index, n_index), ["m", "block", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select("m", "fp", "item").distinct()

    pairs = windows.join(near, ["m", "fp"])
    pairs = pairs.join(texts, pairs["id"].eqNullSafe(texts["id"]) & (pairs["row"] == texts["row"])).drop(texts["id"]).drop(texts["row"])
    pairs = pairs.withColumn("window", window).join(_small(bench.select("item", F.col("s").alias("item_s")), n_marks), "item")
    judged = pairs.withColumn("similarity", weighted_similarity(F.col("window"), F.col("item_s"))).filter(F.col("similarity") >= threshold)
    return judged.select("id", "item", "start", (F.array_size("window") + F.lit(k - 1)).alias("words"), "similarity")


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows whose id has a contaminated text."""
    own = "bad"
    while own.lower() in (c.lower() for c in docs.columns):
        own = f"_{own}"
    bad = saved(contaminated(docs, items, id_col, **options).select(F.col(id_col).alias(own)).distinct(), "contaminated")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(own)), "left_anti")
