"""Near-duplicate classes by ProbMinHash over weighted word shingles.

A text is the set of its five-word shingles, a shingle that occurs f times weighing
1 + ln f. Every shingle sends arrivals, a Poisson process whose rate is its weight, to
random registers; each register keeps the shingle that arrived first. A shingle stops as
soon as its next arrival is later than every register's. Two texts agree in a register
with the probability Jaccard similarity of their weighted sets.

Registers are cut into bands; texts with an equal band are candidates. Exact copies count as
one text. Candidates are first a bucket's texts against its least text; components of the
verified links then tell which buckets hold texts of different components, and there the texts
outside the largest component are held against the texts of other components. Before that, a bound
from the shingles that no other text has puts aside, with all their pairs, texts that cannot
reach the threshold. So every candidate link between components is decided, and no group is
expanded into all its pairs.
A pair whose registers agree far less than the threshold is dropped, the rest is verified
by the exact similarity.

Defined results: null text is the empty text. Texts without a word are alike only if equal;
fewer than five words make one shingle; repeated rows and ids all get a row; texts, told apart by
a 64-bit hash, are judged each on its own, also under one id; a row without an id gets a class
through its text; a class's id is its least document id, and where that is the least of several
classes, the one whose text has the least hash takes it and the others' ids are numbers over all
usual ids; empty tables give no rows. Whole texts count. At similarity 0.8 the bands miss one pair in 20,000 and the register
test one in 200,000. Full buckets are joined in tiles of bounded work. ``LOOSE`` finds texts with scattered edits, of which five
words and 0.8 link few: one changed word of a text costs five shingles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import SHINGLE_WORDS, SIMILARITY, arrow_rows, each_text, mix64, saved, text_shingles
from sparkmine.llm.components import components
from sparkmine.operators.skew import hot_keys, salted_join

SLACK = 0.16  # registers may agree this much less than the threshold (four and a half standard errors)
PRUNINGS = 2  # rounds that put aside texts which cannot have a link left
TEXT_ROWS, PAIR_ROWS = 2_000, 500  # rows that an Arrow batch of texts, or of pairs of sets, may hold


@dataclass(frozen=True)
class Scheme:
    """What counts as alike, and the bands that find it."""

    words: int = SHINGLE_WORDS
    threshold: float = SIMILARITY
    bands: int = 25
    rows: int = 5

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    def missed(self, similarity: float) -> float:
        """Share of pairs of this similarity that no band finds."""
        return (1.0 - similarity**self.rows) ** self.bands


STRICT = Scheme()
# for texts with scattered edits: a changed word costs three shingles instead of five
LOOSE = Scheme(words=3, threshold=0.6, bands=32, rows=4)


def weighted_shingles(text: str | None, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order and how often each occurs."""
    return np.unique(text_shingles(text, words), return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def prob_minhash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = STRICT.registers) -> np.ndarray:
    """One row of ``registers`` shingle hashes for each (hashes, counts); 0 everywhere for an empty set.

    All sets advance together, one arrival of every shingle that is still early enough at a time.
    """
    n = len(sets)
    sig = np.zeros(n * registers, np.uint64)
    if not any(len(h) for h, _ in sets):
        return sig.reshape(n, registers)
    elem = np.concatenate([h for h, _ in sets])
    seg = np.repeat(np.arange(n), [len(h) for h, _ in sets])
    rate = weights(np.concatenate([c for _, c in sets]))
    at = np.zeros(len(elem))
    first = np.full(n * registers, np.inf)
    step = 0
    while len(elem):
        step += 1
        draw = mix64(elem + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        reg = seg * registers + (mix64(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, reg, at)
        won = first[reg] == at
        sig[reg[won]] = elem[won]
        early = at < first.reshape(n, registers).max(axis=1)[seg]
        elem, seg, rate, at = elem[early], seg[early], rate[early], at[early]
    return sig.reshape(n, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common shingles d of 1 / sum over e of max(a_e / a_d, b_e / b_d)."""
    if len(a[0]) == 0 or len(b[0]) == 0:
        return float(len(a[0]) == len(b[0]))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if len(i) == 0:
        return 0.0
    wa, wb = weights(a[1]), weights(b[1])
    x, y = wa[i], wb[j]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    lower = np.searchsorted(ratio, ratio, "left")
    below_b = np.concatenate([[0.0], np.cumsum(y)])[lower]
    above_a = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[lower]
    return float((1.0 / ((above_a + only_a) / x + (below_b + only_b) / y)).sum())


def _key(text: str | None) -> bytes:
    return xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))


def text_key(text: Column) -> Column:
    """The key of a text, the same for equal texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def number_over_ids(key: Column) -> Column:
    """A number over all usual ids, from a text's key."""
    return F.shiftrightunsigned(key, 2) + F.lit(1 << 62)


def id_number(row_id: Column, text: Column) -> Column:
    """The id; without one, a number over all usual ids."""
    return F.coalesce(row_id.cast("long"), number_over_ids(text_key(text)))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(own.alias("id"), id_number(own, text).alias("number"), text_key(text).alias("key"), text.alias("text"))


def signatures(docs: DataFrame, id_col: str, text_col: str, scheme: Scheme = STRICT) -> DataFrame:
    """(id, number, key, bands, sig): number of the id, key of the text, one hash for each band, low bits of the registers.

    The hashing of a text is repeated for equal texts of other batches only.
    """

    def sign(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                texts = part.column(3).to_pylist()
                keys = [_key(t) for t in texts]
                own = {k: n for n, k in enumerate(dict.fromkeys(keys))}
                text_of = dict(zip(keys, texts, strict=True))
                sets = [weighted_shingles(text_of[k], scheme.words) for k in own]
                sig = prob_minhash(sets, scheme.registers)
                band = np.zeros((len(own), scheme.bands), np.uint64)
                for r in range(scheme.rows):
                    band = mix64(band * np.uint64(31) + sig[:, r :: scheme.rows])
                band = mix64(band + np.arange(scheme.bands, dtype=np.uint64)).view(np.int64)
                low = (mix64(sig) & np.uint64(255)).astype(np.uint8)
                bands = [band[n].tolist() if len(sets[n][0]) else [] for n in range(len(own))]
                at = [own[k] for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2),
                     pa.array([bands[n] for n in at], pa.list_(pa.int64())), pa.array([low[n].tobytes() for n in at], pa.binary())],
                    ("id", "number", "key", "bands", "sig"),
                )

    return numbered(docs, id_col, text_col).mapInArrow(
        sign, "id long, number long, key long, bands array<long>, sig binary"
    )


def _agreement(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        p, q = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (x, y))
        return pd.Series((p == q).mean(axis=1))

    return agree.asNondeterministic()(a, b)


def shingle_table(texts: DataFrame, nodes: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(node, h, c, weight): distinct shingles, their counts and their whole weight, of these nodes' texts.

    ``nodes`` (node, number, key) name one id of each text, so of many copies one is shingled.
    """

    @F.pandas_udf("h array<long>, c array<int>, weight double")
    def shingled(t: pd.Series) -> pd.DataFrame:
        sets = [weighted_shingles(x, words) for x in each_text(t)]
        return pd.DataFrame({"h": [h.view(np.int64) for h, _ in sets], "c": [c.astype(np.int32) for _, c in sets], "weight": [float(weights(c).sum()) for _, c in sets]})

    own = texts.join(nodes, ["number", "key"]).dropDuplicates(["number", "key"])
    return own.select("node", shingled.asNondeterministic()("text").alias("s")).select("node", "s.*")


def verified(pairs: DataFrame, reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose exact similarity reaches ``threshold``.

    Whole sets travel only for pairs with enough agreeing registers.
    """
    sig_a, sig_b = (reps.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    likely = pairs.join(sig_a, "a").join(sig_b, "b").withColumn("agree", _agreement(F.col("sig_a"), F.col("sig_b")))
    likely = saved(likely.filter(F.col("agree") >= threshold - SLACK).select("a", "b"), "likely")

    @F.pandas_udf("double")
    def similarity(ha: pd.Series, ca: pd.Series, hb: pd.Series, cb: pd.Series) -> pd.Series:
        read = lambda h, c: (np.asarray(h, np.int64).view(np.uint64), np.asarray(c))
        return pd.Series([probability_jaccard(read(w, x), read(y, z)) for w, x, y, z in zip(ha, ca, hb, cb, strict=True)], dtype="float64")

    set_a, set_b = (sets.select(F.col("node").alias(c), F.col("h").alias(f"h_{c}"), F.col("c").alias(f"c_{c}")) for c in "ab")
    both = likely.join(set_a, "a").join(set_b, "b").withColumn("sim", similarity.asNondeterministic()("h_a", "c_a", "h_b", "c_b"))
    with arrow_rows(pairs.sparkSession, PAIR_ROWS):
        return saved(both.filter(F.col("sim") >= threshold).select("a", "b"), "links")


def mixed(placed: DataFrame) -> DataFrame:
    """Rows (bucket, node, comp) of the buckets that hold several components, with the largest as ``main``."""
    sizes = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("main")).filter("comps > 1")
    return placed.select("bucket", "node", "comp").join(several.select("bucket", "main"), "bucket")


def shares(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, size, weight, common, alone): shingles in all, their weight, how many some other of
    the nodes has too, and the weight of those that none has."""
    own = sets.join(nodes, "node", "left_semi")
    each = own.select("node", F.explode_outer(F.arrays_zip("h", "c")).alias("s")).select("node", F.col("s.h").alias("h"), F.col("s.c").alias("c"))
    single = each.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("c").alias("c")).filter("n = 1")
    alone = single.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum(1.0 + F.log(F.col("c"))).alias("alone"))
    size = F.array_size("h")
    return own.select("node", size.alias("size"), "weight").join(alone, "node", "left").select(
        "node", "size", "weight", (F.col("size") - F.coalesce("n", F.lit(0))).alias("common"), F.coalesce("alone", F.lit(0.0)).alias("alone")
    )


def most_alike(size, weight, common, alone, other_size, other_weight, other_common, other_alone) -> Column:
    """The largest probability Jaccard that two sets can have, told by their shares.

    A set has at least ``q`` of weight that the other lacks: that of its lone shingles, and 1 for
    each shingle beyond those that the other has in common with anyone. The sum over common shingles d of
    1 / (A / a_d + q_B / b_d) is concave, so at most 1 / (A / (A - q_A) + q_B / (B - q_B)).
    """
    qa = F.greatest(alone, size - other_common)
    qb = F.greatest(other_alone, other_size - common)
    left, right = weight - qa, other_weight - qb
    return F.when((left > 0) & (right > 0), 1.0 / (weight / left + qb / right)).otherwise(0.0) + 1e-9


def able(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The rows (bucket, node, comp) whose node could reach ``threshold`` with another text of its bucket, with its shares."""
    told = rows.select("bucket", "node", "comp").join(saved(shares(sets, rows.select("node").distinct()), "shares"), "node")
    best = told.groupBy("bucket").agg(F.max("common").alias("mc"), F.min("size").alias("ms"), F.max("weight").alias("mw"))
    bound = most_alike(F.col("size"), F.col("weight"), F.col("common"), F.col("alone"), F.col("ms"), F.col("mw"), F.col("mc"), F.lit(0.0))
    return told.join(best, "bucket").filter(bound >= threshold).drop("mc", "ms", "mw")


def links_between(placed: DataFrame, tested: DataFrame, reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified links (a, b) between different components of the same bucket.

    Texts that are too unlike all others to have any link left are put aside first; each
    round makes more shingles lone, so a few rounds leave little.
    """
    rows = saved(mixed(placed), "open")
    for _ in range(PRUNINGS):
        rows = able(rows, sets, threshold)
        shared = rows.select("node", "size", "weight", "common", "alone").distinct()
        rows = saved(mixed(rows).join(shared, "node"), "open")
    rows = rows.join(reps.select("node", "bands"), "node")
    x = rows.filter("comp <> main").select("bucket", *(F.col(c).alias(f"x_{c}") for c in ("node", "comp", "size", "weight", "common", "alone", "bands")))
    bound = most_alike(*(F.col(f"{p}{c}") for p in ("x_", "") for c in ("size", "weight", "common", "alone")))
    # a pair that shares several buckets is formed in the first of them only
    first = F.get(F.array_intersect("x_bands", "bands"), 0) == F.col("bucket")
    once = (F.col("comp") == F.col("main")) | (F.col("x_node") < F.col("node"))
    across = salted_join(x, rows, ["bucket"], hot_keys(x, ["bucket"], rows)).filter((F.col("x_comp") != F.col("comp")) & once & (bound >= threshold) & first)
    pairs = across.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()
    return verified(pairs.join(tested, ["a", "b"], "left_anti"), reps, sets, threshold)


def claims(rows: DataFrame) -> DataFrame:
    """(number, taker): numbers that several rows (number, key) claim, with the least key, which takes it."""
    several = rows.groupBy("number").agg(F.min("key").alias("taker"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return saved(several.select("number", "taker"), "claims")


def settled(rows: DataFrame, claimed: DataFrame, name: str) -> DataFrame:
    """Rows (number, key) with a number of their own: theirs, if no other has taken it."""
    own = F.when(F.col("taker") != F.col("key"), number_over_ids(F.col("key"))).otherwise(F.col("number"))
    return rows.join(claimed, "number", "left").withColumn(name, own).drop("taker")


def named(members: DataFrame) -> DataFrame:
    """(class, class_id, stand): each class's id and the least (number, key) in it, from (class, number, key) of its texts."""
    stand = F.min(F.struct("number", "key")).alias("stand")
    classes = saved(members.groupBy("class").agg(stand).select("class", "stand", "stand.number", "stand.key"), "classes")
    return settled(classes, claims(classes), "class_id").select("class", "class_id", "stand")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: Scheme = STRICT) -> DataFrame:
    """(id, class_id): every row of ``docs`` with the id of its class of near copies."""
    return classified(docs, id_col, text_col, scheme).select(F.col("id").alias(id_col), "class_id")


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: Scheme = STRICT) -> DataFrame:
    """(id, number, key, class_id, stands): every row with its number, its class, and whether its id and text are the class's first."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        signed = saved(signatures(docs, id_col, text_col, scheme), "signed")
    # exact copies are one node: the least of their ids, if no unlike text has taken it
    reps = saved(
        signed.groupBy("key").agg(F.min("number").alias("number"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("n")), "reps"
    )
    claimed = claims(reps)
    unlike = not claimed.isEmpty()
    reps = settled(reps, claimed, "node") if unlike else reps.withColumn("node", F.col("number"))
    rows = reps.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = saved(rows.join(shared.drop("n"), "bucket"), "members")
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        asked = reps.select("node", "number", "key").join(members.select("node").distinct(), "node", "left_semi")
        sets = saved(shingle_table(numbered(docs, id_col, text_col).select("number", "key", "text"), asked, scheme.words), "shingles")

    tested = members.filter("lead <> node").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    comps = saved(components(verified(tested, reps, sets, scheme.threshold)), "comps")
    placed = members.join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    more = links_between(placed, tested, reps, sets, scheme.threshold)
    # the new links join whole components
    ends = more.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left").join(comps.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
    merged = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))

    def classed(rows: DataFrame) -> DataFrame:
        joined = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        joined = joined.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("whole")), "comp", "left")
        return joined.select(*rows.columns, F.coalesce("whole", "comp").alias("class"))

    copies = reps.filter((F.col("n") > 1) | (F.col("node") != F.col("number"))).select("key", "node")
    found = classed(signed.select("id", "number", "key").join(copies, "key", "left").withColumn("node", F.coalesce("node", "number")))
    if not unlike:  # then a class's least node is its least id
        return found.select("id", "number", "key", F.col("class").alias("class_id"), (F.col("number") == F.col("class")).alias("stands"))
    stands = (F.col("stand.number") == F.col("number")) & (F.col("stand.key") == F.col("key"))
    return found.join(named(classed(reps.select("node", "number", "key"))), "class").select("id", "number", "key", "class_id", stands.alias("stands"))
