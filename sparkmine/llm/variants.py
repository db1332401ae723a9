"""Spelling variants: words of a corpus that differ by one code point, found by walking tries with Spark joins.

The words are laid out as a trie of edges (node, label, child), a table of its own: chains
without a branch are one edge, a node is the hash of its prefix. A word's states (word,
position, node, edits) start on its own path and meet the edges of their node, level by level:
an edge that the word goes on with keeps the number of edits, and from a state without an edit
an edge with another first sign replaces the word's next sign or is inserted before it. An edge tells
which signs follow its child, so states that could not go on are not made. A state
that ends with its word, on a node where a word ends, after one edit, is a near word.

Of two near words one half agrees exactly. So each word walks two tries, that of the words and
that of the words read backwards, and starts in the middle: no state ever branches near the
root, where nodes have very many words. Insertions show deletions as well (the pair is turned
round). Pairs are held against each other exactly at the end, so hashes decide nothing.

Defined results: null text has no word; a null id is the empty text in the hash; rows that repeat
an id count each on their own; of equally frequent near words the first in code-point order is the
form; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import arrow_rows, saved
from sparkmine.operators.skew import salted_join

MIN_LENGTH, MIN_COUNT = 6, 5
RATIO = 5  # a form occurs at least so many times as often
EVERY = 199  # one in so many (document, word) loses a code point
TEXT_ROWS = 2_000
STATES_PER_TILE = 10_000  # words of one node that a task joins with the node's edges

# Latin-1 value of every sign: letters lower-cased where A-Z, all else a blank.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def document_words(doc_id: int | None, text: str | None, least: int = MIN_LENGTH, every: int = EVERY) -> Counter:
    """How often each word of at least ``least`` signs results from a text (as Latin-1 bytes).

    Runs of letters, lower-cased; where the hash of the id and the run is a multiple of ``every``, the run loses a sign.
    """
    if not text:
        return Counter()
    out = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_FOLDED).split()).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, at_least: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of ``docs`` with at least ``least`` signs and ``at_least`` occurrences, counted in each batch first."""

    def counted(batches):
        for b in batches:
            total = Counter()
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total.update(document_words(i, t, least))
            found = sorted(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in found], pa.string()), pa.array([total[w] for w in found], pa.int64())], ("word", "n")
            )

    own = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter(F.length("text") >= least)
    return own.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= at_least)


def middle(length: int | Column) -> int | Column:
    """So many signs of a word agree with a near word from one of its ends, whichever edit it is."""
    return F.shiftright(length, 1) if isinstance(length, Column) else length >> 1


def word_key(s: str) -> str:
    """The word itself, for a very long one a digest (no letter), so that rows of its prefixes stay short."""
    return s if len(s) <= 64 else "#" + xxhash.xxh3_128_hexdigest(s.encode())


def prefixes(words: DataFrame) -> DataFrame:
    """(side, k, node, depth, next): from just before the middle on, the prefixes of each word (side 0) and each
    word read backwards (side 1), with the sign that follows, empty at the end. ``k`` is the key of the word as read."""

    def walked(batches):
        for b in batches:
            out = ([], [], [], [], [])
            for word in b.column(0).to_pylist():
                for side, s in enumerate((word, word[::-1])):
                    h, first, k = side + 1, max(0, middle(len(s)) - 1), word_key(s)
                    for d in range(len(s) + 1):
                        if d >= first:
                            for c, v in zip(out, (side, k, h - (1 << 64) if h >> 63 else h, d, s[d : d + 1]), strict=True):
                                c.append(v)
                        if len(out[0]) >= 10_000:
                            yield _prefix_batch(out)
                            out = ([], [], [], [], [])
                        if d < len(s):
                            h = (h ^ ord(s[d])) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
                            h ^= h >> 29
            yield _prefix_batch(out)

    return words.select("word").mapInArrow(walked, "side int, k string, node long, depth int, next string")


def _prefix_batch(columns) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ("side", "k", "node", "depth", "next"))


def as_read(words: DataFrame) -> DataFrame:
    """(side, k, s): both readings of every word with their keys."""
    key = F.udf(word_key, "string")
    both = words.select(F.posexplode(F.array("word", F.reverse("word"))).alias("side", "s"))
    return both.select("side", F.when(F.length("s") <= 64, F.col("s")).otherwise(key("s")).alias("k"), "s")


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """-> edges (node, first sign, rest and size of the label, child, what follows there), starts (side, s, node, depth), ends (side, t, node), busy nodes (tiles for ``salted_join``).

    Nodes are prefixes where words branch or end. A start is the first node of a word's path from its middle on,
    an end its last.
    """
    paths = saved(prefixes(words), "prefixes")
    signs = F.bit_or(F.when(F.col("next") != "", follows(F.col("next"))).otherwise(F.lit(0)))
    nodes = paths.groupBy("node").agg(F.min("next").alias("least"), F.max("next").alias("most"), F.count(F.lit(1)).alias("n"), signs.alias("signs"))
    nodes = nodes.filter((F.col("least") == "") | (F.col("least") < F.col("most")))
    nodes = saved(nodes.select("node", "n", F.col("signs").alias("next"), (F.col("least") == "").alias("ends")), "nodes")
    busy = nodes.filter(F.col("n") > STATES_PER_TILE).select("node", F.ceil(F.col("n") / STATES_PER_TILE).cast("int").alias("n_left"), F.lit(1).alias("n_right"))
    on_path = salted_join(paths.select("side", "k", "node", "depth"), nodes.select("node"), ["node"], busy)
    along = Window.partitionBy("side", "k").orderBy("depth")
    steps = on_path.select("side", "k", "node", "depth", F.lead("node").over(along).alias("child"), F.lead("depth").over(along).alias("to"))
    steps = saved(steps.join(as_read(words), ["side", "k"]).drop("k"), "steps")
    label = F.substring(F.col("s"), F.col("depth") + 1, F.col("to") - F.col("depth"))
    edges = steps.filter("child IS NOT NULL").select("node", label.alias("label"), "child").distinct()
    edges = edges.join(nodes.select(F.col("node").alias("child"), "next", "ends"), "child").select(
        "node", F.substring("label", 1, 1).alias("first"), F.substring(F.col("label"), F.lit(2), F.length("label")).alias("rest"), F.length("label").alias("size"),
        "child", "next", "ends",
    )
    starts = steps.filter(F.col("depth") >= middle(F.length("s"))).groupBy("side", "s").agg(F.min_by(F.struct("node", "depth"), "depth").alias("at"))
    ends = steps.filter("child IS NULL").select("side", F.col("s").alias("t"), "node")
    return saved(edges, "trie"), starts.select("side", "s", "at.node", "at.depth"), ends, busy


def follows(sign: Column) -> Column:
    """The bit of a sign in a node's set of following signs (signs that share a bit are told apart by the joins)."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(sign).bitwiseAND(F.lit(63)))


def goes_on(pos: Column) -> Column:
    """Whether the edge's child has an end, or an edge, for the rest of a word from ``pos`` on."""
    left = F.length("s") - pos
    sign = F.substring(F.col("s"), pos + 1, F.lit(1))
    return F.when(left > 0, F.col("next").bitwiseAND(follows(sign)) != 0).otherwise((left == 0) & F.col("ends"))


def advanced(states: DataFrame, edges: DataFrame, busy: DataFrame) -> DataFrame:
    """The next level of states (side, s, pos, sign, node, edits); ``sign`` is the next one of the word."""
    # an edge whose first sign differs: the word's sign is replaced, or the edge's inserted before it
    met = salted_join(states.filter("edits = 0").drop("edits"), edges, ["node"], busy)
    at = F.col("pos")
    same = F.when((F.col("sign") == F.col("first")) & (F.substring(F.col("s"), at + 2, F.col("size") - 1) == F.col("rest")), at + F.col("size"))
    other = F.col("sign") != F.col("first")
    replaced = other & (F.col("sign") != "") & goes_on(at + F.col("size"))
    replaced &= (F.col("size") == 1) | (F.substring(F.col("s"), at + 2, F.col("size") - 1) == F.col("rest"))
    inserted = other & goes_on(at + F.col("size") - 1)
    inserted &= (F.col("size") == 1) | (F.substring(F.col("s"), at + 1, F.col("size") - 1) == F.col("rest"))
    moves = F.array(
        F.struct(same.alias("pos"), F.lit(0).alias("edits")),
        F.struct(F.when(replaced, at + F.col("size")).alias("pos"), F.lit(1).alias("edits")),
        F.struct(F.when(inserted, at + F.col("size") - 1).alias("pos"), F.lit(1).alias("edits")),
    )
    met = met.filter((F.col("sign") == F.col("first")) | replaced | inserted)
    first = met.select("side", "s", "child", F.explode(moves).alias("m")).filter("m.pos IS NOT NULL").select("side", "s", "m.pos", F.col("child").alias("node"), "m.edits")
    # after the edit only the edge that the word goes on with
    exact = states.filter("edits = 1").select("side", "s", "pos", "node", F.col("sign").alias("first")).join(edges, ["node", "first"])
    exact = exact.filter(((F.col("size") == 1) | (F.substring(F.col("s"), at + 2, F.col("size") - 1) == F.col("rest"))) & goes_on(at + F.col("size")))
    then = exact.select("side", "s", (at + F.col("size")).alias("pos"), F.col("child").alias("node"), F.lit(1).alias("edits"))
    return with_sign(first.union(then))


def with_sign(states: DataFrame) -> DataFrame:
    return states.withColumn("sign", F.substring(F.col("s"), F.col("pos") + 1, F.lit(1)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of ``words`` that differ by exactly one inserted, deleted or replaced sign."""
    edges, starts, ends, busy = trie(words)
    states = saved(with_sign(starts.select("side", "s", F.col("depth").alias("pos"), "node", F.lit(0).alias("edits"))), "states")
    ended = []
    while not states.isEmpty():
        done = (F.col("edits") == 1) & (F.col("sign") == "")
        ended.append(states.filter(done).select("side", "s", "node"))
        states = saved(advanced(states.filter(~done), edges, busy), "states")
    if not ended:
        return words.select("word", F.col("word").alias("near")).limit(0)
    found = ended[0]
    for x in ended[1:]:
        found = found.union(x)
    pairs = found.join(ends, ["side", "node"])
    read = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c))
    pairs = pairs.select(read("s").alias("word"), read("t").alias("near"))
    pairs = pairs.union(pairs.select("near", "word")).distinct()
    return pairs.filter(F.levenshtein("word", "near", 1) == 1)


def followed(forms: DataFrame) -> DataFrame:
    """(word, root): from every word of (word, form) along the forms to the last, in steps that double."""
    now = saved(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = saved(now.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "forms")
        if longer.filter("moved").isEmpty():
            return longer.select("word", "root")
        now = longer.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        words = saved(word_counts(docs, id_col, text_col), "words")
    pairs = saved(near_words(words), "near")
    met = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = met.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    told = saved(
        words.join(best, "word", "left").select(
            "word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, -F.col("best.less")).alias("form_n")
        ), "told",
    )
    roots = followed(told.filter("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
