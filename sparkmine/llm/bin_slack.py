"""Best-fit packing by minimum bin slack.

A document's token ids (its text's ids and the end id) make one piece, or, if longer than a
sequence, a first piece with the remainder and full pieces after it. Bins are filled one
after the other: starting with the longest length left, a subset-sum dynamic programme over
the lengths still available (one bit for each reachable total) finds the fullest feasible
bin, which is then taken out as often as its lengths allow.

The programme runs over the histogram of lengths, at most ``capacity`` numbers, so its input
does not grow with the corpus; pieces meet their places by their rank among the pieces
of their length. Ranks come from windows over (length, salt) and a prefix sum of the counts; the number of
salts of a length grows with its count, so the full pieces of a large corpus are no fixed number of tasks.

Defined results: null text is the empty text, a piece of one end id; ties of length go by id
hash, id and piece; rows that repeat an id are packed as documents of their own; an empty
table gives no pieces. A text's mark for the end of text is read as the tokenizer reads it.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import local_table, saved

CAPACITY, END_ID = 1024, 2
# Pieces of one length that one salt holds on average at most; a length has as many salts as its count asks for, and at least these.
PIECES_PER_SALT, LEAST_SALTS = 16_384, 64


class Unclear(Exception):
    """A run of blanks that only the whole text tells how to split."""


class WordIds(dict):
    """word -> little-endian ids of a blank and that word, remembered.

    A blank before another sign begins a new piece for this tokenizer's pattern, whatever
    stands before it, so text may be encoded from blank to blank; a word that is empty or begins
    with a blank sign is not such a case.
    """

    def __init__(self, encode, limit: int = 400_000):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise Unclear
        out = np.array(self.encode(" " + word), "<u4").tobytes()
        if len(word) <= 40:
            if len(self) >= self.limit:
                self.clear()
            self[word] = out
        return out


@lru_cache(maxsize=2)
def _loaded(tokenizer_path: str, ranks_path: str, pattern: str):
    """The tokenizer's marks, and its vocabulary as ranks, which encodes several times faster."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    with open(tokenizer_path, encoding="utf-8") as f:
        marks = [t["content"] for t in json.load(f).get("added_tokens", [])]
    return marks, encode, WordIds(encode)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer itself, for texts with a mark only."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_bytes(text: str | None, tokenizer_path: str, ranks_path: str, pattern: str, end_id: int = END_ID) -> bytes:
    """All ids of a document, four bytes each, the end id last."""
    marks, encode, words = _loaded(tokenizer_path, ranks_path, pattern)
    text = text or ""
    if any(m in text for m in marks):
        body = np.array(_tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    else:
        first, *more = text.split(" ")
        try:
            body = np.array(encode(first), "<u4").tobytes() + b"".join(map(words.__getitem__, more))
        except Unclear:
            body = np.array(encode(text), "<u4").tobytes()
    return body + end_id.to_bytes(4, "little")


def pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece; ids themselves stay in the task."""

    def cut(batches):
        try:
            for b in batches:
                for i in range(0, b.num_rows, 256):
                    part = b.slice(i, 256)
                    out = []
                    for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        data = token_bytes(text, tokenizer_path, ranks_path, pattern, end_id)
                        n = len(data) // 4
                        first = (n - 1) % capacity + 1
                        edges = [0, *range(first, n + 1, capacity)]
                        out += [(doc, k, s, e - s, zlib.crc32(data[4 * s : 4 * e])) for k, (s, e) in enumerate(zip(edges, edges[1:]))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                        ("doc", "piece", "start", "length", "ids_crc32"),
                    )
        finally:  # a worker process outlives its tasks
            _loaded(tokenizer_path, ranks_path, pattern)[2].clear()

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        cut, "doc long, piece int, start long, length long, ids_crc32 long"
    )


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, with repeats, whose sum is the largest total up to ``room`` that ``counts`` allows.

    Bit t of ``reach[k]`` says that total t can be made of the k longest kinds of lengths;
    the walk back takes shorter lengths first, so long ones are used where both fit.
    """
    mask = (1 << (room + 1)) - 1
    kinds = sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True)
    reach = [1]
    for n in kinds:
        bits, left, step = reach[-1], min(counts[n], room // n), 1
        while left > 0:  # repeats by doubling
            take = min(step, left)
            bits |= (bits << (n * take)) & mask
            left -= take
            step *= 2
        reach.append(bits)
        if bits >> room & 1:
            break
    total = reach[-1].bit_length() - 1
    out = []
    for k in range(len(reach) - 1, 0, -1):
        n, used = kinds[k - 1], 0
        while not (reach[k - 1] >> total) & 1:
            total -= n
            used += 1
            out.append(n)
    return out


def bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(lengths of a bin with their numbers, how many such bins), the longest lengths first."""
    left = dict(histogram)
    out = []
    while left:
        seed = max(left)
        rest = dict(left)
        rest[seed] -= 1
        own = Counter([seed, *fullest(rest, capacity - seed)])
        times = min(left[n] // k for n, k in own.items())
        out.append((dict(own), times))
        for n, k in own.items():
            left[n] -= k * times
            if left[n] == 0:
                del left[n]
    return out


def places(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """For each bin kind and length: which ranks of the length it takes and where they go.

    The r-th piece of a length with ``first <= r < first + k * times`` goes to sequence
    ``base + (r - first) // k`` at ``offset + ((r - first) % k) * length``.
    """
    taken: Counter[int] = Counter()
    rows, base = [], 0
    for own, times in plan:
        offset = 0
        for n in sorted(own, reverse=True):
            k = own[n]
            rows.append((n, taken[n], k * times, k, base, offset))
            taken[n] += k * times
            offset += n * k
        base += times
    return pd.DataFrame(rows, columns=["length", "first", "many", "k", "base", "offset"])


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every row of ``pieces`` with its sequence_id and offset. ``cut`` should be a stored table."""
    spark = cut.sparkSession
    histogram = {int(r["length"]): r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    table = places(bins(histogram, capacity))
    kinds = sorted(histogram)
    salts = local_table(spark, {"length": pa.array(kinds, pa.int64()), "salts": pa.array([max(LEAST_SALTS, -(-histogram[n] // PIECES_PER_SALT)) for n in kinds], pa.int64())})
    salted = cut.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc", "piece"), F.col("salts"))).drop("salts")
    counted = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # a row for each salt
    before = counted.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    by_length = {int(n): g for n, g in table.groupby("length")}

    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("r", rank).join(before, ["length", "salt"]).withColumn("r", F.col("r") + F.col("before"))
    shared = spark.sparkContext.broadcast({n: tuple(g[c].to_numpy() for c in ("first", "k", "base", "offset")) for n, g in by_length.items()})

    @F.pandas_udf("sequence_id long, offset long")
    def put(length: pd.Series, r: pd.Series) -> pd.DataFrame:
        seq, off = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
        ln, rr = length.to_numpy(np.int64), r.to_numpy(np.int64)
        for n in np.unique(ln):
            first, k, base, offset = shared.value[int(n)]
            own = np.flatnonzero(ln == n)
            at = np.searchsorted(first, rr[own], "right") - 1
            inside = rr[own] - first[at]
            seq[own] = base[at] + inside // k[at]
            off[own] = offset[at] + inside % k[at] * n
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return ranked.withColumn("p", put.asNondeterministic()("length", "r")).select(
        "doc", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset"
    )


def packed_documents(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
) -> DataFrame:
    """All documents' pieces with their places; pieces are stored once, as counting and placing both need them."""
    cut = saved(pieces(docs, tokenizer_path, ranks_path, pattern, id_col, text_col, capacity), "pieces")
    return pack(cut, capacity).withColumnRenamed("doc", id_col)
