"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Every word shingle is hashed once; the hash picks one of ``BINS`` bins and a value, and each
bin keeps its least value. An empty bin borrows from a bin that a hash of (bin, attempt) picks,
attempt after attempt, until that one is full. Only the ``BITS`` lowest bits of each bin are
stored. Chance agreement of b-bit values, 2**-b, is taken out of the likeness.

Defined results: null text is the empty text; a text without any sign but blanks has no
shingle and an empty-set fingerprint, alike (1) only to another such text and else 0; fewer
than five words make one shingle; equal texts have equal fingerprints. The next document
goes by ascending id; rows that repeat an id are ordered by their text; the last one's next
is the first, and a lone document's next is itself. Rows without an id come first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import mix64, partitions, text_shingles

BINS, BITS = 256, 4
EMPTY = "-"
SCHEMA = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FIRST = 16  # attempts that are looked at together at first; each time four times as many


def probes(first: int, attempts: int, bins: np.ndarray) -> np.ndarray:
    """The bins that each of ``bins`` asks in the attempts from ``first`` on, a row for an attempt."""
    ask = (np.arange(first, first + attempts, dtype=np.uint64)[:, None] * np.uint64(BINS)) + bins.astype(np.uint64)[None, :]
    return (mix64(ask + np.uint64(0x51ED27)) % np.uint64(BINS)).astype(np.int64)


_PROBES = probes(0, _FIRST, np.arange(BINS))


def signature(shingles: np.ndarray) -> np.ndarray | None:
    """The low bits of each bin's least value, empty bins filled; None for the empty set."""
    if len(shingles) == 0:
        return None
    low = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    at = (shingles >> np.uint64(56)).astype(np.int64) % BINS
    np.minimum.at(low, at, mix64(shingles & np.uint64((1 << 56) - 1)) >> np.uint64(1))
    full = low != np.iinfo(np.uint64).max
    out, missing = low.copy(), np.flatnonzero(~full)
    done, attempts = 0, _FIRST
    while len(missing):
        ask = _PROBES[:, missing] if done == 0 else probes(done, attempts, missing)
        hit = full[ask]
        found = hit.any(axis=0)
        out[missing[found]] = low[ask[hit.argmax(axis=0)[found], np.flatnonzero(found)]]
        missing = missing[~found]
        done, attempts = done + attempts, min(4 * attempts, 1024)
    return (out & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(sig: np.ndarray | None) -> str:
    """Two 4-bit values to a byte, as hex."""
    return EMPTY if sig is None else ((sig[0::2] << 4) | sig[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity: agreement of bins without what chance gives."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def edited_text(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _rows(batches: pa.RecordBatch, step: int = 256):
    for b in batches:
        for i in range(0, b.num_rows, step):
            yield from zip(*(c.to_pylist() for c in b.slice(i, step).columns), strict=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_partition: int = 8) -> DataFrame:
    """The result of the module's text for every row of ``docs``.

    Texts are shuffled once, by ranges of the id, and each task streams its sorted rows,
    holding two of them at a time. Range starts are ids that occur, found by Spark's quantile
    sketch over the ids alone; their number is fixed by the session's partitions. A row at a
    start is dealt twice, the second time as the tail of the range before it.
    """
    n = partitions(docs) * per_partition
    key = F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63)))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", key)
    found = own.agg(F.min("key").alias("least"), F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first()
    starts = np.array(sorted({found["least"], *(found["cuts"] or [])} - {None}), np.int64)

    @F.pandas_udf("ranges array<int>")
    def place(keys: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, keys.to_numpy(np.int64), "right") - 1
        before = (at - 1) % len(starts)
        # a tail is written as -1 - range
        return pd.DataFrame({"ranges": [[r, -1 - b] if k == starts[r] else [r] for k, r, b in zip(keys, at.tolist(), before.tolist(), strict=True)]})

    dealt = own.withColumn("to", F.explode(place.asNondeterministic()("key").getField("ranges")))
    dealt = dealt.select((F.col("to") < 0).alias("tail"), F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("range"), "key", "id", "text")
    placed = dealt.repartition(partitions(docs), "range").sortWithinPartitions("range", "tail", "key", "text").select("range", "tail", "id", "text")

    def sketch(batches):
        held, done, tailed = None, [], None  # held: (range, id, text, signature) that waits for its next
        for group, tail, i, text in _rows(batches):
            if tail and tailed == group:
                continue  # only the least of the tail rows follows
            tailed = group if tail else None
            sig = signature(text_shingles(text))
            if held is not None and held[0] == group:
                done.append(_finished(held, text, sig))
            held = None if tail else (group, i, text, sig)
            if len(done) >= 2000:
                yield _batch(done)
                done = []
        if done:
            yield _batch(done)

    return placed.mapInArrow(sketch, SCHEMA).withColumnRenamed("id", id_col)


def _finished(row, following: str, next_sig) -> tuple:
    _, i, text, sig = row
    other = edited_text(text, following)
    other_sig = sig if other == text else signature(text_shingles(other))
    return (
        i, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), packed(sig), packed(other_sig),
        likeness(sig, other_sig), likeness(sig, next_sig),
    )


_FIELDS = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _FIELDS)
