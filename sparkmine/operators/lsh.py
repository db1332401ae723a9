"""MinHash signatures as a table, and a stored band index that a new batch can be held against.

A shingle's number is the first 32 bits of its MD5 hash: the same in every batch and every run, so signatures of
different days can be compared (numbers by vocabulary position cannot). Entry t of a signature is the least of
``((1 + x) * a_t + b_t) mod p`` over the set's numbers x.

The index is a Spark table bucketed and sorted by (band, key). A probe deals only the new batch's bands out to
the buckets; the stored ones are read where they lie.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators.shingles import long_enough
from sparkmine.operators.windows import pieces, shingle_strings, text_lengths
from sparkmine.session import ensure_checkpoint_dir, keep_until_release

PRIME = (1 << 31) - 1  # so a product with a 32-bit number stays below 2**63
BUCKETS = 64


def coefficients(tables: int, seed: int = 17) -> list[tuple[int, int]]:
    """``(a, b)`` of each table: a fixed sequence, from a linear congruence over the prime."""
    out, x = [], seed
    for _ in range(tables):
        a = x = (48271 * x + 11) % PRIME
        b = x = (48271 * x + 11) % PRIME
        out.append((a or 1, b))
    return out


NUMBERED = 200_000  # shingles whose numbers a task keeps


def _numbers(shingles: pa.Array, known: dict) -> np.ndarray:
    """The first 32 bits of the MD5 hash of each different shingle; ``known`` keeps those of shingles met before."""
    texts = shingles.to_pylist()
    if len(known) > NUMBERED:
        known.clear()
    for t in texts:
        if t not in known:
            known[t] = int.from_bytes(md5(t.encode(), usedforsecurity=False).digest()[:4], "big")
    return np.array([known[t] for t in texts], np.int64)


def _least(shingles: pa.Array, cuts: np.ndarray, coeffs: list[tuple[int, int]], known: dict) -> pa.ListArray:
    """The signature of each set of ``shingles`` (none empty), cut at ``cuts``; a shingle of many sets is hashed once."""
    coded = shingles.dictionary_encode()
    x, at = _numbers(coded.dictionary, known) + 1, coded.indices.to_numpy()
    out = np.empty((len(cuts) - 1, len(coeffs)), np.int64)
    for t, (a, b) in enumerate(coeffs):
        out[:, t] = np.minimum.reduceat(((x * a + b) % PRIME)[at], cuts[:-1])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * len(coeffs), pa.int32()), pa.array(out.ravel()))


def signatures(sets: DataFrame, tables: int, seed: int = 17) -> DataFrame:
    """``(id, hashes array<long>)`` from ``(id, shingles)``; computed batch by batch, nothing moves. A set without a shingle has no values (null)."""
    coeffs = coefficients(tables, seed)

    def sign(batches):
        known = {}
        for b in batches:
            lists = b.column("shingles")
            for lo, hi in pieces(lists.value_lengths().to_numpy(zero_copy_only=False)):
                own, ids = lists.slice(lo, hi - lo), b.column("id").slice(lo, hi - lo)
                sizes = own.value_lengths().to_numpy(zero_copy_only=False)
                full = np.flatnonzero(sizes > 0)
                if len(full):
                    cuts = np.concatenate([[0], np.cumsum(sizes[full])])
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(full)), _least(own.flatten(), cuts, coeffs, known)], ("id", "hashes"))
                if len(full) < len(own):
                    bare = np.flatnonzero(sizes <= 0)
                    nothing = pa.array([[None] * tables] * len(bare), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(bare)), nothing], ("id", "hashes"))

    own = sets.select("id", F.coalesce("shingles", F.array().cast("array<string>")).alias("shingles"))
    return own.mapInArrow(sign, f"id {dict(sets.dtypes)['id']}, hashes array<long>")


def text_signatures(docs: DataFrame, tables: int, seed: int = 17) -> DataFrame:
    """``signatures`` of the shingles of texts ``(id, para)`` that have one, straight from the texts."""
    coeffs = coefficients(tables, seed)

    def sign(batches):
        known = {}
        for b in batches:
            for lo, hi in pieces(text_lengths(b.column("_t"))):
                counts, shingles = shingle_strings(b.column("_t").slice(lo, hi - lo))
                cuts = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), _least(shingles, cuts, coeffs, known)], ("id", "hashes"))

    own = long_enough(docs)
    return own.mapInArrow(sign, f"id {dict(own.dtypes)['id']}, hashes array<long>")


def bands(sigs: DataFrame, rows: int) -> DataFrame:
    """``(id, band, key)``: a hash for every ``rows`` entries of a signature; ``rows=1`` is the plain OR over tables."""
    at = F.sequence(F.lit(0), F.floor(F.array_size("hashes") / rows).cast("int") - 1)
    cut = F.transform(at, lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.slice("hashes", b * rows + 1, rows)).alias("key")))
    return sigs.select("id", F.explode(cut).alias("b")).select("id", "b.band", "b.key")


def _once(sets: DataFrame) -> bool:
    """Whether no id comes twice."""
    return sets.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


class BandIndex:
    """Bands of all sets ``(id, shingles)`` or texts ``(id, para)`` so far, in one bucketed table for each batch, with files in ``folder`` (a shared one, to be kept; else the session's)."""

    def __init__(self, spark: SparkSession, name: str, tables: int, rows: int, seed: int = 17, buckets: int = BUCKETS, folder: str | None = None):
        self.spark, self.name, self.folder = spark, name, folder and folder.rstrip("/")
        self.tables, self.rows, self.seed, self.buckets = tables, rows, seed, buckets
        self.batches, self.once = 0, []  # once: whether a batch has no id twice

    def banded(self, sets: DataFrame) -> DataFrame:
        """``bands`` with ``before``: the keys of the bands before each one."""
        own = signatures if "shingles" in sets.columns else text_signatures
        at = F.sequence(F.lit(0), F.floor(F.array_size("hashes") / self.rows).cast("int") - 1)
        keys = F.transform(at, lambda b: F.xxhash64(b, F.slice("hashes", b * self.rows + 1, self.rows)))
        keyed = own(sets, self.tables, self.seed).select("id", keys.alias("keys"))
        return keyed.select("id", "keys", F.posexplode("keys").alias("band", "key")).select("id", "band", "key", F.slice("keys", 1, F.col("band")).alias("before"))

    def add(self, sets: DataFrame) -> None:
        """Store a batch; batches before it are not read."""
        rows = self.banded(sets).repartition(self.buckets, "band", "key")
        table = f"{self.name}_{self.batches}"
        path = f"{self.folder or ensure_checkpoint_dir(self.spark).rstrip('/') + '/sparkmine'}/{table}"
        rows.write.bucketBy(self.buckets, "band", "key").sortBy("band", "key").option("path", path).mode("error").saveAsTable(table)
        if not self.folder:
            keep_until_release(path)
        self.once.append(_once(sets))
        self.batches += 1

    def probe(self, sets: DataFrame) -> DataFrame:
        """``(old, new)`` ids that share a band, each pair once; ``sets`` is a new batch.

        A pair comes from the first band that it shares, so no pair is dealt out to be told from itself. Only if ids come
        more than once (in the new batch, in a stored one or in several), pairs are made distinct.
        """
        asked = self.banded(sets).select(F.col("id").alias("new"), "band", "key", F.col("before").alias("new_before"))
        out = None
        for b in range(self.batches):
            # merge join on the buckets: stored rows stay where they are, whatever the new batch's size
            stored = self.spark.table(f"{self.name}_{b}").select(F.col("id").alias("old"), "band", "key", "before").hint("merge")
            met = stored.join(asked, ["band", "key"])
            for k in range(self.tables // self.rows - 1):  # an earlier band that both have in common
                met = met.where(F.coalesce(F.get("before", F.lit(k)) != F.get("new_before", F.lit(k)), F.lit(True)))
            met = met.select("old", "new")
            out = met if out is None else out.union(met)
        if out is None:
            return self.spark.createDataFrame([], "old long, new long")
        return out if self.batches == 1 and self.once[0] and _once(sets) else out.distinct()

    def drop(self) -> None:
        for b in range(self.batches):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{b}")
        self.batches, self.once = 0, []
