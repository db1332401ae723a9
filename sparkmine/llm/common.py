"""Small helpers shared by the text operators: folds, samples, words, shingles, tables."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.session import ensure_checkpoint_dir, keep_until_release

WORD = re.compile(r"\w+")
SHINGLE_WORDS = 5
SIMILARITY = 0.8

# Unicode code points that are letters; filled on first use in each worker.
_LETTERS: np.ndarray | None = None


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id written as text, modulo ``k`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(k)


def bounded_sample(df: DataFrame, id_col: str, rows: int, seed: int = 7) -> DataFrame:
    """The ``rows`` rows with the smallest hash of their id (all, if there are fewer).

    Only ids are looked at to find the bound; one number reaches the driver. Rows that
    repeat an id are taken together.
    """
    key = F.xxhash64(F.lit(seed), F.col(id_col))
    edge = df.select(key.alias("k")).orderBy("k").limit(rows).agg(F.max("k")).first()[0]
    return df.filter(key <= F.lit(edge)) if edge is not None else df.limit(0)


def labelled_sample(docs: DataFrame, labels: DataFrame, text_cols: dict[str, str], label_col: str, id_col: str, rows: int) -> DataFrame:
    """(y int, renamed columns of ``docs``) for at most ``rows`` labels, one for an id.

    The labels are sampled before the join, so the broadcast side has at most ``rows`` rows.
    """
    marks = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y"))
    marks = bounded_sample(marks, "_id", rows).groupBy("_id").agg(F.max("y").alias("y"))
    own = docs.select(F.col(id_col).alias("_id"), *(F.col(c).alias(a) for a, c in text_cols.items()))
    return own.join(F.broadcast(marks), "_id").drop("_id")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (survives lost executors; ``session.release`` deletes it)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    keep_until_release(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark, rows: int):
    """Within, Arrow batches hold at most so many rows, which bounds a task's memory where rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_table(spark, columns: dict[str, pa.Array]) -> DataFrame:
    """A table from a few values that the driver holds."""
    return spark.createDataFrame(pa.table(columns))


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, as a number."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class WordHashes(dict):
    """word -> unsigned 64-bit hash, remembered; forgets everything at ``limit`` words."""

    def __init__(self, limit: int = 50_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_WORDS = WordHashes()


def words(text: str | None) -> list[str]:
    """Lower-case runs of word characters of the whole text."""
    return WORD.findall(text.lower()) if text else []


def word_hashes(text: str | None) -> np.ndarray:
    return _WORDS.of(words(text))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers (xor-shift-multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(w: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash for every run of ``k`` word hashes; fewer words than ``k`` make one shingle."""
    n = len(w)
    if n == 0:
        return w
    k = min(k, n)
    acc = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + w[i : n - k + 1 + i]
    return mix64(acc)


def text_shingles(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Shingle hashes of a text in order. Text without a word character is one shingle as a whole; empty text has none."""
    w = word_hashes(text)
    if len(w) == 0 and text and text.strip():
        return np.array([xxhash.xxh3_64_intdigest(text.strip().encode("utf-8", "surrogatepass"), seed=1)], np.uint64)
    return shingle_hashes(w, k)


def letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def letter_line(text: str | None) -> np.ndarray:
    """Code points of the lower-case text with every run of other signs as one space, padded by spaces.

    A text without a letter gives an empty array.
    """
    if not text:
        return np.empty(0, np.int64)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[cp]
    if not is_letter.any():
        return np.empty(0, np.int64)
    x = np.full(len(cp) + 2, 32, np.int64)
    np.copyto(x[1:-1], cp, where=is_letter, casting="unsafe")
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    return x[keep]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def each_text(series: pd.Series):
    """Texts of a batch, None for null."""
    for t in series:
        yield t if isinstance(t, str) else None
