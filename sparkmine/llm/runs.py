"""Periodic runs of words: stretches that repeat themselves at least three times, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least
max(``least``, 3 q) words that no neighbouring word extends. Texts of a batch become one row of
numbers, each text closed by a number of its own, so nothing reaches across texts. Names of all stretches of
1, 2, 4, ... words, made by doubling, end in the suffix array; a wavelet matrix over it answers "where does this block
occur next, from there on". Blocks of 2^k words that start at multiples of 2^k (dyadic blocks) ask for their
occurrences in the window up to twice their size ahead. Occurrences less than half a block apart are a progression,
whose ends follow from the block's own period; distances between occurrences, and between
the first and last ones of progressions, are candidate periods. A candidate counts if the stretch around it, found from the
names, is long enough.

Every run is found: with n >= max(24, 3 q) words it holds, a period before its end, a whole dyadic block of the largest
2^k <= max(q, 8) words, and that block occurs again q words on. A block within a shorter period p
lies in a stretch of period p whose start or end repeats q words on, so two progressions differ by q there.

Texts in which no 16 words occur twice have no run (of its n words, n - q >= 16 occur again q words on), so only
the others are searched.

Defined results: null and empty texts have no word and no run; rows that repeat an id each get a row; empty tables give no
rows. Whole texts count. A text is searched in one task, with some 100 bytes a word.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import mix64

LEAST, TIMES = 24, 3
FIRST_LEVEL = 3  # blocks of eight words and more
GRAM = 16
WORDS_AT_ONCE = 150_000  # words of the texts that are searched together (one text more may follow)
RUNS = "array<struct<start: long, length: long, period: long>>"


class WaveletMatrix:
    """Ranks and order statistics of ranges of an array of numbers below ``top``, for arrays of queries."""

    def __init__(self, values: np.ndarray, top: int):
        self.bits = max(1, int(top - 1).bit_length())
        self.zeros, self.before = [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b & 1).astype(bool)
            self.before.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))  # zeros before each place
            self.zeros.append(int(self.before[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range are less than ``x``."""
        count = np.zeros(len(x), np.int64)
        for d in range(self.bits):
            one = (x >> (self.bits - 1 - d) & 1).astype(bool)
            l0, h0 = self.before[d][lo], self.before[d][hi]
            count += np.where(one, h0 - l0, 0)
            lo, hi = np.where(one, lo - l0 + self.zeros[d], l0), np.where(one, hi - h0 + self.zeros[d], h0)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value with ``n`` smaller ones in each range."""
        out = np.zeros(len(n), np.int64)
        for d in range(self.bits):
            l0, h0 = self.before[d][lo], self.before[d][hi]
            one = n >= h0 - l0
            n = np.where(one, n - (h0 - l0), n)
            out = out * 2 + one
            lo, hi = np.where(one, lo - l0 + self.zeros[d], l0), np.where(one, hi - h0 + self.zeros[d], h0)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """The least value of each range that is ``x`` or more, else ``none``."""
        n = self.below(lo, hi, x)
        out = np.full(len(x), none, np.int64)
        there = n < hi - lo
        out[there] = self.nth(lo[there], hi[there], n[there])
        return out


def stretch_names(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """-> for each k the names of the stretches of 2^k words from each place (equal iff the words are; a name is the
    place of the first equal one in suffix order), one place more for the end; and the suffix array."""
    n = len(x)
    order = np.argsort(x, kind="stable")
    names = [_named(order, x[order])]
    k = 0
    while True:
        now = names[-1]
        if len(np.unique(now[:n])) == n:
            break
        follow = np.full(n, -1, np.int64)
        follow[: max(0, n - (1 << k))] = now[1 << k : n]
        key = now[:n].astype(np.int64) * (n + 1) + follow + 1
        order = np.argsort(key, kind="stable")
        names.append(_named(order, key[order]))
        k += 1
    return names, order


def _named(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    first = np.concatenate([[True], key[1:] != key[:-1]])
    out = np.full(len(order) + 1, -1, np.int32)
    out[order] = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return out


def _ahead(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words agree from places i < j on."""
    i, j = i.copy(), j.copy()
    start = i.copy()
    for k in range(len(names) - 1, -1, -1):
        same = names[k][i] == names[k][j]
        i += same << k
        j += same << k
    return i - start


def _back(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words agree before places i < j."""
    i, j = i.copy(), j.copy()
    start = i.copy()
    for k in range(len(names) - 1, -1, -1):
        at, other = i - (1 << k), j - (1 << k)
        same = (at >= 0) & (names[k][np.maximum(at, 0)] == names[k][np.maximum(other, 0)])
        i -= same << k
        j -= same << k
    return start - i


def _candidates(names: list[np.ndarray], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs to be tried."""
    n = len(order)
    at, period = [], []

    def add(i, q):
        at.append(i)
        period.append(q)

    wavelet = None
    for k in range(FIRST_LEVEL, len(names)):
        m = 1 << k
        i = np.arange(0, n, m)
        count = np.bincount(names[k][:n], minlength=n)
        i = i[count[names[k][i]] > 1]
        if len(i) == 0:
            break
        wavelet = wavelet or WaveletMatrix(order.astype(np.int64), n)
        lo = names[k][i].astype(np.int64)
        hi, edge = lo + count[lo], i + 2 * m
        follow = wavelet.successor(lo, hi, i + 1, none=2 * n)
        keep = follow < edge
        i, lo, hi, edge, follow = i[keep], lo[keep], hi[keep], edge[keep], follow[keep]
        if len(i) == 0:
            continue
        step = follow - i
        add(i, step)
        # occurrences closer than half a block: a progression, cut off where its period ends
        dense = 2 * step <= m
        first, last = i.copy(), i.copy()
        first[dense] -= _back(names, i[dense], follow[dense]) // step[dense] * step[dense]
        last[dense] += (_ahead(names, i[dense], follow[dense]) + step[dense] - m) // step[dense] * step[dense]
        seen = last.copy()
        while len(i):
            follow = wavelet.successor(lo, hi, seen + 1, none=2 * n)
            keep = follow < edge
            i, lo, hi, edge, follow, step, dense, first, last = (a[keep] for a in (i, lo, hi, edge, follow, step, dense, first, last))
            end = follow.copy()
            if dense.any():
                more = follow[dense]
                end[dense] += (_ahead(names, more, np.minimum(more + step[dense], n)) + step[dense] - m) // step[dense] * step[dense]
            add(i, follow - first)
            add(i, end - last)
            seen = end
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(at), np.concatenate(period)


def maximal_runs(x: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a row of numbers, by start and period."""
    if len(x) < least:
        return []
    names, order = stretch_names(x)
    i, q = _candidates(names, order)
    i, q = np.unique(np.stack([i, q]), axis=1) if len(i) else (i, q)
    fits = (q > 0) & (i + q < len(x))
    i, q = i[fits], q[fits]
    start = i - _back(names, i, i + q)
    length = i + q + _ahead(names, i, i + q) - start
    good = length >= np.maximum(least, times * q)
    found = {}
    for s, n, p in sorted(zip(start[good].tolist(), length[good].tolist(), q[good].tolist(), strict=True)):
        found.setdefault((s, n), p)  # of one stretch the smallest period
    return sorted((s, n, p) for (s, n), p in found.items())


def repeats_itself(x: np.ndarray, text_of: np.ndarray, texts: int) -> np.ndarray:
    """For each text whether some ``GRAM`` words in a row occur twice in it."""
    n = len(x) - GRAM + 1
    out = np.zeros(texts, bool)
    if n <= 0:
        return out
    h = np.zeros(n, np.uint64)
    for j in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[j : j + n].astype(np.uint64)
    inside = text_of[:n] == text_of[GRAM - 1 :]
    own = text_of[:n][inside]
    key = mix64(mix64(h[inside]) + own.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    by = np.argsort(key)
    twice = key[by][1:] == key[by][:-1]
    out[own[by[1:][twice]]] = True
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    numbers: dict[bytes, int] = {}
    rows = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in t), np.int64, len(t)) for t in texts]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts:
        return found
    sizes = [len(r) for r in rows]
    repeats = np.flatnonzero(repeats_itself(np.concatenate(rows), np.repeat(np.arange(len(texts)), sizes), len(texts)))
    if len(repeats) == 0:
        return found
    # each text is closed by a number that occurs nowhere else
    closed = np.concatenate([np.append(rows[t], len(numbers) + k) for k, t in enumerate(repeats)])
    begins = np.concatenate([[0], np.cumsum([sizes[t] + 1 for t in repeats])])
    for s, n, p in maximal_runs(closed):
        k = int(np.searchsorted(begins, s, "right")) - 1
        found[repeats[k]].append((s - int(begins[k]), n, p))
    return found


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, n, p in runs:
        keep[s + p : s + n] = False
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The words, and for a tenth of the ids the words with a period from some word on."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edited=None) -> DataFrame:
    """(id, n_words long, runs array<struct<start, length, period>>, text string): every text's runs, and its
    kept words joined by one blank. ``edited`` (id, words) -> words may change the words first."""

    def searched(batches):
        held, size = [], 0  # (id, words)
        for b in batches:
            for doc_id, data in zip(b.column(0), b.column(1), strict=True):
                i = doc_id.as_py()
                words = (data.as_py() or b"").split()  # ASCII white space
                held.append((i, edited(i, words) if edited else words))
                size += len(words) + 1
                if size >= WORDS_AT_ONCE:
                    yield _batch(held, kind)
                    held, size = [], 0
        if held:
            yield _batch(held, kind)

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    simple = own.schema["id"].dataType.simpleString()
    kind = pa.int64() if simple == "bigint" else pa.int32() if simple == "int" else pa.string()
    if kind == pa.string():
        own, simple = own.withColumn("id", F.col("id").cast("string")), "string"
    out = own.mapInArrow(searched, f"id {simple}, n_words long, runs {RUNS}, text string")
    return out.withColumnRenamed("id", id_col)


def _batch(held, kind) -> pa.RecordBatch:
    found = runs_of([w for _, w in held])
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in held], kind), pa.array([len(w) for _, w in held], pa.int64()),
            pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found], pa.list_(run)),
            pa.array([b" ".join(without_repeats(w, r)) for (_, w), r in zip(held, found, strict=True)], pa.binary()).cast(pa.string()),
        ],
        ("id", "n_words", "runs", "text"),
    )


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of the rows of ``periodic_runs``."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"] / r["period"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    told = found.withColumn("best", best)
    return told.select(
        id_col, F.array_size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )
