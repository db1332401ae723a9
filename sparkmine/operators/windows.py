"""Character shingles of a batch of texts in numpy: as strings, and as sets of 64-bit tokens.

Texts are cut into windows where they are read: a set of shingles is many times its text, so nothing here is
stored or moved, and whoever needs the sets again forms them again from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmine.functions.text import INCLUDE_LAST, SHINGLE_LEN

WINDOWS = 500_000  # that are formed at once, if no single text has more
_PLAIN, _BITS = 1 << 12, 12  # five code points below 2**12 fit one number


def mixed(z: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the last steps of splitmix64)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def pieces(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges ``(lo, hi)`` with some ``WINDOWS`` code points each."""
    ends, lo = np.cumsum(lengths), 0
    while lo < len(lengths):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + WINDOWS, "right")))
        yield lo, hi
        lo = hi


def _counts(lengths: np.ndarray, n: int, include_last: bool) -> np.ndarray:
    return np.maximum(lengths - n + (1 if include_last else 0), 0)


def shingle_tokens(texts: list[str], n: int = SHINGLE_LEN, include_last: bool = INCLUDE_LAST) -> list[np.ndarray]:
    """The ascending, distinct 64-bit tokens of each text's shingles.

    Shingles of up to five code points below 4096 have tokens of their own; others are hashed.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    m = max(len(points) - n + 1, 0)
    z = np.zeros(m, np.uint64)
    for k in range(n):
        z = (z << np.uint64(_BITS)) ^ points[k : k + m]
    z = mixed(z)
    if n > 5 or (len(points) and points.max() >= _PLAIN):
        folded, wide = np.zeros(m, np.uint64), np.full(m, n > 5)
        for k in range(n):
            folded = mixed(folded * np.uint64(0x9E3779B97F4A7C15) + points[k : k + m] + np.uint64(1))
            wide |= points[k : k + m] >= _PLAIN
        z = np.where(wide, folded, z)
    z, out = z.view(np.int64), []
    for at, count in zip((np.cumsum(lengths) - lengths).tolist(), _counts(lengths, n, include_last).tolist(), strict=True):
        own = np.sort(z[at : at + count])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if count else own)
    return out


def shingle_strings(texts: pa.Array, n: int = SHINGLE_LEN, include_last: bool = INCLUDE_LAST) -> tuple[np.ndarray, pa.StringArray]:
    """How many shingles each text has, and all of them in order."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = np.flatnonzero((data & 0xC0) != 0x80)  # of code points
    firsts = np.searchsorted(starts, offsets - offsets[0])
    counts = _counts(np.diff(firsts), n, include_last)
    w = np.repeat(firsts[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    starts = np.append(starts, len(data))
    begin, size = starts[w], starts[w + n] - starts[w]
    ends = np.concatenate([[0], np.cumsum(size)])
    if ends[-1] == n * len(w):
        flat = np.lib.stride_tricks.sliding_window_view(data, n)[begin].ravel() if len(w) else data[:0]
    else:
        flat = data[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
    return counts, pa.StringArray.from_buffers(len(w), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat)))


def text_lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text."""
    return np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]).astype(np.int64)


def window_rows(texts: DataFrame, n: int, include_last: bool) -> DataFrame:
    """``(id, off, shingle)`` of ``(id, _t)``, no text null."""

    def rows(batches):
        for b in batches:
            for lo, hi in pieces(text_lengths(b.column("_t"))):
                counts, shingles = shingle_strings(b.column("_t").slice(lo, hi - lo), n, include_last)
                off = np.arange(len(shingles), dtype=np.int32) - np.repeat(np.cumsum(counts) - counts, counts).astype(np.int32)
                ids = b.column("id").slice(lo, hi - lo).take(pa.array(np.repeat(np.arange(hi - lo), counts)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(off, pa.int32()), shingles], ("id", "off", "shingle"))

    return texts.select("id", "_t").mapInArrow(rows, f"id {dict(texts.dtypes)['id']}, off int, shingle string")


def fingerprints(flat: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """Two order-free 64-bit fingerprints of each set of tokens (none empty)."""
    z = flat.view(np.uint64)
    return [np.add.reduceat(mixed(z ^ np.uint64(seed)), cuts[:-1]).view(np.int64) for seed in (0x243F6A8885A308D3, 0x13198A2E03707344)]


def token_rows(texts: DataFrame, n: int, include_last: bool) -> DataFrame:
    """``(id, size, h1, h2, tokens)`` of ``(id, _t)``, every text with a shingle at least."""

    def rows(batches):
        for b in batches:
            for lo, hi in pieces(text_lengths(b.column("_t"))):
                sets = shingle_tokens(b.column("_t").slice(lo, hi - lo).to_pylist(), n, include_last)
                size = np.array([len(s) for s in sets], np.int32)
                cuts, flat = np.concatenate([[0], np.cumsum(size)]), np.concatenate(sets)
                columns = [b.column("id").slice(lo, hi - lo), pa.array(size), *(pa.array(h) for h in fingerprints(flat, cuts))]
                tokens = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*columns, tokens], ("id", "size", "h1", "h2", "tokens"))

    return texts.select("id", "_t").mapInArrow(rows, f"id {dict(texts.dtypes)['id']}, size int, h1 long, h2 long, tokens array<long>")


def set_rows(texts: DataFrame, n: int, include_last: bool) -> DataFrame:
    """``(id, n_shingles, shingles, size, h1, h2)`` of ``(id, _t)``, shingles in the order in which they are first seen."""

    def rows(batches):
        for b in batches:
            for lo, hi in pieces(text_lengths(b.column("_t"))):
                own = b.column("_t").slice(lo, hi - lo)
                counts, every = shingle_strings(own, n, include_last)
                at = np.cumsum(counts) - counts
                sets = [every.slice(k, c).unique() for k, c in zip(at.tolist(), counts.tolist(), strict=True)]
                tokens = shingle_tokens(own.to_pylist(), n, include_last)
                h1, h2 = fingerprints(np.concatenate(tokens), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]))
                cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                columns = [pa.array(counts, pa.int32()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.concat_arrays(sets)), pa.array(np.diff(cuts), pa.int32())]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), *columns, pa.array(h1), pa.array(h2)], ("id", "n_shingles", "shingles", "size", "h1", "h2"))

    return texts.select("id", "_t").mapInArrow(rows, f"id {dict(texts.dtypes)['id']}, n_shingles int, shingles array<string>, size int, h1 long, h2 long")
