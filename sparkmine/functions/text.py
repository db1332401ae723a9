"""Column expressions for paragraph text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the original job: 5-character shingles, the last window left out.
SHINGLE_LEN = 5
INCLUDE_LAST = False


def shingle_array(text: Column | str, n: int = SHINGLE_LEN, include_last: bool = INCLUDE_LAST) -> Column:
    """All length-``n`` character windows of ``text`` in order (offset = index).

    One linear regex pass with a capturing lookahead (``substring`` by
    character index would rescan the UTF-8 string for every offset). With
    ``include_last=False`` the final window is dropped, so a text of length L
    gives ``max(0, L - n)`` shingles.
    """
    t = F.col(text) if isinstance(text, str) else text
    arr = F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    if include_last:
        return arr
    return F.slice(arr, 1, F.greatest(F.size(arr) - 1, F.lit(0)))


def set_fingerprints(arr: Column) -> tuple[Column, Column]:
    """Two independent fingerprints of a set given as a distinct array: 64-bit
    xxhash64 and 32-bit murmur3 of the sorted array (built-in, code-generated)."""
    srt = F.sort_array(arr)
    return F.xxhash64(srt), F.hash(srt).cast("bigint")
