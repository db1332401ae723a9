"""Character shingles of paragraphs: rows, per-paragraph sets, vocabulary.

Shingling is a per-row projection (no shuffle); duplicates inside one paragraph
are removed within the row itself, so set construction needs
no shuffle either. Windows are cut a batch of texts at a time (``operators/windows.py``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.text import INCLUDE_LAST, SHINGLE_LEN
from sparkmine.operators import windows
from sparkmine.operators.blocks import small_batches
from sparkmine.operators.numbering import numbered
from sparkmine.operators.skew import hot_keys, salted_join
from sparkmine.session import materialize
from sparkmine.sources.tables import spread

BLOCK_SHINGLES = 1_000_000  # of the sets that share a list of different shingles
BLOCK_POINTS = 6_000_000  # bytes of the texts that share one


def long_enough(docs: DataFrame, id_col: str = "id", text_col: str = "para", n: int = SHINGLE_LEN, include_last: bool = INCLUDE_LAST) -> DataFrame:
    """``(id, _t)`` of the texts that have at least one shingle, told by their length alone."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t"))
    return spread(own.where(F.length("_t") >= n + (0 if include_last else 1)))


def shingle_rows(docs: DataFrame, id_col: str = "id", text_col: str = "para", n: int = SHINGLE_LEN,
                 include_last: bool = INCLUDE_LAST) -> DataFrame:
    """``(id, off, shingle)``: every window with its 0-based offset (repeats kept)."""
    return windows.window_rows(long_enough(docs, id_col, text_col, n, include_last), n, include_last)


def shingle_sets(docs: DataFrame, id_col: str = "id", text_col: str = "para", n: int = SHINGLE_LEN,
                 include_last: bool = INCLUDE_LAST) -> DataFrame:
    """One row per paragraph: ``(id, n_shingles, shingles array (distinct, first-seen order), size, h1, h2)``.

    ``h1``/``h2`` are two independent order-free fingerprints of the set; equal
    ``(size, h1, h2)`` marks identical sets. Paragraphs without a shingle are dropped.
    """
    return windows.set_rows(long_enough(docs, id_col, text_col, n, include_last), n, include_last)


def token_sets(sets: DataFrame) -> DataFrame:
    """``(id, size, h1, h2, tokens)`` with ``tokens`` the sorted 64-bit ids (xxhash64)
    of the distinct shingles: joins and intersections then run on longs.

    Two different shingles share an id with probability about ``V^2 / 2^65`` for a
    vocabulary of ``V`` shingles (1e-7 at 1.6 M shingles).
    """
    return sets.select("id", "size", "h1", "h2", F.sort_array(F.transform("shingles", lambda s: F.xxhash64(s))).alias("tokens"))


def text_tokens(docs: DataFrame, id_col: str = "id", text_col: str = "para", n: int = SHINGLE_LEN,
                include_last: bool = INCLUDE_LAST) -> DataFrame:
    """The rows of ``token_sets`` straight from the texts, with tokens and fingerprints of their own (``operators/windows.py``)."""
    return windows.token_rows(long_enough(docs, id_col, text_col, n, include_last), n, include_last)


def vocabulary(sets: DataFrame) -> DataFrame:
    """``(shingle, n_docs)``: document frequency; partial aggregation collapses common shingles."""
    return sets.select(F.explode_outer("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n_docs"))


def vocabulary_size(sets: DataFrame) -> DataFrame:
    """One row ``(n_shingles)``: how many different shingles there are."""
    return vocabulary(sets).agg(F.count(F.lit(1)).alias("n_shingles"))


def set_rows(sets: DataFrame) -> DataFrame:
    """``(id, shingle)``: one row per distinct shingle of each paragraph."""
    return sets.select("id", F.explode_outer("shingles").alias("shingle"))


def first_offsets(rows: DataFrame) -> DataFrame:
    """``(id, shingle, off)`` with the first offset of each shingle in each paragraph."""
    return rows.groupBy("id", "shingle").agg(F.min("off").alias("off"))


def shingle_ids(vocab: DataFrame) -> DataFrame:
    """``(shingle, sid)``: numbers 0 .. V-1 of the vocabulary in the order of its shingles, without a gap."""
    return numbered(vocab.select("shingle"), "shingle", "sid")


def coded_blocks(sets: DataFrame) -> DataFrame:
    """``(block, id, codes, shingles)``: sets of some ``BLOCK_SHINGLES`` shingles together, each as places in the block's list of different
    shingles, and a row without id for that list. Which sets share a block is settled by the task that reads them."""

    def code(batches):
        no, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block():
            column = pa.concat_arrays([b.column("shingles") for b in held])
            cuts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())])
            told = column.flatten().dictionary_encode()
            codes = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), told.indices.fill_null(-1))
            ids, every = pa.concat_arrays([b.column("id") for b in held]), pa.array([None], pa.list_(pa.int32()))
            listed = pa.ListArray.from_arrays(pa.array([0, len(told.dictionary)], pa.int32()), told.dictionary)
            names = ("block", "id", "codes", "shingles")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), no)), ids, codes, pa.nulls(len(ids), listed.type)], names)
            yield pa.RecordBatch.from_arrays([pa.array([no]), pa.nulls(1, ids.type), every, listed], names)

        for b in batches:
            held.append(b)
            size += len(b.column("shingles").flatten())
            if size >= BLOCK_SHINGLES:
                yield from block()
                no, held, size = no + 1, [], 0
        if held:
            yield from block()

    return sets.select("id", "shingles").mapInArrow(code, f"block long, id {dict(sets.dtypes)['id']}, codes array<int>, shingles array<string>")


def text_blocks(docs: DataFrame, id_col: str = "id", text_col: str = "para", points: int | None = None, n: int = SHINGLE_LEN, include_last: bool = INCLUDE_LAST) -> DataFrame:
    """``(block, id, _t)``: the texts that have a shingle, as they are read, in blocks of some ``points`` (``BLOCK_POINTS``) bytes."""
    most = BLOCK_POINTS if points is None else points

    def number(batches):
        no, load = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            ends = np.cumsum(windows.text_lengths(b.column("_t"))) + load
            nos = no + np.concatenate([[load], ends[:-1]]) // most
            yield pa.RecordBatch.from_arrays([pa.array(nos.astype(np.int64)), b.column("id"), b.column("_t")], ("block", "id", "_t"))
            no, load = no + int(ends[-1] // most), int(ends[-1] % most)

    own = long_enough(docs, id_col, text_col, n, include_last)
    return own.mapInArrow(number, f"block long, id {dict(own.dtypes)['id']}, _t string")


def _coded(texts: pa.Array, n: int, include_last: bool):
    """``(row, codes, different shingles)`` of the windows of some texts at a time: whose they are, as places among the different ones."""
    for lo, hi in windows.pieces(windows.text_lengths(texts)):
        counts, every = windows.shingle_strings(texts.slice(lo, hi - lo), n, include_last)
        told = every.dictionary_encode()
        yield np.repeat(np.arange(lo, hi), counts), told.indices.to_numpy(), told.dictionary


def _text_vectors(texts: DataFrame, ids: DataFrame, n: int, include_last: bool) -> DataFrame:
    """``id_vectors`` of the shingles of ``texts`` ``(id, para)``."""
    stored = materialize(text_blocks(texts, n=n, include_last=include_last), "text-blocks")

    def different(batches):
        now, seen = None, pa.array([], pa.string())
        for b in batches:
            blocks = b.column("block").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]]))
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if blocks[lo] != now:
                    now, seen = blocks[lo], pa.array([], pa.string())
                for _, _, told in _coded(b.column("_t").slice(lo, hi - lo), n, include_last):
                    new = told.filter(pc.invert(pc.is_in(told, value_set=seen)))
                    seen = pa.concat_arrays([seen, new])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(new), now)), new], ("block", "shingle"))

    # a shingle has a row for each block (two if tasks share it), so no key has more rows than there are blocks
    met = stored.mapInArrow(different, "block long, shingle string").join(ids.select("shingle", "sid"), "shingle")
    met = met.select("block", "shingle", F.col("sid").cast("long").alias("sid"))

    def number(own: pa.Table, told: pa.Table) -> pa.Table:
        names, sid = told.column("shingle").combine_chunks(), told.column("sid").to_numpy()
        whose, found = [], []
        for row, codes, every in _coded(own.column("_t").combine_chunks(), n, include_last):
            at = pc.index_in(every, value_set=names)
            sids = np.where(np.asarray(at.is_valid()), sid[at.fill_null(0).to_numpy()] if len(sid) else -1, -1)[codes]
            row, sids = row[sids >= 0], sids[sids >= 0]
            order = np.lexsort((sids, row))
            row, sids = row[order], sids[order]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (sids[1:] != sids[:-1])
            whose.append(row[first])
            found.append(sids[first])
        size = np.bincount(np.concatenate(whose), minlength=own.num_rows)
        vectors = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.concatenate(found)))
        return pa.table({"id": own.column("id"), "size": pa.array(size, pa.int32()), "sids": vectors}).filter(pa.array(size > 0))

    docs = stored.select(F.col("block").alias("of"), "id", "_t")
    return docs.groupBy("of").cogroup(met.groupBy("block")).applyInArrow(number, f"id {dict(docs.dtypes)['id']}, size int, sids array<long>")


def id_vectors(sets: DataFrame, ids: DataFrame, texts: DataFrame | None = None, n: int = SHINGLE_LEN, include_last: bool = INCLUDE_LAST) -> DataFrame:
    """``(id, size, sids)``: each paragraph's binary vector as the ascending numbers of its shingles, a row for each row of ``sets``.

    Only the different shingles of a block of sets meet their numbers; the sets themselves move once, as places in their block's list.
    A shingle of very many blocks meets its one number in tiles. With ``texts`` ``(id, para)``, whose ``shingle_sets`` are ``sets``, sets are
    formed again from the texts and only these are stored and moved, a small part of the sets.
    """
    if texts is not None:
        return _text_vectors(texts, ids, n, include_last)
    kind = dict(sets.dtypes)["id"]
    with small_batches(sets.sparkSession, 256):
        stored = materialize(coded_blocks(sets), "coded")
    rows = stored.where("shingles IS NOT NULL").select("block", F.posexplode("shingles").alias("place", "shingle"))
    met = salted_join(rows, ids.select("shingle", "sid"), ["shingle"], hot_keys(rows, ["shingle"], ids)).select("block", "place", F.col("sid").cast("long").alias("sid"))

    def number(own: pa.Table, told: pa.Table) -> pa.Table:
        place, sid = (told.column(c).to_numpy() for c in ("place", "sid"))
        codes = own.column("codes").combine_chunks()
        lengths, flat = pc.list_value_length(codes).to_numpy(), codes.flatten().to_numpy()
        table = np.full(max(flat.max(initial=-1), place.max(initial=-1)) + 2, -1, np.int64)  # the last is for no shingle
        table[place] = sid
        row, found = np.repeat(np.arange(len(lengths)), lengths), table[flat]
        row, found = row[found >= 0], found[found >= 0]
        found = found[np.lexsort((found, row))]
        size = np.bincount(row, minlength=len(lengths))
        sids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(found))
        return pa.table({"id": own.column("id"), "size": pa.array(size, pa.int32()), "sids": sids}).filter(pa.array(size > 0))

    docs = stored.where("shingles IS NULL").select(F.col("block").alias("of"), "id", "codes")
    return docs.groupBy("of").cogroup(met.groupBy("block")).applyInArrow(number, f"id {kind}, size int, sids array<long>")
