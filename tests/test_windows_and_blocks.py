"""Shingles cut in numpy, and what the similarity joins store."""

import hashlib
import math
import os
import random

import numpy as np
import pyarrow as pa
from conftest import SMALL

from sparkmine.operators import blocks, lsh, shingles, similarity, windows
from sparkmine.session import ensure_checkpoint_dir

TEXTS = ["abcdef", "aaaaaaaaaa", "été à la mer, été", "漢字かな交じり文です", "x\U0001f600y\U0001f601zabc\n\t", "ab cdefgh"]


def plain(t, n=5, last=False):
    return [t[i : i + n] for i in range(max(len(t) - n + last, 0))]


def test_windows_against_slices(spark):
    for n, last in ((5, False), (3, True), (8, False)):
        counts, got = windows.shingle_strings(pa.array(["none", *TEXTS, "none"]).slice(1, len(TEXTS)), n, last)
        assert got.to_pylist() == [s for t in TEXTS for s in plain(t, n, last)] and counts.tolist() == [len(plain(t, n, last)) for t in TEXTS]
        tokens = windows.shingle_tokens(TEXTS, n, last)
        every = {}
        for t, own in zip(TEXTS, tokens, strict=True):
            assert len(own) == len(set(plain(t, n, last))) and (own[1:] > own[:-1]).all()
            every.update(dict.fromkeys(plain(t, n, last)))
        assert len(set(np.concatenate(tokens).tolist())) == len(every)
    docs = spark.createDataFrame([*enumerate(TEXTS), (90, None), (91, ""), (92, "abcde")], "id long, para string")
    rows = {(r.id, r.off): r.shingle for r in shingles.shingle_rows(docs).collect()}
    assert rows == {(i, k): s for i, t in enumerate(TEXTS) for k, s in enumerate(plain(t))}
    sets = {r.id: (r.n_shingles, list(r.shingles), r.size) for r in shingles.shingle_sets(docs).collect()}
    assert sets == {i: (len(plain(t)), list(dict.fromkeys(plain(t))), len(set(plain(t)))) for i, t in enumerate(TEXTS) if plain(t)}


def bytes_below(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_joins_of_texts_store_less_than_the_texts(spark):
    """F1-F12: token sets alone were several times the input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id AS id", "text AS para")
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    size = os.path.getsize(f"{SMALL}/documents.parquet")
    sets = shingles.shingle_sets(docs)
    for d in (0.2, 0.6):
        want = {(r.idA, r.idB): r.distance for r in similarity.jaccard_pairs(sets, d).collect()}
        before = bytes_below(shared)
        got = {(r.idA, r.idB): r.distance for r in similarity.text_jaccard_pairs(docs, d).collect()}
        assert got == want and bytes_below(shared) - before < size
    assert {r.idA for r in similarity.text_closest_pairs(docs, 3).collect()} <= {a for a, _ in want}


def test_agreements_lose_one_pair_in_a_million():
    for s, n in ((0.8, 24), (0.4, 25), (0.95, 24)):
        k = similarity.least_agreements(s, n)
        below = lambda k: sum(math.comb(n, i) * s**i * (1 - s) ** (n - i) for i in range(k))  # noqa: E731, B023
        assert below(k) <= 1e-6 < below(k + 1)


def test_wide_copies_and_edits_of_one_text(spark):
    """Copies spread over many tasks, and edits just inside and outside of the bound."""
    rnd = random.Random(5)
    text = "".join(rnd.choices("abcdefgh ", k=3000))
    rows = [(k, text) for k in range(40)] + [(100 + k, text[: 3000 - 100 * k] + "".join(rnd.choices("xyz", k=100 * k))) for k in range(1, 20)]
    docs = spark.createDataFrame(rows, "id long, para string").repartition(7)
    sets = {i: set(plain(t)) for i, t in rows}
    want = {}
    for a in sets:
        for b in sets:
            if a < b and (n := len(sets[a] & sets[b])) and (d := 1.0 - n / len(sets[a] | sets[b])) < 0.6:
                want[a, b] = d
    assert {(r.idA, r.idB): r.distance for r in similarity.text_jaccard_pairs(docs, 0.6).collect()} == want


def test_signatures_of_texts_move_no_sets(spark):
    """from the texts, each different shingle of a batch hashed once; an empty set has no value."""
    rnd = random.Random(8)
    rows = [*enumerate(TEXTS), *((100 + k, "".join(rnd.choices("abc ", k=300))) for k in range(20)), (200, "abc"), (201, None)]
    docs = spark.createDataFrame(rows, "id long, para string")
    want = {}
    for i, t in rows:
        x = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) for s in plain(t or "")]
        if x:
            want[i] = [min(((v + 1) * a + b) % lsh.PRIME for v in x) for a, b in lsh.coefficients(7)]
    signed = lsh.text_signatures(docs, 7)
    assert {r.id: r.hashes for r in signed.collect()} == want
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and "transform(" not in plan
    sets = spark.createDataFrame([(1, ["ab", "cd"]), (2, []), (3, None), (4, ["cd"])], "id long, shingles array<string>").coalesce(1)
    got = {r.id: r.hashes for r in lsh.signatures(sets, 3).collect()}
    assert got[2] == got[3] == [None] * 3 and all(a <= b for a, b in zip(got[1], got[4], strict=True))


def test_one_python_worker_signs_texts_and_blocks_are_bounded(spark, monkeypatch):
    """F2-F5, F11: two workers a task and blocks of wide bitmaps filled an executor."""
    rnd = random.Random(9)
    rows = [(k, "".join(rnd.choices("abcdefgh ", k=40 * k + 6))) for k in range(60)]
    texts = shingles.long_enough(spark.createDataFrame(rows, "id long, para string"))
    signed = blocks.text_bit_rows(texts, 4.0)
    want = blocks.bit_rows(windows.token_rows(texts, 5, False), 4.0)
    assert sorted(map(tuple, signed.collect())) == sorted(map(tuple, want.collect()))
    assert signed._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4096)
    made = blocks.packed(signed).collect()
    assert sum(len(b.ids) for b in made) == 60 and any(len(b.ids) == 1 for b in made)
    assert all(len(b.ids) == 1 or len(b.bits) <= 4096 for b in made)


def test_tiles_grow_with_the_sets_of_many_pairs():
    """A group of n similar texts has n * n / 2 pairs; each text went to some n / 45 tiles."""
    assert blocks.tile_side(4_200_000, 12_800) == 13
    assert blocks.tile_side(30_000, 20_000) == 3 and blocks.tile_side(0, 0) == 1
