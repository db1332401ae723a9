"""Numbering, block-counted candidates, bit signatures, the band index and the power iteration against plain Python."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.operators import blocks, clustering, lsh, shingles, similarity
from sparkmine.operators.numbering import numbered
from sparkmine.session import materialize


def token_rows(spark, sets):
    rows = [(i, len(s), hash(frozenset(s)) >> 1, 0, sorted(s)) for i, s in sets.items()]
    return spark.createDataFrame(rows, "id long, size int, h1 long, h2 long, tokens array<long>").repartition(7)


def some_sets(seed, n, pool=400):
    """Sets over few tokens, many of them edited copies of others, sizes from 1 to some hundred."""
    rnd, sets = random.Random(seed), []
    values = [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(pool)]
    for _ in range(n):
        if sets and rnd.random() < 0.5:
            s = set(rnd.choice(sets))
            for v in rnd.sample(values, min(len(s), rnd.randrange(12))):
                s ^= {v}
        else:
            s = set(rnd.sample(values, rnd.choice([1, 2, 5, 30, 90, 200])))
        sets.append(s or {values[0]})
    return {10 * i + 3: s for i, s in enumerate(sets)}


def test_numbers_have_no_gap(spark):
    for n in (0, 1, 5000):
        df = spark.range(n).select((F.col("id") * 37 % 5003).alias("k"), F.lit("x").alias("other")).repartition(5)
        got = sorted((r.no, r.k) for r in numbered(df, "k").collect())
        assert got == list(enumerate(sorted(i * 37 % 5003 for i in range(n))))
    words = spark.createDataFrame([(w,) for w in ("b", "a", "é", "Z", "", "aa")], "shingle string")
    assert {r.shingle: r.sid for r in shingles.shingle_ids(words).collect()} == {w: i for i, w in enumerate(["", "Z", "a", "aa", "b", "é"])}


def test_vectors_over_numbers(spark):
    docs = spark.createDataFrame([(1, "abcdefgh"), (2, "abcdefgh"), (3, "xxxxxxxxxxxx"), (4, "abc"), (5, None), (6, "cdefghij")], "id long, para string")
    sets = shingles.shingle_sets(docs)
    ids = shingles.shingle_ids(shingles.vocabulary(sets))
    name = {r.sid: r.shingle for r in ids.collect()}
    assert sorted(name) == list(range(len(name)))
    got = {r.id: (r.size, [name[s] for s in r.sids]) for r in shingles.id_vectors(sets, ids).collect()}
    assert got == {1: (3, ["abcde", "bcdef", "cdefg"]), 2: (3, ["abcde", "bcdef", "cdefg"]), 3: (1, ["xxxxx"]), 6: (3, ["cdefg", "defgh", "efghi"])}


def test_bitmaps_bound_the_difference():
    rnd = random.Random(1)
    for _ in range(300):
        pool = [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(rnd.choice([3, 50, 3000]))]
        a, b = (set(rnd.sample(pool, rnd.randrange(1, len(pool) + 1))) for _ in "ab")
        x, y = (np.frombuffer(blocks.parity_bits(np.array(sorted(s), np.int64)), np.uint8) for s in (a, b))
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(blocks.folded(x, size) ^ blocks.folded(y, size)).sum())
        assert apart <= len(a ^ b) and apart % 2 == len(a ^ b) % 2
        assert a != b or apart == 0
    # and close to it, so that it tells unlike sets apart
    a, b = (np.array(random.Random(s).sample(range(1 << 62), 1000), np.int64) for s in (1, 2))
    x, y = (np.frombuffer(blocks.parity_bits(s), np.uint8) for s in (a, b))
    assert np.bitwise_count(x ^ y).sum() > 1000


@pytest.mark.parametrize("distance", [0.2, 0.6, 0.9])
@pytest.mark.parametrize("small", [False, True])
def test_pairs_against_all_pairs(spark, monkeypatch, distance, small):
    if small:  # many blocks, pieces, tiles and steps
        for name, value in (("BLOCK", 4), ("PIECE", 8), ("MEETINGS", 50), ("Y_BLOCK", 16), ("LEAST_BITS", 64)):
            monkeypatch.setattr(blocks, name, value)
    sets = some_sets(3, 150)
    want = {}
    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        c = len(a & b)
        if c and (d := 1.0 - c / (len(a) + len(b) - c)) < distance:
            want[i, j] = d
    got = similarity.jaccard_pairs(token_rows(spark, sets), distance, tokenized=True).collect()
    assert {(r.idA, r.idB): r.distance for r in got} == want and len(got) == len(want)


def test_no_sets_no_pairs(spark):
    assert similarity.jaccard_pairs(token_rows(spark, {1: {5}}).limit(0), 0.6, tokenized=True).collect() == []
    assert similarity.jaccard_pairs(token_rows(spark, {1: {5}}), 0.6, tokenized=True).collect() == []


def batch(spark, rows):
    return shingles.shingle_sets(spark.createDataFrame(rows, "id long, para string")).select("id", "shingles")


def test_band_index_holds_new_batches_against_old_ones(spark, tmp_path):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abc ", k=60)) for _ in range(30)]
    rows = [(i, texts[i % 30][: 60 - i // 30] + "xy"[i % 2]) for i in range(90)]
    parts = [rows[:40], rows[40:70], rows[70:]]
    index = lsh.BandIndex(spark, "tested_bands", 12, 3, buckets=4, folder=str(tmp_path))
    assert index.probe(batch(spark, parts[0])).collect() == []
    got = set()
    for part in parts:
        own = batch(spark, part)
        if index.batches:
            plan = index.probe(own)._jdf.queryExecution().executedPlan().toString()
            # each stored table is scanned without being dealt out: every exchange is of the new batch or the distinct
            for scan in re.findall(r"(?:.*\n){0,4}.*FileScan parquet.*tested_bands.*", plan):
                assert "hashpartitioning(band" not in scan
        got |= {(r.old, r.new) for r in index.probe(own).collect()}
        index.add(own)
    everything = lsh.bands(lsh.signatures(batch(spark, rows), 12), 3)
    other = everything.select(F.col("id").alias("new"), "band", "key")
    joined = {(r.id, r.new) for r in everything.join(other, ["band", "key"]).select("id", "new").distinct().collect()}
    which = {i: p for p, part in enumerate(parts) for i, _ in part}
    assert got == {(a, b) for a, b in joined if which[a] < which[b]} and len(got) > 30
    index.drop()


def test_signatures_agree_as_often_as_sets(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choices("abcdefgh ", k=700))
    got = {r.id: r.hashes for r in lsh.signatures(batch(spark, [(1, text), (2, text[:450] + text[:250][::-1]), (3, text)]), 400).collect()}
    a, b = ({t[i : i + 5] for i in range(len(t) - 5)} for t in (text, text[:450] + text[:250][::-1]))
    agree = np.mean([x == y for x, y in zip(got[1], got[2], strict=True)])
    assert got[1] == got[3] and abs(agree - len(a & b) / len(a | b)) < 0.08


def plain_power(pairs, members, rounds):
    """Paragraph by paragraph, every pair of copies an edge, in whole numbers."""
    one, mean = clustering.WEIGHT_ONE, clustering.MEAN_ONE
    by = {}
    for i, rep in members:
        by.setdefault(rep, []).append(i)
    near = {i: {} for i, _ in members}
    for own in by.values():
        for a, b in itertools.permutations(own, 2):
            near[a][b] = one
    for a, b, d in pairs:
        for x, y in itertools.product(by[a], by[b]):
            near[x][y] = near[y][x] = round((1.0 - d) * one)
    near = {i: n for i, n in near.items() if n}
    degree = {i: sum(n.values()) for i, n in near.items()}
    scaled = lambda u: {i: x * mean * len(u) // sum(u.values()) for i, x in u.items()}
    v = scaled(degree)
    for _ in range(rounds):
        v = scaled({i: sum(w * v[j] for j, w in n.items()) // degree[i] for i, n in near.items()})
    return v


def test_power_iteration_on_contracted_copies(spark):
    rnd = random.Random(6)
    members = [(i, rep) for rep in range(0, 300, 10) for i in range(rep, rep + rnd.choice([1, 1, 2, 5]))]
    pairs = [(a, b, rnd.choice([0.1, 0.25, 0.5])) for a, b in itertools.combinations(range(0, 300, 10), 2) if (a < 150) == (b < 150) and rnd.random() < 0.3]
    p, m = spark.createDataFrame(pairs, "idA long, idB long, distance double"), spark.createDataFrame(members, "id long, rep long")
    for rounds in (0, 1, 10):
        want = plain_power(pairs, members, rounds)
        values = clustering.power_iteration(*clustering.weighted_graph(p, m), rounds)
        assert {i: v for i, v in want.items() if i % 10 == 0} == {r.node: r.v for r in values.collect()}
    got = {r.id: r.cluster for r in clustering.power_clusters(p, m).collect()}
    x = sorted(v // 1000 for v in want.values())
    spread = lambda s: sum((y - sum(s) / len(s)) ** 2 for y in s)
    cut = min((spread(x[:k]) + spread(x[k:]), x[k - 1]) for k in range(1, len(x)) if x[k - 1] < x[k])[1]
    assert got == {i: int(v // 1000 > cut) for i, v in want.items()}
    assert set(Counter(r.cluster for r in clustering.power_clusters(p, m, k=3).collect())) == {0, 1, 2}


def test_power_iteration_without_links(spark):
    p = spark.createDataFrame([], "idA long, idB long, distance double")
    alone = spark.createDataFrame([(1, 1), (2, 2)], "id long, rep long")
    assert clustering.power_clusters(p, alone).collect() == []
    copies = materialize(spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "id long, rep long"), "copies")
    assert {(r.id, r.cluster) for r in clustering.power_clusters(p, copies).collect()} == {(1, 0), (2, 0)}


def test_vectors_move_different_shingles_of_a_block_only(spark):
    """every shingle of every paragraph was a row of the join."""
    words = [f"w{k:03d}" for k in range(50)]
    rows = [(i, words[i % 7 :: 1 + i % 3]) for i in range(200)] + [(900, []), (901, None), (902, ["other"])]
    sets = spark.createDataFrame(rows, "id long, shingles array<string>").coalesce(2)
    ids = spark.createDataFrame([(w, 49 - k) for k, w in enumerate(words)], "shingle string, sid long")
    assert sum(len(r.shingles) for r in shingles.coded_blocks(sets).collect() if r.shingles is not None) <= 2 * 51
    got = {r.id: (r.size, list(r.sids)) for r in shingles.id_vectors(sets, ids).collect()}
    assert got == {i: (len(w), sorted(49 - words.index(x) for x in w)) for i, w in rows if w and i != 902}
