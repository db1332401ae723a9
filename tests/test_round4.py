"""What the similarity joins of the round deal out, against plain Python."""

import itertools
import random

from sparkmine.operators import blocks, lsh, shingles, similarity
from sparkmine.session import materialize


def grams(t):
    return {t[i : i + 5] for i in range(len(t) - 5)}


def near_and_unlike(rnd, groups=6, size=12):
    """Groups of near copies over one small vocabulary: members are alike, texts of two groups agree in half of their shingles."""
    words = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(14)]
    out = []
    for g in range(groups):
        own = rnd.choices(words, k=120)
        for k in range(size):
            out.append((len(out), " ".join([*own[:100], *(w if rnd.random() < 0.9 else rnd.choice(words) for w in own[100:]), f"x{g}", f"y{k}"])))
    return out


def test_pairs_that_agree_by_chance_deal_out_no_text(spark, monkeypatch):
    """every pair of a bucket had its texts dealt out, most of them unlike."""
    rows = near_and_unlike(random.Random(3))
    docs = spark.createDataFrame(rows, "id long, para string")
    met, plain = [], similarity.counted
    monkeypatch.setattr(similarity, "counted", lambda pairs, *a: met.append(pairs.count()) or plain(pairs, *a))
    monkeypatch.setattr(blocks, "SIFT_BYTES", 2000)  # several tiles
    got = {(r.idA, r.idB): r.distance for r in similarity.minhash_pairs(shingles.shingle_sets(docs), 0.2, 24, 1, texts=docs).collect()}
    sets = {i: grams(t) for i, t in rows}
    d = {(a, b): 1.0 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sets, 2)}
    assert got == {p: v for p, v in d.items() if v < 0.2} and len(got) > 200
    assert sum(0.2 <= v < 0.7 for v in d.values()) > 1000 and met[0] < 2 * len(got)


def test_sifting_loses_no_pair(spark):
    rnd = random.Random(4)
    pool = [rnd.getrandbits(62) for _ in range(3000)]
    base = sorted(rnd.sample(pool, 900))
    sets = [(k, sorted(rnd.sample(base, 900 - 9 * k) + rnd.sample(pool, k))) for k in range(60)]
    sets = [(i, sorted(set(s))) for i, s in sets]
    rows = spark.createDataFrame([(i, len(s), i, i, s) for i, s in sets], "id long, size int, h1 long, h2 long, tokens array<long>")
    pairs = materialize(spark.createDataFrame(list(itertools.combinations(range(60), 2)), "idA long, idB long"), "all")
    for num, den in ((4, 5), (2, 5)):
        want = {(a, b): len(set(x) & set(y)) for (a, x), (b, y) in itertools.combinations(sets, 2)}
        size = {i: len(s) for i, s in sets}
        want = {p: n for p, n in want.items() if n * den >= (size[p[0]] + size[p[1]] - n) * num}
        left = blocks.sifted(pairs, blocks.bit_rows(rows, 0.5), num, den)
        assert {(r.idA, r.idB): r.n for r in blocks.counted(left, rows.select("id", "tokens"), num, den).collect()} == want
        assert num == 2 or left.count() < pairs.count() / 2


def test_groups_of_similar_sets_lie_in_few_tiles(spark, monkeypatch):
    """with tiles by the hashes of both ids each set of a group went to all tiles of a row and a column."""
    monkeypatch.setattr(blocks, "MEETINGS", 40)
    monkeypatch.setattr(blocks, "SETS", 8)
    groups = [range(k, 800, 40) for k in range(40)]
    pairs = [p for g in groups for p in itertools.combinations(g, 2)]
    stored = materialize(spark.createDataFrame(pairs, "idA long, idB long"), "pairs")
    placed = blocks.placed_in_tiles(stored)
    assert sorted((r.idA, r.idB) for r in placed.collect()) == sorted(pairs)
    tiles = {}
    for r in placed.collect():
        tiles.setdefault((r.ta, r.tb), set()).update((r.idA, r.idB))
    dealt = sum(len(ids) for ids in tiles.values())
    side = blocks.tile_side(len(pairs), 800)
    by_hash = {(hash((a, 1)) % side, hash((b, 1)) % side, i) for a, b in pairs for i in (a, b)}
    assert dealt < len(by_hash) / 1.5


def test_shared_tokens_by_a_small_table():
    import numpy as np

    rnd = random.Random(6)
    shared = blocks._Shared()
    for n, top in ((0, 9), (300, 400), (5000, 1 << 62), (40, 1 << 62), (900, 1 << 20)):
        own = sorted({rnd.randrange(-top, top) << rnd.choice([0, 14]) if top < 1 << 40 else rnd.randrange(-top, top) for _ in range(n)})
        shared.hold(np.array(own, np.int64))
        for other in ([], own, own[::3], sorted({*own[::2], 5, 1 << 61}), [7]):
            assert shared.count(np.array(other, np.int64)) == len(set(own) & set(other))


def test_blocks_of_one_kind_lose_no_pair(spark, monkeypatch):
    """F2-F6: texts of unlike languages met on all words of their bitmaps; now on counts of token groups, and others on some words."""
    rnd = random.Random(7)
    tongues = [["".join(rnd.choices(letters, k=rnd.randrange(3, 8))) for _ in range(150)] for letters in ("abcdefgh", "ijklmnop", "qrstuvwx")]
    rows = []
    for k in range(240):
        own = rnd.choices(tongues[k % 3], k=rnd.randrange(20, 160))
        rows.append((len(rows), " ".join(own)))
        if k % 4 == 0:
            rows.append((len(rows), " ".join(w if rnd.random() < 0.9 else rnd.choice(tongues[rnd.randrange(3)]) for w in own)))
    docs = spark.createDataFrame(rows, "id long, para string")
    monkeypatch.setattr(blocks, "BLOCK", 24)
    monkeypatch.setattr(blocks, "CROWDED", 1)
    sets = {i: grams(t) for i, t in rows}
    d = {(a, b): 1.0 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sets, 2)}
    looked, plain = [], blocks._meetings
    monkeypatch.setattr(blocks, "_meetings", lambda b, *a: looked.append(b) or plain(b, *a))
    got = {(r.idA, r.idB): r.distance for r in similarity.text_jaccard_pairs(docs, 0.6).collect()}
    assert got == {p: v for p, v in d.items() if v < 0.6} and len(got) > 40
    texts = shingles.long_enough(docs)
    groups = blocks.token_groups(texts)
    signed = blocks.text_bit_rows(texts, 8.0, groups=groups).collect()
    assert "parts" in looked[0].columns and all(sum(memoryview(r.parts).cast("i")) == r.size for r in signed)
    # a kind has texts of one language
    kinds = {}
    tongue = {i: max(range(3), key=lambda t: sum(w in tongues[t] for w in text.split())) for i, text in rows}
    for r in signed:
        kinds.setdefault(r.kind, []).append(tongue[r.id])
    assert sum(max(own.count(t) for t in range(3)) for own in kinds.values()) > 0.95 * len(rows)


def test_probed_pairs_are_dealt_out_only_if_ids_repeat(spark, tmp_path):
    """each pair was dealt out for every band that it shares, and stored once more."""
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdef", k=5)) for _ in range(12)]
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(8)]
    rows = [(i, texts[i % 8] + "z" * (i // 20)) for i in range(120)]
    docs = spark.createDataFrame(rows, "id long, para string")
    banded = lsh.bands(lsh.text_signatures(docs, 12), 3).collect()
    keys = {}
    for r in banded:
        keys.setdefault(r.id, set()).add((r.band, r.key))
    want = sorted((a, b) for a in keys for b in keys if a % 2 == 0 and b % 2 and keys[a] & keys[b])
    for name, old in (("once", docs.where("id % 2 = 0")), ("twice", docs.where("id % 2 = 0").union(docs.where("id = 4").selectExpr("id", "upper(para) AS para")))):
        index = lsh.BandIndex(spark, f"probed_{name}", 12, 3, buckets=4, folder=str(tmp_path))
        index.add(old)
        probed = index.probe(docs.where("id % 2 <> 0"))
        plan = probed._jdf.queryExecution().executedPlan().toString()
        assert ("HashAggregate" in plan) == (name == "twice")
        index.drop()
        got = sorted((r.old, r.new) for r in probed.collect())
        assert got == want and len(want) > 300


def test_vectors_move_texts_and_no_sets(spark):
    """F8: sets were stored as strings, stored again as places and dealt out as places."""
    rnd = random.Random(9)
    rows = [(k, "".join(rnd.choices("abcdé漢 ", k=rnd.randrange(0, 300)))) for k in range(150)] + [(900, None), (901, "abcde"), (902, "aaaaaaaaaaaa")]
    docs = spark.createDataFrame(rows, "id long, para string").repartition(3)
    sets = shingles.shingle_sets(docs)
    ids = shingles.shingle_ids(shingles.vocabulary(sets))
    want = sorted(map(tuple, shingles.id_vectors(sets, ids).collect()))
    moved = shingles.id_vectors(sets, ids, texts=docs)
    assert sorted(map(tuple, moved.collect())) == want and len(want) > 140
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "array<string>" not in plan and "codes" not in plan and "_t" in plan
    lists = shingles.text_blocks(docs, points=2000).groupBy("block").agg({"_t": "count"}).collect()
    assert len(lists) > 10
