"""Every operator over odd rows, empty tables and brute force on small fixtures."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from odd_rows import no_docs, odd_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from sparkmine.llm import bin_slack, decontaminate, fingerprint, html_text, kd_shards, langid, probminhash, quality_fm, toxicity, url_rules
from sparkmine.llm.common import bounded_sample, fold, mix64, text_shingles
from sparkmine.llm.components import components
from sparkmine.llm.queries import HOST_RULES, QUERIES, URL_PATTERNS

MIDDLE = SMALL.replace("0.001", "0.01")
FILES = [public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken")]
RULES = [url_rules.host_rule(*r) for r in HOST_RULES] + URL_PATTERNS


def rows(df):
    return [tuple(r) for r in df.collect()]


def prose(seed, n):
    import random

    return " ".join("".join(random.Random(f"{seed} {i}").choices("abcdefghij", k=5)) for i in range(n))


def test_fold_is_crc32_of_the_id_as_text(spark):
    got = rows(spark.createDataFrame([(1,), (42,), (None,)], "i long").select("i", fold("i", 5)))
    assert got == [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 5) for i in (1, 42, None)]


def test_bounded_sample(spark):
    df = spark.range(1000)
    assert bounded_sample(df, "id", 100).count() == 100
    assert bounded_sample(df, "id", 5000).count() == 1000
    assert bounded_sample(df.limit(0), "id", 5).count() == 0


def test_language(spark, odd_docs, no_docs):
    p = langid.learn_profiles(odd_docs)
    assert p.langs == ("en",)
    got = rows(odd_docs.select("text", langid.predicted(F.col("text"), p, spark).alias("p")))
    assert len(got) == odd_docs.count()
    for text, (lang, score) in got:
        letter = bool(text) and any(c.isalpha() for c in text)
        assert lang == ("en" if letter else "und") and 0 <= score <= 1 and (letter or score == 0)
    none = langid.learn_profiles(no_docs)
    assert rows(no_docs.select(langid.predicted(F.col("text"), none, spark))) == []
    assert {r[0][0] for r in rows(odd_docs.select(langid.predicted(F.col("text"), none, spark)))} == {"und"}


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    lang = QUERIES["op1_language"](spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (lang["lang"] == lang["lang_pred"]).mean() >= 0.95
    for name, label, least in (("op7_quality", "quality", 0.9), ("op4_toxicity", "toxic", 0.8)):
        got = QUERIES[name](spark, SMALL)
        assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
        own = got.join(labels, "doc_id").toPandas()
        assert (own["predicted"] == own[label]).mean() >= least and own["score"].between(0, 1).all()


def test_classifiers_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1, 0), (10, 0, 1), (11, None, None), (None, 1, 1), (100, 1, 0), (101, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for learn, score in (
        (lambda d, m: toxicity.learn(d, m), lambda m: toxicity.scored(F.col("text"), m, spark)),
        (lambda d, m: quality_fm.learn(d, m), lambda m: quality_fm.scored(F.col("text"), F.col("n_chars"), m, spark)),
    ):
        for docs, marks in ((odd_docs, labels), (odd_docs, none), (no_docs, labels)):
            model = learn(docs, marks)
            got = rows(odd_docs.select("text", score(model).alias("s")))
            assert len(got) == odd_docs.count() and all(0 <= s <= 1 for _, s in got)
            assert rows(no_docs.select(score(model))) == []
        by_text = defaultdict(set)
        for t, s in got:
            by_text[t].add(s)
        assert all(len(v) == 1 for t, v in by_text.items() if t and not t.startswith("a a"))


def test_fingerprints(spark, odd_docs, odd_rows, no_docs):
    assert rows(fingerprint.fingerprints(no_docs)) == []
    got = fingerprint.fingerprints(odd_docs).collect()
    order = sorted(((r[0] if r[0] is not None else -(1 << 63), r[1] or "") for r in odd_rows))
    want = Counter()
    for k, (i, text) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        other = fingerprint.edited_text(text, follow)
        a, b, c = (fingerprint.signature(text_shingles(t)) for t in (text, other, follow))
        want[(
            None if i == -(1 << 63) else i, len(text), hashlib.sha256(other.encode()).hexdigest(), fingerprint.packed(a),
            fingerprint.packed(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c),
        )] += 1
    assert Counter(tuple(r) for r in got) == want
    alone = fingerprint.fingerprints(odd_docs.filter("doc_id = 7")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def plain_signature(shingles):
    """One bin after the other, asking until a full bin is met."""
    one = lambda x: int(mix64(np.array([x], np.uint64))[0])
    least = {}
    for h in shingles.tolist():
        value = one(h & ((1 << 56) - 1)) >> 1
        least[h >> 56] = min(value, least.get(h >> 56, 1 << 64))
    out = []
    for b in range(fingerprint.BINS):
        attempt, at = 0, b
        while at not in least:
            at = one((attempt * fingerprint.BINS + b + 0x51ED27) % (1 << 64)) % fingerprint.BINS
            attempt += 1
        out.append(least[at] & 15)
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 30, 120, 1000])
def test_densification_against_one_bin_at_a_time(size):
    shingles = np.unique(np.random.default_rng(size).integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
    assert fingerprint.signature(shingles).tolist() == plain_signature(shingles)


def test_likeness_is_near_the_similarity():
    rng = np.random.default_rng(3)
    for common in (20, 100, 300):  # of 400 shingles
        away = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 800 - common, dtype=np.uint64) * np.uint64(2)
            a, b = (fingerprint.signature(s) for s in (x[:400], x[400 - common :]))
            away.append(fingerprint.likeness(a, b) - common / (800 - common))
        assert abs(np.mean(away)) < 0.02 and np.std(away) < 0.06


def test_html(spark):
    pages = [(1, "<p>a<p>b"), (2, None), (3, ""), (1, "<p>a<p>b"), (4, "<p>" + "w " * 100_000)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    assert sorted(rows(df.select("page_id", html_text.visible_text(F.col("html")))), key=repr) == sorted(((i, html_text.rendered(h)) for i, h in pages), key=repr)
    assert rows(df.limit(0).select(html_text.visible_text(F.col("html")))) == []
    got = rows(QUERIES["op3_html_text"](spark, SMALL))
    source = dict(rows(spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html")))
    assert {i: html_text.rendered(source[i]) for i in source} == dict(got)


def dims():
    return {"doc_id": F.col("doc_id"), "n_chars": F.log1p(F.col("n_chars")), "source": F.col("source"), "lang": F.col("lang")}


def test_shards_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    assert rows(kd_shards.kd_shards(no_docs, dims())) == []
    got = kd_shards.kd_shards(odd_docs, dims(), shards=5).collect()
    assert len(got) == len(odd_rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert set(by) <= set(range(5)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_shards_are_near_equal_and_split_hot_groups(spark):
    same = "a hot text " * 20
    data = [(i, same if i % 3 == 0 else prose(i, 20 + i % 30), "en", "hot" if i % 2 else f"s{i % 7}", 100 + i % 50) for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = kd_shards.kd_shards(df, dims(), shards=7).toPandas()
    load = got.groupby("shard")["size"].sum()
    assert len(load) == 7 and load.max() / load.mean() < 1.03 and load.min() / load.mean() > 0.97
    again = kd_shards.kd_shards(df.repartition(5), dims(), shards=7).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_shards_split_few_groups_of_equal_texts(spark):
    """Copies far apart in id, source, length and language meet in one shard, but for one group by a cut."""
    data = [(i, prose(f"copy{i % 150}", 10 + i % 150 % 20), ("en", "de")[i // 150 % 2], f"s{i % 11}", 100 + i % 37) for i in range(900)]
    data += [(900 + i, None if i % 2 else "", "en", f"s{i % 11}", i) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = kd_shards.kd_shards(df, dims(), shards=7).toPandas()
    assert len(got) == len(data)
    assert (got.groupby("text_crc32")["shard"].nunique() > 1).sum() <= 6
    load = got.groupby("shard")["size"].sum()
    assert len(load) == 7 and load.max() / load.mean() < 1.03 and load.min() / load.mean() > 0.97


def brute_contaminated(docs, items, threshold=0.8):
    def cut(t):
        return re.findall(r"\w+", (t or "").lower())

    def bag(w, k):
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    out = {}
    for item, text in items:
        w = cut(text)
        if not w:
            continue
        k = min(5, len(w))
        mine = bag(w, k)
        for doc, t in docs:
            x = cut(t)
            best = None
            for a in range(max(1, len(x) - len(w) + 1)):
                own = bag(x[a : a + len(w)], k)
                if own and (s := sum((own & mine).values()) / sum((own | mine).values())) >= threshold and (best is None or s > best[2]):
                    best = (a, len(x[a : a + len(w)]), s)
            if best and (doc, item) not in out or best and out[doc, item][2] < best[2]:
                out[doc, item] = best
    return out


@pytest.mark.parametrize("most", [decontaminate.MAX_BROADCAST, 0])
def test_decontamination_against_brute_force(spark, no_docs, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", most)  # 0: as with a large benchmark
    item = prose("item", 40)
    w = item.split()
    long_item = prose("long", 130)
    items = [
        (1, item), (2, "only three words"), (3, None), (4, "?"), (5, " ".join(["same"] * 12)), (6, long_item), (7, prose("absent", 30)), (1, item),
    ]
    docs = [
        (1, f"{prose(1, 30)} {item.upper()}, {prose(2, 20)}"), (2, " ".join(w[:38])), (3, " ".join(w[:20])), (4, prose(3, 60)), (5, None), (6, ""),
        (7, "x only THREE words y"), (8, " ".join([*w[:36], "a", "b", *w[38:], "c"])), (9, "same " * 30), (10, " ".join([*w[:20], "inserted", *w[20:]])),
        (11, prose(4, 10) + " " + long_item + " " + prose(5, 10)), (12, prose("long", 128) + " two others"), (13, item + " " + item), (None, item), (1, prose(6, 10)), (14, "short"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("m", F.lit(1)).withColumn("fp", F.lit("x"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9))
    got = {(r.doc_id, r.item_id): (r.start, r.words, r.similarity) for r in decontaminate.contaminated(d, b).collect()}
    want = brute_contaminated(docs, items)
    assert {k: (a, n, pytest.approx(s)) for k, (a, n, s) in want.items()} == got
    assert {(1, 1), (2, 1), (7, 2), (9, 5), (11, 6), (None, 1)} <= set(got) and not any(i == 7 for _, i in got)
    clean = sorted(rows(decontaminate.decontaminated(d, b).select("doc_id")), key=repr)
    assert clean == sorted(((i,) for i, _ in docs if i not in {k for k, _ in got}), key=repr)
    assert rows(decontaminate.contaminated(d.limit(0), b)) == [] and rows(decontaminate.contaminated(d, b.limit(0))) == []
    assert decontaminate.decontaminated(no_docs, b).columns == no_docs.columns


def test_simhash_against_brute_force(spark):
    rnd = np.random.default_rng(0)
    data = [(rnd.integers(-(1 << 63), (1 << 63) - 1, n).tolist(),) for n in (1, 2, 5, 40, 61)]
    df = spark.createDataFrame(data, "s array<long>")
    for most in (61, 5000, 1 << 20):
        for s, fp in rows(df.select("s", decontaminate.simhash(F.col("s"), most))):
            bits = [sum(x >> b & 1 for x in s) * 2 > len(s) for b in range(64)]
            assert fp & ((1 << 64) - 1) == sum(1 << b for b in range(64) if bits[b])


def test_blocks_find_everything_in_the_radius(spark):
    rnd = np.random.default_rng(0)
    pairs = []
    for n in range(600):
        x = int(rnd.integers(0, 1 << 62))
        y = x
        for b in rnd.choice(63, n % (decontaminate.RADIUS + 1), replace=False):
            y ^= 1 << int(b)
        pairs.append((x, y))
    df = spark.createDataFrame(pairs, "x long, y long")
    common = F.array_size(F.array_intersect(decontaminate.blocks(F.col("x"), away=1), decontaminate.blocks(F.col("y"))))
    assert df.filter(common == 0).count() == 0
    # and leave most of the others out
    far = spark.createDataFrame([(int(a), int(b)) for a, b in rnd.integers(-(1 << 63), (1 << 63) - 1, (2000, 2))], "x long, y long")
    assert far.filter(common > 0).count() < 0.6 * 2000


def test_edited_passages_are_found(spark):
    """Passages with replaced, dropped and added words, as far as their true similarity is 0.8 or more."""
    import random

    rnd, items, docs = random.Random(8), [], []
    for i in range(50):
        w = prose(f"item{i}", rnd.randrange(40, 160)).split()
        items.append((i, " ".join(w)))
        own = list(w)
        for _ in range(rnd.randrange(0, 1 + len(w) // 45)):
            at = rnd.randrange(len(own))
            own[at : at + rnd.randrange(2)] = [f"new{rnd.randrange(10**6)}"]
        docs.append((i, f"{prose(f'a{i}', 40)} {' '.join(own)} {prose(f'b{i}', 30)}"))
    want = {k: v[2] for k, v in brute_contaminated(docs, items).items()}
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(d, b).collect()}
    assert len(want) > 25 and sum(s < 0.9 for s in want.values()) > 6
    assert set(got) <= set(want) and len(got) >= len(want) - 1 and all(got[k] == pytest.approx(want[k]) for k in got)
    assert {k for k, s in want.items() if s > 0.88} <= set(got)


def test_decontamination_keeps_clashing_columns(spark):
    item = prose("clash", 30)
    d = spark.createDataFrame([(1, item, 7), (2, prose("z", 30), 8)], "doc_id long, text string, bad int").withColumn("_bad", F.lit(1))
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert rows(decontaminate.decontaminated(d, b)) == [(2, prose("z", 30), 8, 1)]


def test_loose_scheme_finds_copies_with_scattered_edits(spark):
    """Held against another measure: unlike texts whose sets of five characters have a Jaccard similarity over 0.8."""
    import duckdb

    text = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{MIDDLE}/documents.parquet'").fetchall())
    sets, by_gram = {}, defaultdict(list)
    for t in set(text.values()):
        sets[t] = {t[i : i + 5] for i in range(max(0, len(t) - 4))}
        for g in sorted(sets[t], key=lambda g: zlib.crc32(g.encode()))[:40]:  # the least hashes: alike sets share some
            by_gram[g].append(t)
    alike = {(a, b) for ts in by_gram.values() if len(ts) < 100 for a in ts for b in ts if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(alike) > 50
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = {}
    for scheme in (probminhash.STRICT, probminhash.LOOSE):
        of = {text[i]: c for i, c in rows(probminhash.near_duplicates(docs, scheme=scheme))}
        found[scheme] = sum(of[a] == of[b] for a, b in alike) / len(alike)
        classes = defaultdict(list)
        for t, c in of.items():
            classes[c].append(t)
        unlike = [own for own in classes.values() if len(own) > 1 and any(all(len(sets[a] & sets[b]) < 0.4 * len(sets[a] | sets[b]) for b in own if b is not a) for a in own)]
        assert len(unlike) <= (6 if scheme is probminhash.LOOSE else 0)
    assert found[probminhash.LOOSE] >= 0.95 and found[probminhash.STRICT] <= found[probminhash.LOOSE]
    assert probminhash.STRICT.missed(0.8) < 1e-4 and probminhash.LOOSE.missed(0.6) < 0.02


def brute_classes(data, threshold=0.8):
    sets = [probminhash.weighted_shingles(t) for _, t in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            same = (data[i][1] or "") == (data[j][1] or "")
            if same or (len(sets[i][0]) and len(sets[j][0]) and probminhash.probability_jaccard(sets[i], sets[j]) >= threshold):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(set)
    for i in range(len(data)):
        groups[find(i)].add(i)
    return {frozenset(g) for g in groups.values()}


def test_near_duplicates_against_brute_force(spark, odd_docs, odd_rows, no_docs):
    assert rows(probminhash.near_duplicates(no_docs)) == []
    got = probminhash.near_duplicates(odd_docs).collect()
    assert len(got) == len(odd_rows)
    class_of = defaultdict(set)
    for r in got:
        class_of[r.doc_id].add(r.class_id)
    assert len(class_of[13]) == 1 and class_of[12] == class_of[13] == {12} and class_of[7] == class_of[8] == class_of[9] == {7} and 7 in class_of[None]
    assert class_of[1] == class_of[2] == class_of[14] == {1} and class_of[3] == {3}


def test_unlike_texts_under_one_id_are_classes_apart(spark):
    a, b, c = (prose(x, 90) for x in "abc")
    data = [(1, a), (1, b), (1, b), (1, c), (2, f"{a} more"), (3, f"{b} more"), (4, b), (5, prose("d", 90)), (None, a)]
    got = defaultdict(Counter)
    for i, k in rows(probminhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(3))):
        got[i][k] += 1
    (of_a,), (of_b,) = got[2], got[3]
    assert of_a != of_b and got[None] == {of_a: 1} and got[4] == {of_b: 1} and got[5] == {5: 1}
    assert len(got[1]) == 3 and got[1][of_a] == 1 and got[1][of_b] == 2 and 1 in got[1]
    # two texts under one id that are alike are one class
    got = rows(probminhash.near_duplicates(spark.createDataFrame([(1, a), (1, f"{a} more"), (2, c)], "doc_id long, text string")))
    assert sorted(got) == [(1, 1), (1, 1), (2, 2)]


def test_groups_of_near_copies(spark):
    """Chains of edits: many texts in shared buckets, not all alike to the bucket's least one."""
    import random

    rnd = random.Random(1)
    data, n = [], 0
    for g in range(4):
        text = prose(f"g{g}", 90).split()
        for _ in range(60):
            data.append((n, " ".join(text)))
            n += 1
            at = rnd.randrange(len(text))
            text = [*text[:at], f"edit{n}", *text[at + 1 :]]
    data += [(n + i, prose(f"other{i}", 60)) for i in range(60)]
    rnd.shuffle(data)
    got = dict(rows(probminhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))))
    groups = defaultdict(set)
    place = {d: i for i, (d, _) in enumerate(data)}
    for d, c in got.items():
        groups[c].add(place[d])
        assert c <= d
    assert {frozenset(g) for g in groups.values()} == brute_classes(data)


def test_components(spark):
    import random

    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(200, 260)] + [(1000, i) for i in range(1001, 1100)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(35)] + [(5, 5), (3, 2), (2, 3)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    loose = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    got = rows(components(spark.createDataFrame(edges, "a long, b long")))
    assert dict(got) == {x: find(x) for x in parent if x not in loose} and len(got) == len(dict(got))
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def check_packing(got, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILES[0])
    want = Counter()
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(by)


def test_packing(spark, odd_docs, odd_rows, no_docs):
    assert rows(bin_slack.packed_documents(no_docs, *FILES, public_tokenizers.PATTERN)) == []
    check_packing(bin_slack.packed_documents(odd_docs, *FILES, public_tokenizers.PATTERN).collect(), [(r[0], r[1]) for r in odd_rows])
    got = QUERIES["op9_packing"](spark, SMALL).collect()
    used = check_packing(got, rows(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")))
    assert used <= 1.02 * sum(r.length for r in got) / 1024 + 1


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    plain = [r for r in URL_PATTERNS if re.search(r.pattern, url or "")]
    return host, path, rule, verdict or ("block" if plain else "allow")


def test_url_rules(spark):
    urls = [
        None, "", "x", "http://", "http://Example.COM/en/x", "https://www.example.com/en/", "https://a.www.example.com/en/y?z", "http://example.com/en", "http://com/",
        "http://notexample.com/en/", "http://example.com.net/fr/x", "http://net/es/", "http://a.net/es", "http://example.org/login", "http://e.org/loginx", "ftp://e.org/a.zip?x",
        "http://e.org/?sessid=3", "http://e.org/?x=1&PHPSESSID=3", "http://casino.e.org/", "http://e.org?utm_source=feed", "http://e.org/x#/en/", "http://ÄB.COM/x", "a://b://c.com/d",
        "http://x.com\n/en/", "http://example.com/en/", "http://example.com/en/", "http://" + "a" * 50_000 + ".com/" + "b/" * 20_000, "http://user@example.com/en/",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("x")).withColumn("host", F.lit("y")).withColumn("token", F.lit(1))
    got = {r[0]: r[1:5] for r in rows(url_rules.filter_urls(df, "url", RULES, ["page_id"]).select("page_id", "host", "path", "rule", "verdict"))}
    assert got == {i: judged(u) for i, u in enumerate(urls)}
    assert rows(url_rules.filter_urls(df.limit(0), "url", RULES, ["page_id"])) == []
    assert {r[0] for r in rows(url_rules.filter_urls(df, "url", [], ["page_id"]).select("verdict"))} == {"allow"}
