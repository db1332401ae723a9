"""Periodic runs, SentencePiece pieces and spelling variants: brute force, the library itself, odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from odd_rows import no_docs, odd_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from sparkmine.llm import pieces, runs, variants
from sparkmine.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain_runs(x, least=24, times=3):
    """Every period tried at every place."""
    n, out = len(x), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def some_rows(seed):
    rnd = random.Random(seed)
    signs = rnd.choice([1, 2, 2, 3, 5, 50])
    x = []
    for _ in range(rnd.randrange(1, 6)):
        kind = rnd.random()
        some = [rnd.randrange(signs) for _ in range(rnd.randrange(1, 40))]
        if kind < 0.3:
            x += some
        elif kind < 0.8:
            inner = [rnd.randrange(signs) for _ in range(rnd.randrange(1, 4))] * rnd.randrange(0, 12)
            x += ((inner + some) * rnd.randrange(2, 9))[: rnd.randrange(10, 300)]
        else:  # Fibonacci words are full of runs
            a, b = [0], [0, 1]
            for _ in range(rnd.randrange(3, 10)):
                a, b = b, b + a
            x += b
    return x


def test_runs_against_all_periods():
    for seed in range(800):
        x = some_rows(seed)
        assert runs.maximal_runs(np.array(x, np.int64)) == plain_runs(x), x


def test_runs_do_not_cross_texts():
    a, b = [b"a", b"b"] * 12, [b"a", b"b"] * 11
    assert runs.runs_of([a, b, [], a + a]) == [[(0, 24, 2)], [], [], [(0, 48, 2)]]


def plain_run_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(kept)),
    )


def short(text):
    return text is None or len(text) < 40_000


def test_run_query_against_plain_python(spark):
    source = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r) for r in QUERIES["op11_runs"](spark, SMALL).collect()}
    assert len(got) == len(source)
    few = [(i, t) for i, t in source if len((t or "").split()) < 2500]
    assert len(few) > 0.9 * len(source)
    for i, t in few:
        assert got[i] == plain_run_row(i, t)


def test_runs_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    extra = [(40, "a b " * 30 + "end", "x"), (40, "a b " * 30 + "end", "x"), (None, "la " * 24, "y"), (41, "a\x0bb\x0cc d\x1ce " * 20, "z")]
    docs = spark.createDataFrame(extra, "doc_id long, text string, runs string")
    for df, source in ((odd_docs, odd_rows), (docs, extra)):
        got = runs.run_digests(runs.periodic_runs(df, edited=runs.planted)).collect()
        few = Counter(plain_run_row(r[0], r[1]) for r in source if short(r[1]))
        assert len(got) == len(source) and not few - Counter(tuple(r) for r in got)
    assert runs.run_digests(runs.periodic_runs(no_docs)).collect() == []
    spans = runs.periodic_runs(docs.filter("doc_id = 40")).first()
    assert spans.n_words == 61 and [tuple(r) for r in spans.runs] == [(0, 60, 2)] and spans.text == "a b end"


# --- pieces ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


TOKENS = [*"aaabcdeé ßñ  \t\n▁▁　日本語😀xyz0123\x00\r�⁇", "  ", "the", " the", "<s>", "</s>", "<unk>", "<0x0A>", "a" * 90, "ab" * 50, "ing", "tion"]


def some_text(rnd, tokens=TOKENS, most=40):
    return "".join(rnd.choice(tokens) for _ in range(rnd.randrange(most)))


def test_pieces_spans_and_text_equal_the_library(library):
    model = pieces.Model.read(open(MODEL, "rb").read())
    encoder, decoder, rnd = pieces.Encoder(model), pieces.Decoder(model), random.Random(3)
    for _ in range(3000):
        text = some_text(rnd)
        ids, starts, ends = encoder.encode(text)
        spans = [(p.begin, p.end) for p in library.encode(text.encode(), return_type="proto").pieces]
        assert ids == library.encode(text) and list(zip(starts.tolist(), ends.tolist(), strict=True)) == spans, text
        assert decoder.decode([*ids, 2]) == library.decode([*ids, 2])
    for _ in range(5000):  # ids that no text gives
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(3, 259), rnd.randrange(12)]) for _ in range(rnd.randrange(12))]
        assert decoder.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("dummy", [False, True])
def test_longest_prefix_normalisation_with_places(rule, squeeze, dummy):
    own = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    spec = next(dict(pieces.fields(v)) for n, v in pieces.fields(own.serialized_model_proto()) if n == 3)
    model = pieces.Model(chars=pieces.CharacterMap.compiled(spec.get(2, b"")), dummy_prefix=dummy, squeeze=squeeze)
    rnd = random.Random(rule)
    for _ in range(300):
        text = some_text(rnd, [*TOKENS, "①", "ﬁ", "Ａ", "ｶﾞ", "が", "é", "​", "\x01", "Å", "ΐ"], 14)
        want, places = own.normalize(text.encode(), with_offsets=True)
        got = pieces.normalise(model, text)
        assert got.text == (want.decode() if isinstance(want, bytes) else want)
        assert not got.text or pieces.original_places(model, text, got).tolist() == list(places)


def piece_row(library, doc_id, text):
    ids = library.encode(text or "", add_eos=True)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)), len((text or "").encode())


def test_piece_query_equals_the_library(spark, library):
    source = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(tuple(r) for r in QUERIES["op12_pieces"](spark, SMALL).collect()) == Counter(piece_row(library, *r) for r in source)


def test_pieces_on_odd_rows(spark, library, odd_docs, odd_rows, no_docs):
    got = Counter(tuple(r) for r in pieces.digests(pieces.encoded(odd_docs, MODEL), MODEL).collect())
    assert got == Counter(piece_row(library, r[0], r[1]) for r in odd_rows)
    assert pieces.digests(pieces.encoded(no_docs, MODEL), MODEL).collect() == []
    docs = spark.createDataFrame([("x", "A  Ω😀")], "ids string, starts string")
    both = pieces.encoded(docs, MODEL, "ids", "starts", begin=True)
    row = both.first()
    assert row[0] == "x" and row[1] == [1, *library.encode("A  Ω😀"), 2] and row[3][-1] == len("A  Ω😀".encode())


def test_other_models_are_refused():
    data = open(MODEL, "rb").read()
    with pytest.raises(ValueError):
        pieces.Model.read(data[: data.index(b"\x12\xe8\x01\n@")])  # without its settings a model is not BPE


# --- spelling variants -----------------------------------------------------------------------


def plain_counts(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def plain_variants(counts):
    near, cut = defaultdict(set), defaultdict(list)
    for w in counts:
        for i in range(len(w)):
            less = w[:i] + w[i + 1 :]
            cut[i, less].append(w)
            if less in counts:
                near[w].add(less)
                near[less].add(w)
    for same in cut.values():
        for w in same:
            near[w] |= {x for x in same if x != w}
    form = {}
    for w, n in counts.items():
        best = min(((-counts[v], v) for v in near[w]), default=(0, None))
        if near[w] and -best[0] >= 5 * n:
            form[w] = best[1]
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def test_variant_query_against_plain_python(spark):
    source = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_variants"](spark, SMALL).collect()]
    want = plain_variants(plain_counts(source))
    assert len(got) == len(want) > 500 and set(got) == want


def planted_words(rnd):
    """Words with near words of every kind at every place, many with the same start or end, prefixes of one another."""
    words = set()
    for _ in range(60):
        w = "".join(rnd.choices("abé", k=rnd.randrange(6, 14)))
        words.add(w)
        for _ in range(4):
            i = rnd.randrange(len(w) + 1)
            words |= {w[:i] + rnd.choice("abcé") + w[i:], w[:i] + w[i + 1 :], w[:i] + rnd.choice("abc") + w[i + 1 :]}
    words |= {"a" * n for n in range(6, 30)} | {"common" + "".join(rnd.choices("xyz", k=4)) for _ in range(60)}
    words |= {"q" * 3000 + "x", "q" * 3000 + "y", "z" + "q" * 3000 + "x", "pq" * 1500}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("tile", [5, 10_000])
def test_near_words_on_planted_words(spark, monkeypatch, tile):
    monkeypatch.setattr(variants, "STATES_PER_TILE", tile)
    words = planted_words(random.Random(tile))
    counts = {w: 5 + 40 * (i % 3) + i % 2 for i, w in enumerate(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got = variants.near_words(df).collect()
    want = plain_variants(counts)
    assert Counter(r.word for r in got) == Counter({w: n for w, _, _, _, n, _ in want if n})


def test_variants_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    text = "Colour colour COLOUR colour colour " * 8 + "color color color color color color colours colours colours colours colours Œcolour×÷"
    extra = [(900, text), (900, text), (None, text), (901, None), (902, ""), (903, "ÀÉÎÕÜß " * 9), (904, ("k" * 2000 + " ") * 6), (904, ("k" * 1999 + "j ") * 6)]
    docs = odd_docs.select("doc_id", "text", F.lit("x").alias("word"), F.lit(1).alias("n")).union(spark.createDataFrame([(*r, "y", 1) for r in extra], "doc_id long, text string, word string, n int"))
    got = [tuple(r) for r in variants.spelling_variants(docs).collect()]
    want = plain_variants(plain_counts([(r[0], r[1]) for r in odd_rows] + extra))
    assert len(got) == len(want) and set(got) == want
    assert {r[0] for r in got} >= {"colour", "colours", "k" * 2000, "ÀÉÎÕÜß"}
    assert variants.spelling_variants(no_docs).collect() == []
    assert variants.spelling_variants(docs.filter("doc_id = 903")).count() == 1


def test_parts_around_line_ends_are_merged_once():
    """Words that meet at a line's end were a new part for each pair of them."""
    encoder, decoder = pieces.Encoder(pieces._model(MODEL)), pieces.Decoder(pieces._model(MODEL))
    words = ["one", "two", "three", "four", "five"]
    texts = [f"{a}\n{b}" for a in words for b in words] + ["", "\n", "漢\n\U0001f600 ▁x", "▁ "]
    ids, _, ends = encoder.encode_all(texts)
    assert len(encoder.parts) < 25
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    assert decoder.decode_all(np.concatenate(ids), cuts) == [decoder.decode(x.tolist()) for x in ids]
    plain = [[i for x in encoder.merged(pieces.normalise(encoder.model, t).text) if (i := encoder._number(x)) is not None] for t in texts]
    for t, x, e, p in zip(texts, ids, ends, plain, strict=True):
        assert x.tobytes() == encoder._told(p) and (not t or e[-1] == len(t.encode()))
