"""The pipeline against plain versions of its stages."""

from collections import Counter

import public_tokenizers
from conftest import SMALL
from odd_rows import no_docs, odd_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline as P
from test_operators import brute_classes, brute_contaminated, check_packing

from sparkmine.llm import langid, probminhash, quality_fm
from sparkmine.llm.common import text_shingles


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("language", F.lit(1)).withColumn("node", F.lit("n"))
    one = P.language(spark, docs, SMALL)
    assert one.columns == docs.columns
    p = langid.learn_profiles(docs)
    all_rows = docs.select("doc_id", "text", "n_chars").collect()
    kept = {r.doc_id for r in all_rows if (a := langid.nearest(r.text, p))[0] != "und" and a[1] >= P.MIN_LANGUAGE_SCORE}
    assert set(ids(one)) == kept

    two = P.quality(spark, docs, SMALL)
    m = quality_fm.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in all_rows if quality_fm.machine_score(m, *quality_fm.features(r.text, r.n_chars)) >= 0}
    assert two.columns == docs.columns and set(ids(two)) == good

    three = P.near_duplicates(spark, docs, SMALL)
    classes = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs).collect()}
    assert three.columns == docs.columns and ids(three) == Counter(set(classes.values()))

    four = P.decontamination(spark, docs, SMALL)
    assert four.columns == docs.columns and 0 < four.count() <= docs.count()


def test_run_against_plain_stages(spark):
    """run() on the whole small tables, against plain Python over lists of rows."""
    assert [n for n, _ in P.STAGES] == ["language", "quality", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    own = docs.select("doc_id", "text", "n_chars").collect()
    p = langid.learn_profiles(docs)
    own = [r for r in own if (a := langid.nearest(r.text, p))[0] != "und" and a[1] >= P.MIN_LANGUAGE_SCORE]
    m = quality_fm.learn(docs.filter(F.col("doc_id").isin([r.doc_id for r in own])), spark.read.parquet(f"{SMALL}/labels.parquet"))
    own = [r for r in own if quality_fm.machine_score(m, *quality_fm.features(r.text, r.n_chars)) >= 0]
    least = {min(own[i].doc_id for i in g) for g in brute_classes([(r.doc_id, r.text) for r in own])}
    own = [r for r in own if r.doc_id in least]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    told = {h for _, t in items for h in text_shingles(t).tolist()}
    may = [(r.doc_id, r.text) for r in own if told & set(text_shingles(r.text).tolist())]
    bad = {d for d, _ in brute_contaminated(may, items)}
    own = [(r.doc_id, r.text) for r in own if r.doc_id not in bad]
    assert bad and own
    check_packing(P.run(spark, SMALL).collect(), own)


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in P.STAGES[:-1]:
            got = stage(spark, docs, str(tmp_path))
            assert got.columns == docs.columns and got.count() <= docs.count()
        assert P.packing(spark, docs, str(tmp_path)).count() >= docs.count()
    kept = P.near_duplicates(spark, odd_docs, str(tmp_path)).select("doc_id").collect()
    assert Counter(r[0] for r in kept)[13] == 0 and Counter(r[0] for r in kept)[12] == 1 and Counter(r[0] for r in kept)[7] == 1
    no_letters = odd_docs.filter("doc_id in (1, 2, 3, 4, 17)")
    assert P.language(spark, no_letters, str(tmp_path)).count() == 0


def test_repeated_rows_leave_one(spark, odd_docs, tmp_path):
    copies = odd_docs.filter("doc_id = 100")
    assert P.near_duplicates(spark, copies.union(copies).union(copies), str(tmp_path)).count() == 1


def test_unlike_texts_under_one_id_stay_apart(spark, odd_rows, tmp_path):
    text = {r[0]: r[1] for r in odd_rows}
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    data = [(1, text[7]), (1, text[105]), (1, text[105]), (2, text[9]), (3, f"{text[110]} {item}"), (3, text[111]), (None, f"{text[110]} {item}"), (None, text[109])]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    once = Counter(tuple(r) for r in P.near_duplicates(spark, docs, str(tmp_path)).collect())
    assert once == Counter({data[0]: 1, data[1]: 1, data[4]: 1, data[5]: 1, data[7]: 1})
    clean = Counter(tuple(r) for r in P.decontamination(spark, docs, str(tmp_path)).collect())
    assert clean == Counter(r for r in data if item not in r[1])


def test_files_exist():
    assert all(open(public_tokenizers.path(f"byte_bpe_50k.{k}")).readable() for k in ("json", "tiktoken"))
