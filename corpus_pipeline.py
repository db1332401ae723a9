"""A training corpus from ``documents``: language, quality, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All
but the last return the columns of ``documents``; the last returns the packed pieces.

Defined results: rows with null or letterless text go at the first stage; a row without an id
is kept or dropped by its text; of rows that repeat an id and are in one class of
copies, one stays, and unlike texts under one id are kept or dropped each on its own; empty tables pass through empty; other columns stay as they are, whatever
their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import bin_slack, decontaminate, langid, probminhash, quality_fm
from sparkmine.llm.common import saved
from sparkmine.sources.tables import table

MIN_LANGUAGE_SCORE = 0.2  # below, a text is like no learned language
MIN_QUALITY = 0.5


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = f"_{name}"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus' own labelled texts teach."""
    profiles = langid.learn_profiles(docs)
    p = _free(docs, "language")
    told = docs.withColumn(p, langid.predicted(F.col("text"), profiles, spark))
    keep = (F.col(p)["lang_pred"] != langid.UNKNOWN) & (F.col(p)["score"] >= MIN_LANGUAGE_SCORE)
    return told.filter(keep).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, takes for good."""
    machine = quality_fm.learn(docs, table(spark, sf_dir, "labels"))
    q = _free(docs, "quality")
    return docs.withColumn(q, quality_fm.scored(F.col("text"), F.col("n_chars"), machine, spark)).filter(F.col(q) >= MIN_QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each class of near copies."""
    number, key = _free(docs, "number"), _free(docs, "key")
    marked = docs.withColumn(number, probminhash.id_number(F.col("doc_id"), F.col("text"))).withColumn(key, probminhash.text_key(F.col("text")))
    classes = probminhash.classified(docs).select(F.col("number").alias(number), F.col("key").alias(key), "stands")
    # rows of an id that stand for their class: none is dropped; more, or unlike texts, are rows that repeat an id
    unlike = F.min(key) < F.max(key)
    other = saved(classes.groupBy(number).agg(F.count_if("stands").alias("n"), unlike.alias("unlike")).filter("n <> 1 OR unlike"), "other")
    once = marked.join(other, number, "left_anti").select(*docs.columns)
    more = other.filter("n > 0")
    if more.isEmpty():
        return once
    kept = classes.filter("stands").join(more, number, "left_semi").select(number, key)
    return once.union(marked.join(kept, [number, key], "left_semi").dropDuplicates([number, key]).select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    row = _free(docs, "row")  # other texts under the id of a bad one stay
    marked = docs.withColumn(row, F.struct("doc_id", probminhash.text_key(F.col("text")).alias("key")))
    return decontaminate.decontaminated(marked, table(spark, sf_dir, "benchmark"), row).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents packed into sequences of 1024 tokens."""
    files = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return bin_slack.packed_documents(docs, *files, public_tokenizers.PATTERN)


STAGES = [
    ("language", language), ("quality", quality), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("packing", packing),
]

# Trained models and tokenizer ids are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
