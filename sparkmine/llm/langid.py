"""Language identification by rank-order profiles of character n-grams.

A language's profile is its ``size`` most frequent 1- to 3-grams, in order. A text's
own ranking is compared with each profile by the out-of-place distance: the sum of rank
differences, with ``size`` for a gram that the profile lacks. The nearest language wins.

Defined results: null text, or text without a letter, gives ``und`` with score 0; ties
go to the language that sorts first; repeated rows get equal answers; with nothing to learn
from, every text is ``und``. Whole texts are counted whatever their length. Other columns
of the input are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import bounded_sample, each_text, letter_line

UNKNOWN = "und"
PROFILE_SIZE = 400
SAMPLE_ROWS = 10_000  # labelled rows that the profiles are learned from, at most


@dataclass(frozen=True)
class Profiles:
    """``ranks[g, l]`` is the place of ``grams[g]`` in language ``l``; ``size`` where it is missing."""

    langs: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1-, 2- and 3-grams of the text's words (with their edges) and how often each occurs."""
    x = letter_line(text)
    if len(x) == 0:
        return x, x
    two = (x[:-1] << 21) | x[1:]
    three = ((two[:-1] << 21) | x[2:])[x[1:-1] != 32]
    return np.unique(np.concatenate([x[x != 32], two, three]), return_counts=True)


def ranking(text: str | None, size: int) -> np.ndarray:
    """The text's ``size`` most frequent grams, most frequent first, ties by code."""
    grams, n = gram_counts(text)
    if len(grams) > size:
        often = n >= np.partition(n, len(n) - size)[len(n) - size]
        grams, n = grams[often], n[often]
    return grams[np.lexsort((grams, -n))[:size]]


def nearest(text: str | None, p: Profiles) -> tuple[str, float]:
    own = ranking(text, p.size)
    if len(own) == 0 or not p.langs:
        return UNKNOWN, 0.0
    at = np.minimum(np.searchsorted(p.grams, own), len(p.grams) - 1)
    known = p.grams[at] == own
    away = np.abs(p.ranks[at] - np.arange(len(own))[:, None])
    away[~known] = p.size
    away = np.where(p.ranks[at] >= p.size, p.size, away).sum(axis=0)
    best = int(away.argmin())
    return p.langs[best], float(1.0 - away[best] / (p.size * len(own)))


def learn_profiles(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    size: int = PROFILE_SIZE, sample_rows: int = SAMPLE_ROWS,
) -> Profiles:
    """Profiles from at most ``sample_rows`` rows of ``labelled``; languages x ``size`` rows reach the driver."""
    rows = bounded_sample(labelled.filter(F.col(lang_col).isNotNull()), id_col, sample_rows)

    def count(batches):
        for b in batches:
            for lang, own in b.groupby("lang", sort=True)["text"]:
                parts = [gram_counts(t) for t in each_text(own)]
                grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(where, np.concatenate([c for _, c in parts]), len(grams)).astype("int64")
                yield pd.DataFrame({"lang": lang, "gram": grams.astype("int64"), "n": n})

    counts = (
        rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    top = counts.withColumn("place", place).filter(F.col("place") < size).collect()
    langs = tuple(sorted({r["lang"] for r in top}))
    grams = np.unique(np.array([r["gram"] for r in top], np.int64))
    ranks = np.full((len(grams), len(langs)), size, np.int64)
    for r in top:
        ranks[np.searchsorted(grams, r["gram"]), langs.index(r["lang"])] = r["place"]
    return Profiles(langs, grams, ranks, size)


def predicted(text: Column, profiles: Profiles, spark) -> Column:
    """struct<lang_pred string, score double> for a text column."""
    shared = spark.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([nearest(t, shared.value) for t in each_text(texts)], columns=["lang_pred", "score"])

    return predict.asNondeterministic()(text)
