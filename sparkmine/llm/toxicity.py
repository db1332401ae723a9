"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed 3- to 6-grams that a text's letters contain (presence, whole text).
Each feature weighs the log ratio of its smoothed share in toxic and in other labelled
texts; a regularised logistic model is fitted on the scaled features.

Defined results: null, empty and letterless texts get the score of the model's intercept;
repeated rows get equal scores; without labelled rows of both kinds every score is 0.
Features reach over the whole text whatever its length; no other column is an input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import each_text, labelled_sample, letter_line, sigmoid

GRAMS = (3, 4, 5, 6)
HASH_BITS = 18
KEPT = 4096  # hashed features with the strongest association; bounds what reaches the driver
SAMPLE_ROWS = 6_000  # labelled rows that the model is fitted on, at most


@dataclass(frozen=True)
class Model:
    """``slot[bucket]`` is a feature's place in ``weights`` or -1; weights include the log-count ratio."""

    slot: np.ndarray
    weights: np.ndarray
    bias: float


def buckets(text: str | None) -> np.ndarray:
    """Hash buckets of the text's character n-grams, with repeats."""
    x = letter_line(text).astype(np.uint64)
    out = []
    h = x
    for n in range(2, GRAMS[-1] + 1):
        if len(x) < n:
            break
        h = h[:-1] * np.uint64(0x100000001B3) + x[n - 1 :]
        if n in GRAMS:
            out.append((((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def present(text: str | None, slot: np.ndarray) -> np.ndarray:
    """Distinct kept features of a text."""
    s = slot[buckets(text)]
    return np.unique(s[s >= 0])


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps on a bounded dense sample; the rarer kind's rows together weigh half as much as the others'."""
    n, d = x.shape
    rows = np.where(y == 1, max(1.0, 0.5 * (y == 0).sum() / (y == 1).sum()), 1.0).astype(np.float32)
    rows /= rows.mean()
    v = np.ones(d, np.float32)
    for _ in range(12):
        v = x.T @ (x @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1.0 / (0.25 * rows.max() * (np.linalg.norm(x @ v) ** 2 / n + 1.0) + l2)
    w, b = np.zeros(d, np.float32), 0.0
    zw, zb, t = w, b, 1.0
    for _ in range(steps):
        g = (rows * (sigmoid(x @ zw + zb) - y)).astype(np.float32) / n
        nw, nb = zw - step * (x.T @ g + l2 * zw), zb - step * float(g.sum())
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        zw, zb, t = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b), t2
        w, b = nw, nb
    return w, b


def learn(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id",
    kept: int = KEPT, sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on the texts of at most ``sample_rows`` rows of ``labels``.

    Document counts per bucket are summed by Spark (at most 2**HASH_BITS rows reach the
    driver), then only the kept features of the sample (rows x ``kept`` at most).
    """
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, {"text": text_col}, label_col, id_col, sample_rows)
    size = 1 << HASH_BITS

    def count(batches):
        n = np.zeros((2, size), np.int64)
        docs = np.zeros(2, np.int64)
        for b in batches:
            for y, t in zip(b["y"], each_text(b["text"]), strict=True):
                n[int(y == 1), np.unique(buckets(t))] += 1
                docs[int(y == 1)] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pd.DataFrame({"bucket": np.append(at, -1), "toxic": np.append(n[1, at], docs[1]), "clean": np.append(n[0, at], docs[0])})

    got = (
        rows.mapInPandas(count, "bucket int, toxic long, clean long")
        .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toPandas()
    )
    docs = got[got["bucket"] == -1][["toxic", "clean"]].sum()
    got = got[got["bucket"] >= 0].sort_values("bucket")
    if min(docs["toxic"], docs["clean"]) == 0 or got.empty:
        return Model(np.full(size, -1, np.int16), np.zeros(1, np.float32), -30.0)
    p = (got["toxic"].to_numpy() + 1.0) / (got["toxic"].sum() + len(got))
    q = (got["clean"].to_numpy() + 1.0) / (got["clean"].sum() + len(got))
    ratio = np.log(p / q)
    # association of presence with the label: squared difference of shares over its variance
    a, b = got["toxic"].to_numpy() / docs["toxic"], got["clean"].to_numpy() / docs["clean"]
    mean = (got["toxic"].to_numpy() + got["clean"].to_numpy()) / docs.sum()
    strength = (a - b) ** 2 / (mean * (1 - mean) + 1e-3)
    top = np.sort(np.lexsort((got["bucket"].to_numpy(), -strength))[:kept])
    slot = np.full(size, -1, np.int16)
    slot[got["bucket"].to_numpy()[top]] = np.arange(len(top))
    ratio = ratio[top].astype(np.float32)
    shared = spark.sparkContext.broadcast(slot)

    @F.pandas_udf("array<short>")
    def kept_features(texts: pd.Series) -> pd.Series:
        return pd.Series([present(t, shared.value) for t in each_text(texts)])

    sample = rows.select("y", kept_features("text").alias("f")).toPandas()
    x = np.zeros((len(sample), len(top)), np.float32)
    for i, f in enumerate(sample["f"]):
        x[i, np.asarray(f, np.int64)] = ratio[np.asarray(f, np.int64)]
    w, bias = fit(x, (sample["y"].to_numpy() == 1).astype(np.float32))
    return Model(slot, w * ratio, bias)


def scored(text: Column, model: Model, spark) -> Column:
    """Probability that a text is toxic."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.bias + float(m.weights[present(t, m.slot)].sum()) for t in each_text(texts)]).pipe(sigmoid)

    return score.asNondeterministic()(text)
