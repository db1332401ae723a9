"""Text quality by a factorisation machine.

Inputs are hashed words (presence, scaled to unit length), statistics of the text's
structure and the row's stated length. Each input has a weight and a low-rank vector; all
pairwise products are summed in linear time as half of (sum of v x) squared minus sum of
(v x) squared, per factor.

Defined results: null and empty texts are scored by their (zero) statistics; repeated rows
get equal scores; without labelled rows of both kinds every score is 0.5. A missing length
counts as the text's own. Whole texts are used; language, source and id are no inputs.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import WordHashes, each_text, labelled_sample, sigmoid

WORD_BITS = 12
FACTORS = 6
SAMPLE_ROWS = 6_000  # labelled rows that the machine is fitted on, at most
STATS = 14

_HASHES = WordHashes()


@dataclass(frozen=True)
class Machine:
    bias: float
    w: np.ndarray  # words, then statistics
    v: np.ndarray  # the same by factors
    center: np.ndarray
    scale: np.ndarray


def features(text: str | None, stated: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words (lower-case tokens without outer signs) and the structure statistics."""
    t = text or ""
    tokens = t.split()
    counts = Counter(tokens)
    idx = np.unique(np.fromiter((_HASHES[w.lower().strip(".,;:!?|#$%&*()\"'")] for w in counts), np.uint64, len(counts)) >> np.uint64(64 - WORD_BITS)).astype(np.int16)
    n, m = max(len(t), 1), max(len(tokens), 1)
    cp = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_n = np.bincount(np.minimum(cp, 128), minlength=129)
    lower, upper, digits = ascii_n[97:123].sum(), ascii_n[65:91].sum(), ascii_n[48:58].sum()
    blanks = ascii_n[32] + ascii_n[9] + ascii_n[10] + ascii_n[13]
    signs = ascii_n[:128].sum() - lower - upper - digits - blanks
    length = stated if stated is not None and stated == stated and stated >= 0 else len(t)
    top = max(counts.values(), default=0)
    stats = np.array([
        np.log1p(len(t)), np.log1p(length), np.log1p(len(tokens)), upper / n, digits / n, signs / n,
        ascii_n[128] / n, ascii_n[10] / m, ascii_n[124] / m, (ascii_n[46] + ascii_n[33] + ascii_n[63]) / m,
        len(counts) / m, top / m, (len(t) - blanks) / m / 10.0, (ascii_n[35] + ascii_n[36] + ascii_n[37] + ascii_n[38] + ascii_n[42]) / m,
    ], np.float32)
    return idx, stats


def fit(x: np.ndarray, y: np.ndarray, factors: int, epochs: int = 15, rate: float = 0.08, l2: float = 1e-4, seed: int = 11):
    """Adaptive gradient steps on logistic loss over a bounded dense sample."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    bias, w, v = 0.0, np.zeros(d, np.float32), rng.normal(0, 0.03, (d, factors)).astype(np.float32)
    gw, gv, gb = np.full(d, 1e-6, np.float32), np.full((d, factors), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(n), max(1, n // 128)):
            a = x[at]
            s = a @ v
            p = bias + a @ w + 0.5 * ((s * s).sum(1) - (a * a) @ (v * v).sum(1))
            e = ((sigmoid(p) - y[at]) / len(at)).astype(np.float32)
            dw = a.T @ e + l2 * w
            dv = a.T @ (e[:, None] * s) - ((a * a).T @ e)[:, None] * v + l2 * v
            db = float(e.sum())
            gw += dw * dw
            gv += dv * dv
            gb += db * db
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
            bias -= rate * db / gb**0.5
    return bias, w, v


def learn(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "quality", id_col: str = "doc_id",
    length_col: str | None = "n_chars", sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """Fit on the texts of at most ``sample_rows`` rows of ``labels``; their features (at most 2**WORD_BITS + STATS each) reach the driver."""
    own = {"text": text_col} | ({"stated": length_col} if length_col else {})
    rows = labelled_sample(docs, labels, own, label_col, id_col, sample_rows)
    length = (F.col("stated") if length_col else F.lit(None)).cast("double")

    @F.pandas_udf("idx array<short>, stats array<float>")
    def extract(texts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(t, n) for t, n in zip(each_text(texts), lengths, strict=True)], columns=["idx", "stats"])

    got = rows.select("y", extract.asNondeterministic()("text", length).alias("f")).select("y", "f.idx", "f.stats").toPandas()
    y = (got["y"].to_numpy() == 1).astype(np.float32)
    d = (1 << WORD_BITS) + STATS
    if len(y) == 0 or y.min() == y.max():
        return Machine(0.0, np.zeros(d, np.float32), np.zeros((d, FACTORS), np.float32), np.zeros(STATS, np.float32), np.ones(STATS, np.float32))
    # an order of rows that does not depend on how Spark deals them out
    stats = np.stack(got["stats"].to_numpy()).astype(np.float32)
    order = np.lexsort((y, *stats.T))
    got, y, stats = got.iloc[order], y[order], stats[order]
    center, scale = stats.mean(0), stats.std(0) + 1e-3
    x = np.zeros((len(y), d), np.float32)
    for i, idx in enumerate(got["idx"]):
        if len(idx):
            x[i, np.asarray(idx, np.int64)] = 1.0 / np.sqrt(len(idx))
    x[:, 1 << WORD_BITS :] = standard(stats, center, scale)
    bias, w, v = fit(x, y, FACTORS)
    return Machine(bias, w, v, center, scale)


def standard(stats: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((stats - center) / scale, -4, 4) / 2


def machine_score(m: Machine, idx: np.ndarray, stats: np.ndarray) -> float:
    """The machine's log-odds: linear part plus all pairwise products by the sum-of-squares identity."""
    size = 1 << WORD_BITS
    x = standard(stats, m.center, m.scale)
    s, sq, linear = x @ m.v[size:], (x * x) @ (m.v[size:] ** 2), m.bias + float(x @ m.w[size:])
    if len(idx):
        a = np.float32(1.0 / np.sqrt(len(idx)))
        own = m.v[idx] * a
        s, sq, linear = s + own.sum(0), sq + (own * own).sum(0), linear + float(m.w[idx].sum() * a)
    return linear + 0.5 * float((s * s - sq).sum())


def scored(text: Column, length: Column | None, machine: Machine, spark) -> Column:
    """Probability that a text is good."""
    shared = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series, lengths: pd.Series) -> pd.Series:
        return pd.Series([machine_score(shared.value, *features(t, n)) for t, n in zip(each_text(texts), lengths, strict=True)], dtype="float64").pipe(sigmoid)

    return score.asNondeterministic()(text, (F.lit(None) if length is None else length).cast("double"))
