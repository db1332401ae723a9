"""CUR queries on ``embeddings`` (rows = vectors, columns = dimensions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import cur as CUR
from sparkmine.sources.tables import table

RRANK = 20
CRANK = 10


def embedding_matrix(spark, sf_dir):
    return CUR.array_rows_to_coo(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def cur_row_probs(spark, sf_dir):
    return CUR.probabilities(embedding_matrix(spark, sf_dir), "i").select(F.col("idx").alias("i"), "p")


def cur_col_probs(spark, sf_dir):
    return CUR.probabilities(embedding_matrix(spark, sf_dir), "j").select(F.col("idx").alias("j"), "p")


def cur_sample_rows(spark, sf_dir):
    return CUR.sample_indices(embedding_matrix(spark, sf_dir), "i", CUR.fixed_draws(spark, RRANK))


def cur_sample_cols(spark, sf_dir):
    return CUR.sample_indices(embedding_matrix(spark, sf_dir), "j", CUR.fixed_draws(spark, CRANK))


def cur_c(spark, sf_dir):
    a = embedding_matrix(spark, sf_dir)
    return CUR.select_columns(a, CUR.sample_indices(a, "j", CUR.fixed_draws(spark, CRANK)))


def cur_r(spark, sf_dir):
    a = embedding_matrix(spark, sf_dir)
    return CUR.select_rows(a, CUR.sample_indices(a, "i", CUR.fixed_draws(spark, RRANK)))


def _fit(spark, sf_dir):
    return CUR.cur(embedding_matrix(spark, sf_dir), RRANK, CRANK, draws_rows=CUR.fixed_draws(spark, RRANK),
                   draws_cols=CUR.fixed_draws(spark, CRANK))


def cur_u(spark, sf_dir):
    return _fit(spark, sf_dir)["U"]


def cur_error(spark, sf_dir):
    f = _fit(spark, sf_dir)
    return spark.createDataFrame([(f["norm"], f["error"])], "norm double, error double")


DIGITS = 6


def _product(spark, sf_dir, which):
    a = embedding_matrix(spark, sf_dir)
    c = CUR.select_columns(a, CUR.sample_indices(a, "j", CUR.fixed_draws(spark, CRANK)))
    r = CUR.select_rows(a, CUR.sample_indices(a, "i", CUR.fixed_draws(spark, RRANK)))
    return CUR.sampled_products(a, c, r)[which].select("i", "j", F.round("v", DIGITS).alias("v"))


def cur_ctc(spark, sf_dir):
    return _product(spark, sf_dir, 0)


def cur_rrt(spark, sf_dir):
    return _product(spark, sf_dir, 1)


def cur_link(spark, sf_dir):
    return _product(spark, sf_dir, 2)


_A = """SELECT vec_id AS i, CAST(j - 1 AS BIGINT) AS j, CAST(embedding[j] AS DOUBLE) AS v
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS j FROM embeddings)"""

# squares in units of the largest one / 1e15, summed exactly
_E = "SUM(CAST(floor((v / (SELECT max(abs(v)) FROM a)) * (v / (SELECT max(abs(v)) FROM a)) * 1000000000000000.0) AS HUGEINT))"


def _probs_sql(axis: str) -> str:
    return f"""
WITH a AS ({_A}), e AS (SELECT {axis} AS idx, {_E} AS e FROM a GROUP BY {axis})
SELECT idx AS {axis}, CAST(e AS DOUBLE) / CAST((SELECT SUM(e) FROM e) AS DOUBLE) AS p FROM e
"""


def _sample_sql(axis: str, s: int) -> str:
    return f"""
WITH a AS ({_A}),
e AS (SELECT {axis} AS idx, {_E} AS e FROM a GROUP BY {axis}),
c AS (SELECT idx, e, SUM(e) OVER (ORDER BY idx) AS cum, SUM(e) OVER () AS total FROM e),
iv AS (SELECT idx, CAST(cum - e AS DOUBLE) / CAST(total AS DOUBLE) AS p_lo, CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) AS p_hi FROM c),
d AS (SELECT CAST(x AS INTEGER) AS draw, CAST(x AS DOUBLE) * {CUR.GOLDEN} - floor(CAST(x AS DOUBLE) * {CUR.GOLDEN}) AS u FROM range(1, {s + 1}) t(x)),
f AS (SELECT draw, min(idx) AS idx FROM d JOIN iv ON u >= p_lo AND u <= p_hi GROUP BY draw)
SELECT draw, idx, CAST(row_number() OVER (ORDER BY idx, draw) - 1 AS INTEGER) AS pos FROM f
"""


QUERIES = {
    "cur_row_probs": cur_row_probs,
    "cur_col_probs": cur_col_probs,
    "cur_sample_rows": cur_sample_rows,
    "cur_sample_cols": cur_sample_cols,
    "cur_c": cur_c,
    "cur_r": cur_r,
    "cur_u": cur_u,
    "cur_error": cur_error,
    "cur_ctc": cur_ctc,
    "cur_rrt": cur_rrt,
    "cur_link": cur_link,
}

_C = f"""SELECT a.i AS i, CAST(s.pos AS BIGINT) AS j, a.v AS v FROM ({_A}) a JOIN ({_sample_sql('j', CRANK)}) s ON a.j = s.idx WHERE a.v <> 0"""
_R = f"""SELECT CAST(s.pos AS BIGINT) AS i, a.j AS j, a.v AS v FROM ({_A}) a JOIN ({_sample_sql('i', RRANK)}) s ON a.i = s.idx WHERE a.v <> 0"""

ORACLES = {
    "cur_ctc": f"WITH c AS ({_C}) SELECT x.j AS i, y.j AS j, round(SUM(x.v * y.v), {DIGITS}) AS v FROM c x JOIN c y ON x.i = y.i GROUP BY 1, 2",
    "cur_rrt": f"WITH r AS ({_R}) SELECT x.i AS i, y.i AS j, round(SUM(x.v * y.v), {DIGITS}) AS v FROM r x JOIN r y ON x.j = y.j GROUP BY 1, 2",
    "cur_link": f"""
WITH a AS ({_A}), c AS ({_C}), r AS ({_R}),
ca AS (SELECT c.j AS i, a.j AS j, SUM(c.v * a.v) AS v FROM c JOIN a ON c.i = a.i GROUP BY 1, 2)
SELECT ca.i AS i, r.i AS j, round(SUM(ca.v * r.v), {DIGITS}) AS v FROM ca JOIN r ON ca.j = r.j GROUP BY 1, 2
""",
    "cur_row_probs": _probs_sql("i"),
    "cur_col_probs": _probs_sql("j"),
    "cur_sample_rows": _sample_sql("i", RRANK),
    "cur_sample_cols": _sample_sql("j", CRANK),
    "cur_c": f"""
WITH a AS ({_A}), s AS ({_sample_sql('j', CRANK)})
SELECT a.i AS i, CAST(s.pos AS BIGINT) AS j, a.v AS v FROM a JOIN s ON a.j = s.idx WHERE a.v <> 0
""",
    "cur_r": f"""
WITH a AS ({_A}), s AS ({_sample_sql('i', RRANK)})
SELECT CAST(s.pos AS BIGINT) AS i, a.j AS j, a.v AS v FROM a JOIN s ON a.i = s.idx WHERE a.v <> 0
""",
    # cur_u, cur_error: driver-side pseudo-inverse of sample-sized factors -> rows-only
}
