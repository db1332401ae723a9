"""Exact quartile queries on ``orders`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import quantiles as Q
from sparkmine.operators import selection as S
from sparkmine.session import materialize
from sparkmine.sources import text as io
from sparkmine.sources.tables import table


def quartiles_global(spark, sf_dir):
    return Q.exact_quantiles(table(spark, sf_dir, "orders"), "o_totalprice")


def quartiles_by_flag(spark, sf_dir):
    return Q.exact_quantiles(table(spark, sf_dir, "lineitem"), "l_quantity", by="l_returnflag")


def quartiles_by_priority(spark, sf_dir):
    return Q.exact_quantiles(table(spark, sf_dir, "orders"), "o_totalprice", by="o_orderpriority")


def _qty(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("bigint").alias("value"))


def quartiles_legacy(spark, sf_dir):
    return Q.exact_quantiles(_qty(spark, sf_dir), "value", legacy=True)


def quartiles_line(spark, sf_dir):
    """Numbers as text files -> parse -> legacy quartiles -> ``q1 \\t q2 \\t q3 \\t``."""
    lines = _qty(spark, sf_dir).select(F.col("value").cast("string").alias("value"))
    q = Q.exact_quantiles(io.parse_numbers(io.through_files(lines, "numbers")), "value", legacy=True)
    return io.format_quartile_line(q, ["p25", "p50", "p75"])


def quartiles_written(spark, sf_dir):
    """The quartile line written to a file and read back."""
    line = quartiles_line(spark, sf_dir)
    return io.through_ordered_files(line, "quartiles", ["value"])


def name_ranks_by_segment(spark, sf_dir):
    """First, middle and last customer name of every market segment, in the order of texts."""
    own = table(spark, sf_dir, "customer").select("c_mktsegment", "c_name")
    n = F.col("n")
    ranks = own.groupBy("c_mktsegment").agg(F.count("c_name").alias("n")).select("c_mktsegment", F.explode(F.array(F.lit(1).cast("bigint"), F.ceil(n / 2), n)).alias("rank"))
    return S.kth_values(own, "c_name", ranks, ["c_mktsegment"])


def decimal_ranks_by_flag(spark, sf_dir):
    """Every hundredth part's value of signed wide decimals, by return flag."""
    price = F.col("l_extendedprice").cast("decimal(28,10)") - 30000
    own = table(spark, sf_dir, "lineitem").select("l_returnflag", price.cast("decimal(28,10)").alias("x"))
    ranks = own.groupBy("l_returnflag").agg(F.count("x").alias("n")).select("l_returnflag", F.explode(F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.ceil(i * F.col("n") / 100))).alias("rank"))
    return S.kth_values(own, "x", ranks, ["l_returnflag"]).withColumn("value", F.col("value").cast("string"))


def merged_state_ranks(spark, sf_dir):
    """Merged sketches of monthly slices: the number of rows, and whether each quartile's rank lies within the stated error."""
    own = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("x"), F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    states = materialize(Q.quantile_states(own, "x", ["month"], ["l_returnflag"]), "states")
    told = Q.merged_quantiles(states, by=["l_returnflag"])
    long = told.select("l_returnflag", "n", F.explode(F.array(*(F.struct(F.lit(p).alias("p"), F.col(f"p{int(100 * p)}").alias("q")) for p in Q.QUARTILES))).alias("e")).select("l_returnflag", "n", "e.*")
    ranks = own.join(long, "l_returnflag").groupBy("l_returnflag", "n", "p").agg(F.count_if(F.col("x") < F.col("q")).alias("below"), F.count_if(F.col("x") <= F.col("q")).alias("upto"))
    error = Q.RANK_ERROR * F.col("n")
    within = (F.col("below") <= F.col("p") * F.col("n") + error) & (F.col("upto") >= F.col("p") * F.col("n") - error)
    return ranks.select("l_returnflag", "n", "p", within.alias("within"))


def _type2_sql(src: str, x: str, by: str | None = None, legacy: bool = False) -> str:
    """Order statistics by row_number (the textbook plan) for the oracle."""
    part = f"PARTITION BY {by}" if by else ""
    sel_by = f"{by}, " if by else ""
    cols = []
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        k = f"(CAST({p} AS DECIMAL(20,18)) * n)"
        lo = f"CAST(CASE WHEN {k} = floor({k}) THEN {k} ELSE ceil({k}) END AS BIGINT)"
        hi = f"CAST(CASE WHEN {k} = floor({k}) THEN {k} + 1 ELSE ceil({k}) END AS BIGINT)"
        if legacy:
            lo, hi = f"({lo} + 1)", f"({hi} + 1)"
            a = f"max(x) FILTER (WHERE rn = {lo})"
            b = f"max(x) FILTER (WHERE rn = {hi})"
            cols.append(f"CAST((CAST({a} AS HUGEINT) + CAST({b} AS HUGEINT)) // 2 AS BIGINT) AS {name}")
        else:
            lo, hi = f"greatest(least({lo}, n), 1)", f"greatest(least({hi}, n), 1)"
            a = f"max(x) FILTER (WHERE rn = {lo})"
            b = f"max(x) FILTER (WHERE rn = {hi})"
            cols.append(f"(CAST({a} AS DOUBLE) + CAST({b} AS DOUBLE)) / 2 AS {name}")
    group = f"GROUP BY {by}" if by else ""
    return f"""
WITH v AS (SELECT {sel_by}{x} AS x, row_number() OVER ({part} ORDER BY {x}) AS rn, count(*) OVER ({part}) AS n
           FROM {src} WHERE {x} IS NOT NULL)
SELECT {sel_by}{', '.join(cols)} FROM v {group}
"""


_QTY = "(SELECT CAST(l_quantity AS BIGINT) AS value FROM lineitem)"

QUERIES = {
    "quartiles_global": quartiles_global,
    "quartiles_by_flag": quartiles_by_flag,
    "quartiles_by_priority": quartiles_by_priority,
    "quartiles_legacy": quartiles_legacy,
    "quartiles_line": quartiles_line,
    "quartiles_written": quartiles_written,
    "name_ranks_by_segment": name_ranks_by_segment,
    "decimal_ranks_by_flag": decimal_ranks_by_flag,
    "merged_state_ranks": merged_state_ranks,
}

ORACLES = {
    "quartiles_global": _type2_sql("orders", "o_totalprice"),
    "quartiles_by_flag": _type2_sql("lineitem", "l_quantity", by="l_returnflag"),
    "quartiles_by_priority": _type2_sql("orders", "o_totalprice", by="o_orderpriority"),
    "quartiles_legacy": _type2_sql(_QTY, "value", legacy=True),
    "quartiles_written": (
        "SELECT CAST(0 AS BIGINT) AS line_no, CAST(p25 AS VARCHAR) || chr(9) || CAST(p50 AS VARCHAR) || chr(9) || CAST(p75 AS VARCHAR) || chr(9) AS value "
        f"FROM ({_type2_sql(_QTY, 'value', legacy=True)})"
    ),
    "quartiles_line": (
        "SELECT CAST(p25 AS VARCHAR) || chr(9) || CAST(p50 AS VARCHAR) || chr(9) || CAST(p75 AS VARCHAR) || chr(9) AS value "
        f"FROM ({_type2_sql(_QTY, 'value', legacy=True)})"
    ),
    "name_ranks_by_segment": """
WITH v AS (SELECT c_mktsegment, c_name, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS rn, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
SELECT DISTINCT c_mktsegment, rn AS rank, c_name AS value FROM v WHERE rn = 1 OR rn = n OR rn = (n + 1) // 2""",
    "decimal_ranks_by_flag": """
WITH x AS (SELECT l_returnflag, CAST(CAST(l_extendedprice AS DECIMAL(28,10)) - 30000 AS DECIMAL(28,10)) AS x FROM lineitem),
v AS (SELECT l_returnflag, x, row_number() OVER (PARTITION BY l_returnflag ORDER BY x) AS rn, count(*) OVER (PARTITION BY l_returnflag) AS n FROM x),
w AS (SELECT DISTINCT l_returnflag, (i * n + 99) // 100 AS rank FROM (SELECT DISTINCT l_returnflag, n FROM v), range(1, 101) r(i))
SELECT w.l_returnflag, w.rank, CAST(v.x AS VARCHAR) AS value FROM w JOIN v ON v.l_returnflag = w.l_returnflag AND v.rn = w.rank""",
    "merged_state_ranks": "SELECT l_returnflag, count(*) AS n, p, true AS within FROM lineitem, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) q(p) GROUP BY l_returnflag, p",
}
