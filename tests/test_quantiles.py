import math
import random

import pytest
from conftest import lines_df

from sparkmine.operators import quantiles as Q
from sparkmine.sources import text as io

TYPE2 = {1: (10, 10, 10), 2: (10, 15, 20), 3: (10, 20, 30), 4: (15, 25, 35), 5: (20, 30, 40), 6: (20, 35, 50),
         7: (20, 40, 60), 8: (25, 45, 65), 10: (30, 55, 80)}
LEGACY = {1: (None, None, None), 2: (20, None, None), 3: (20, 30, None), 4: (25, 35, None), 5: (30, 40, 50),
          6: (30, 45, 60), 7: (30, 50, 70), 8: (35, 55, 75), 10: (40, 65, 90)}


def _vals(spark, n):
    return spark.createDataFrame([(10 * (k + 1),) for k in range(n)], "value long")


@pytest.mark.parametrize("n", sorted(TYPE2))
def test_type2_table(spark, n):
    r = Q.exact_quantiles(_vals(spark, n), "value").first()
    assert (r["p25"], r["p50"], r["p75"]) == TYPE2[n]


@pytest.mark.parametrize("n", sorted(LEGACY))
def test_legacy_table(spark, n):
    r = Q.exact_quantiles(_vals(spark, n), "value", legacy=True).first()
    assert (r["p25"], r["p50"], r["p75"]) == LEGACY[n]


def model_type2(xs, p):
    xs = sorted(xs)
    n = len(xs)
    k = p * n
    if abs(k - round(k)) < 1e-12:
        k = int(round(k))
        lo, hi = k, k + 1
    else:
        lo = hi = math.ceil(k)
    lo, hi = min(max(lo, 1), n), min(max(hi, 1), n)
    return (xs[lo - 1] + xs[hi - 1]) / 2


def test_many_buckets_grouped_and_skewed(spark):
    rnd = random.Random(5)
    rows = [("hot", 7) for _ in range(400)] + [(g, rnd.randint(-50, 50)) for g in "abc" for _ in range(rnd.randint(1, 60))]
    rows += [("hot", rnd.randint(0, 1000)) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, x long")
    got = {r["g"]: (r["p25"], r["p50"], r["p75"]) for r in Q.exact_quantiles(df, "x", by="g").collect()}
    for g in {r[0] for r in rows}:
        xs = [x for gg, x in rows if gg == g]
        assert got[g] == tuple(model_type2(xs, p) for p in (0.25, 0.5, 0.75))


def test_negation_symmetry(spark):
    rnd = random.Random(9)
    xs = [rnd.randint(-100, 100) for _ in range(37)]
    a = Q.exact_quantiles(spark.createDataFrame([(x,) for x in xs], "x long"), "x").first()
    b = Q.exact_quantiles(spark.createDataFrame([(-x,) for x in xs], "x long"), "x").first()
    assert a["p25"] == -b["p75"] and a["p50"] == -b["p50"]


def test_number_lines_and_sink(spark):
    lines = lines_df(spark, ["10", "20", "", " 30 ", "x", "40", "50"])
    q = Q.exact_quantiles(io.parse_numbers(lines), "value", legacy=True)
    assert io.format_quartile_line(q, ["p25", "p50", "p75"]).first()["value"] == "30\t40\t50\t"


def test_empty_input_gives_no_group(spark):
    df = spark.createDataFrame([], "x long")
    assert Q.exact_quantiles(df, "x").count() == 0


def test_decimal_values_and_nulls(spark):
    from decimal import Decimal

    rows = [(Decimal("1.50"),), (None,), (Decimal("2.25"),), (Decimal("-3.00"),), (Decimal("10.00"),)]
    r = Q.exact_quantiles(spark.createDataFrame(rows, "x decimal(10,2)"), "x").first()
    assert (r["p25"], r["p50"], r["p75"]) == (-0.75, 1.875, 6.125)


def test_approx_quantiles_close(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)], "x double")
    r = Q.approx_quantiles(df, "x").first()
    assert abs(r["p50"] - 500) <= 2 and abs(r["p25"] - 250) <= 2
