"""Order statistics of every ordered type against sorting, and mergeable states."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkmine.operators import quantiles as Q
from sparkmine.operators import selection as S

rnd = random.Random(9)
DOUBLES = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, -(2.0**-1022), 1.5 * 2.0**-1030, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf]
DOUBLES += [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randrange(-320, 308) for _ in range(150)] + [2.0**e for e in (-60, -1, 0, 1, 52, 1023)] + [math.nextafter(2.0**e, 0) for e in (-60, 1, 52, 1023)]
VALUES = {
    "bigint": [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(120)] + [(1 << 63) - 1, -(1 << 63), 0, 7, 7, 7],
    "int": [rnd.randrange(40, 60) for _ in range(300)],
    "double": DOUBLES,
    "float": [1.5, -2.25, 0.1, 3e38, -1e-44, 1.5],
    "string": ["", "a", "ab", "abc", "abcd", "abcde", "b", "é", "ü", "日本", "\x00", "a\x00", "zz" * 50, "zz" * 50 + "a", "ab", "\U0001f600"] + ["same prefix " + str(i) for i in range(60)],
    "decimal(12,2)": [Decimal(rnd.randrange(-10**11, 10**11)) / 100 for _ in range(80)],
    "decimal(30,14)": [Decimal(rnd.randrange(-10**25, 10**25)).scaleb(-14) for _ in range(80)] + [Decimal(-1), Decimal("-0.00000000000001"), Decimal(0)],
    "date": [dt.date(1970, 1, 1) + dt.timedelta(days=rnd.randrange(-40000, 40000)) for _ in range(80)],
    "boolean": [True, False, True, True],
}


def order(v):
    return v.encode() if isinstance(v, str) else v


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_every_rank_of_every_type(spark, kind, monkeypatch):
    monkeypatch.setattr(S, "FEW", 1)  # to the last digit
    values = VALUES[kind]
    df = spark.createDataFrame([(v,) for v in [*values, None]], f"x {kind}").repartition(5)
    n = len(values)
    got = {r.rank: r.value for r in S.kth_values(df, "x", spark.range(0, n + 2).select(F.col("id").alias("rank"))).collect()}
    exact = [r.x for r in df.where("x IS NOT NULL").collect()]
    assert got == dict(enumerate(sorted(exact, key=order), 1))


def test_not_a_number_is_last(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (math.inf,)], "x double")
    got = {r.rank: r.value for r in S.kth_values(df, "x", spark.range(1, 4).select(F.col("id").alias("rank"))).collect()}
    assert got[1] == 1.0 and got[2] == math.inf and math.isnan(got[3])


def test_hot_groups_narrow_ranges_and_null_groups(spark):
    rows = [(g, b, v) for g, b in (("a", 1), (None, 1), ("a", None), (None, None)) for v in [10**12 + rnd.randrange(30) for _ in range(200)] + [5] * 100]
    df = spark.createDataFrame(rows, "g string, b int, x long").repartition(4)
    wanted = df.select("g", "b").distinct().withColumn("rank", F.explode(F.array(*map(F.lit, (1, 100, 101, 150, 300, 301)))))
    got = {(r.g, r.b, r.rank): r.value for r in S.kth_values(df, "x", wanted, ["g", "b"]).collect()}
    want = {}
    for key in {(g, b) for g, b, _ in rows}:
        own = sorted(v for g, b, v in rows if (g, b) == key)
        want |= {(*key, k): own[k - 1] for k in (1, 100, 101, 150, 300)}
    assert got == want


def test_only_few_values_are_put_in_order(spark, monkeypatch):
    monkeypatch.setattr(S, "FEW", 50)
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 3).alias("x"))
    found = S.kth_values(df, "x", spark.createDataFrame([(0, 70_000), (1, 1)], "g long, rank long"), ["g"])
    assert sorted(tuple(r) for r in found.collect()) == [(0, 70_000, 419_994), (1, 1, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") >= 1 and all("_g" in line and "_cell" in line for line in plan.splitlines() if "windowspecdefinition" in line)


def test_empty_input_and_unknown_types(spark):
    none = spark.createDataFrame([], "x long")
    assert S.kth_values(none, "x", spark.range(1, 3).select(F.col("id").alias("rank"))).collect() == []
    assert Q.exact_quantiles(none, "x").collect() == [] or Q.exact_quantiles(none, "x").first()["p50"] is None
    with pytest.raises(ValueError):
        S.kth_values(spark.sql("SELECT map(1, 2) AS x"), "x", spark.range(1, 2).select(F.col("id").alias("rank")))


def test_merged_states(spark):
    values = [rnd.gauss(0, 1) for _ in range(20_000)]
    df = spark.createDataFrame([(i % 3, i % 50, v) for i, v in enumerate(values)], "g int, day int, x double")
    states = Q.quantile_states(df, "x", ["day"], ["g"])
    assert states.count() == 150
    probs = (0.01, 0.25, 0.5, 0.9, 0.999)
    for r in Q.merged_quantiles(states, probs, ["g"]).collect():
        own = sorted(v for i, v in enumerate(values) if i % 3 == r.g)
        assert r.n == len(own)
        for p in probs:
            q = r[f"p{p * 100:.10g}".replace(".", "_")]
            assert abs(sum(v <= q for v in own) / len(own) - p) <= Q.RANK_ERROR
    some = Q.merged_quantiles(states.where("day < 10"), (0.5,)).first()
    assert some.n == sum(i % 50 < 10 for i in range(len(values)))
