"""Cases that used to give wrong or cut results."""

import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sparkmine.operators import clustering, cur, graph, quantiles, skew
from sparkmine.sources import text as io


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_group_keeps_its_quantiles(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), ("a", 5), ("a", None)], "g string, x int")
    assert sorted(rows(quantiles.exact_quantiles(df, "x", by="g")), key=repr) == [("a", 5.0, 5.0, 5.0), (None, 1.0, 2.0, 3.0)]


def test_legacy_average_is_exact_beyond_doubles(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big,)] * 6, "x long")
    assert rows(quantiles.exact_quantiles(df, "x", legacy=True)) == [(big, big, big)]
    top = (1 << 63) - 1
    assert rows(quantiles.exact_quantiles(spark.createDataFrame([(top,)] * 6, "x long"), "x", legacy=True)) == [(top, top, top)]


@pytest.mark.parametrize("buckets", [2, 256])
def test_quantiles_of_any_ordered_type(spark, buckets):
    from sparkmine.operators.ranks import prefix_sums

    days = [datetime.date(2020, 1, 1) + datetime.timedelta(i) for i in range(40)]
    df = spark.createDataFrame([(d, datetime.datetime.combine(d, datetime.time(1)), float(i), 1) for i, d in enumerate(days)], "d date, t timestamp, f double, w int")
    for key in "dtf":
        got = sorted(rows(prefix_sums(df, key, "w", buckets=buckets).select(key, "cum_lo", "cum_hi", "total")))
        assert [r[1:] for r in got] == [(i + 1, i + 1, 40) for i in range(40)]


@pytest.mark.parametrize("scale", [1e-5, 1.0, 1e5, 1e150])
def test_probabilities_do_not_depend_on_the_scale(spark, scale):
    a = spark.createDataFrame([(0, 0, scale), (1, 0, 2 * scale), (2, 0, 4 * scale), (3, 0, 0.0)], "i long, j long, v double")
    got = dict(rows(cur.probabilities(a, "i").select("idx", "p")))
    assert [round(got[i], 12) for i in range(4)] == [round(x / 21, 12) for x in (1, 4, 16, 0)]
    with pytest.raises(ValueError):
        cur.energies(a.where("i = 3"), "i")


def test_rejected_lines_are_counted_in_the_same_pass(spark):
    lines = spark.createDataFrame([("1\t2,3",), ("8\t3,y",), ("x\t1",), ("7",)], "value string")
    seen = Observation()
    assert io.parse_adjacency(lines, rejects=seen).collect() and seen.get["rejected"] == 2
    seen = Observation()
    assert len(io.parse_numbers(spark.createDataFrame([("1",), ("z",), ("",)], "value string"), rejects=seen).collect()) == 1
    assert seen.get == {"lines": 2, "rejected": 1}
    with pytest.raises(ValueError):
        io.parse_adjacency(lines, strict=True)


def test_texts_with_line_ends_survive_files(spark):
    texts = [(1, "a\nb"), (2, "tab\tx"), (3, "back\\n slash \\"), (4, "\\s\r\n"), (5, "plain")]
    df = spark.createDataFrame(texts, "id long, para string")
    assert sorted(rows(io.parse_paragraphs(io.through_files(io.format_paragraphs(df, escape=True)), escaped=True))) == texts


def test_evidence_lines_are_in_order(spark):
    ev = spark.createDataFrame([(1, 2, "b\nc", 5, 1), (1, 3, "x", 0, 0), (1, 2, "a", 1, 7)], "idA long, idB long, shingle string, offA int, offB int")
    assert [r[0] for r in rows(io.format_evidence(ev))] == ["<1 - 2> a <1 - 7> ", "<1 - 2> b\\nc <5 - 1> ", "<1 - 3> x <0 - 0> "]


def test_isolated_paragraphs_get_a_row(spark):
    got = clustering.with_isolated(spark.createDataFrame([(1, 0), (2, 1)], "id long, cluster int"), spark.range(4))
    assert dict(rows(got)) == {0: -1, 1: 0, 2: 1, 3: -1}


def test_tiles_bound_a_hub(spark):
    left = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    right = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("y")).union(spark.createDataFrame([(2, 1)], "k int, y long"))
    hot = skew.hot_keys(left, ["k"], right, pairs_per_tile=50_000)
    (k, nl, nr), = rows(hot)
    assert k == 1 and nl * nr >= 3000 * 2000 / 50_000 / 1.2
    got = skew.salted_join(left, right, ["k"], hot)
    assert got.count() == 6_000_000 and got.distinct().count() == 6_000_000
    # hot on the right side only
    one = spark.createDataFrame([(1, 0)], "k int, x long")
    hot = skew.hot_keys(one, ["k"], right, pairs_per_tile=100, rows_per_tile=100)
    assert rows(hot)[0][2] == 20 and skew.salted_join(one, right, ["k"], hot).count() == 2000


def test_mutual_friends_with_their_list(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (4, 2), (4, 3)], "user long, friend long")
    got = graph.mutual_friend_counts(edges, with_via=True)
    assert sorted(rows(got)) == [(2, 3, 2, [1, 4]), (3, 2, 2, [1, 4])]


def test_release_deletes_materialized_tables(spark):
    import os

    from sparkmine import session

    df = session.materialize(spark.range(5), "five")
    path = session._STORED[-1].removeprefix("file:")
    assert df.count() == 5 and os.path.isdir(path)
    session.release(spark)
    assert not os.path.exists(path) and not session._STORED
