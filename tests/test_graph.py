from conftest import lines_df

from sparkmine.operators import graph as G
from sparkmine.sources import text as io

SMALL = ["0\t1,2,3", "1\t0,2,3,4,5", "2\t0,1,4", "3\t0,1,4", "7", "4\t1,2,3", "5\t1,6", "6\t5", ""]
DIRTY = ["1\t2,3,3", "2\t1,9", "9\t", "4\t4,5,6"]


def recs(spark, lines, **kw):
    edges = G.adjacency_to_edges(io.parse_adjacency(lines_df(spark, lines)))
    return {r["user"]: r["recs"] for r in G.recommend_lists(edges, **kw).collect()}


def test_small_sample(spark):
    got = recs(spark, SMALL)
    assert got == {0: "4,5", 1: "6", 2: "3,5", 3: "2,5", 4: "0,5", 5: "0,2,3,4", 6: "1"}


def test_dirty_default(spark):
    assert recs(spark, DIRTY) == {1: "9", 2: "3", 3: "2", 4: "", 5: "6", 6: "5", 9: "1"}


def test_dirty_multiset(spark):
    assert recs(spark, DIRTY, multiset=True) == {1: "9", 2: "3", 3: "2,3", 4: "", 5: "4,6", 6: "4,5", 9: "1"}


def test_salted_join_same_result(spark):
    assert recs(spark, SMALL, pairs_per_tile=4) == recs(spark, SMALL)
    assert recs(spark, DIRTY, multiset=True, pairs_per_tile=1) == recs(spark, DIRTY, multiset=True)


def test_no_direct_friend_or_self(spark):
    edges = G.adjacency_to_edges(io.parse_adjacency(lines_df(spark, SMALL)))
    direct = {(r["user"], r["friend"]) for r in edges.collect()}
    for r in G.recommend_topk(G.mutual_friend_counts(edges)).collect():
        assert (r["user"], r["cand"]) not in direct and r["user"] != r["cand"]


def test_topk_limit_and_order(spark):
    edges = spark.createDataFrame([(0, i, i) for i in range(1, 30)], "user long, pos long, friend long")
    top = G.recommend_topk(G.mutual_friend_counts(edges), 10).where("user = 1").orderBy("rank").collect()
    assert [r["cand"] for r in top] == list(range(2, 12))


def test_adjacency_parse_rules(spark):
    lines = ["5\t1,,2", "6", "", "x\t1", "7\t1\t2", "8\t3,y", "9\t4\t"]
    got = {r["user"]: r["friends"] for r in io.parse_adjacency(lines_df(spark, lines)).collect()}
    assert got == {5: [1, 2], 9: [4]}


def test_recommendation_lines(spark):
    edges = G.adjacency_to_edges(io.parse_adjacency(lines_df(spark, SMALL)))
    out = {r["value"] for r in io.format_recommendations(G.recommend_lists(edges)).collect()}
    assert "5\t0,2,3,4" in out and "6\t1" in out
