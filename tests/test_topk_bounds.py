import random

import pytest

from sparkmine.operators import graph as G
from sparkmine.operators.topk_bounds import recommend_topk_bounded


def edges_df(spark, edges):
    return spark.createDataFrame(edges, "user long, friend long")


def both(spark, edges, k):
    e = edges_df(spark, edges)
    rounds = []
    got = sorted(map(tuple, recommend_topk_bounded(e, k, rounds).collect()))
    want = sorted(map(tuple, G.recommend_topk(G.mutual_friend_counts(e), k).collect()))
    return got, want, rounds


@pytest.mark.parametrize("seed,k", [(1, 3), (2, 1), (3, 10)])
def test_same_rows_on_random_graphs(spark, seed, k):
    rnd = random.Random(seed)
    edges = [(u, rnd.randrange(60)) for u in range(60) for _ in range(rnd.choice([1, 2, 3, 9, 40]))]
    edges += edges[:20] + [(5, 5), (None, 3), (4, None)]
    got, want, _ = both(spark, edges, k)
    assert got == want


def test_hub_lists_form_few_pairs(spark):
    """Everyone is in one hub's list, some are in a second long one and in small circles: few pairs, same rows."""
    rnd = random.Random(7)
    n, k = 400, 3
    edges = [(0, u) for u in range(1, n)]
    for c in range(1, n, 8):
        circle = range(c, min(c + 8, n))
        edges += [(1000 + c + t, u) for u in circle for t in range(3) if rnd.random() < 0.9]
    edges += [(u, u + 1) for u in range(1, n, 5)]
    got, want, rounds = both(spark, edges, k)
    assert got == want
    all_pairs = G.two_hop_pairs(edges_df(spark, edges)).count()
    assert sum(p for _, p in rounds) * 10 <= all_pairs


def test_hub_alone(spark):
    """Only the hub's list: the first k members by id, and no pair at all."""
    got, want, rounds = both(spark, [(0, u) for u in range(1, 200)], 4)
    assert got == want and sum(p for _, p in rounds) == 0


def test_no_edges_and_bad_k(spark):
    assert both(spark, [], 2)[0] == []
    with pytest.raises(ValueError):
        recommend_topk_bounded(edges_df(spark, []), 0)
