"""Friend recommendation by mutual-friend counts (directed adjacency lists).

Data model: an edge table ``(user bigint, friend bigint[, pos int])`` where a row
says "``friend`` is in ``user``'s list" (``pos`` = position in that list).

Plan (all DataFrame ops, no per-user Python):
  edges --self-join on the shared friend (the *via* user)--> (user, cand, via)
        --partial+final count per (user, cand)--> mutual counts
        --left_anti join with direct edges--> candidates that are not already friends
        --row_number over user (Spark adds a partial group limit before the shuffle)--> top-k
The self-join is quadratic in a via user's degree; hub users are cut into tiles
(``operators.skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.operators.chunks import CHUNK_ENTRIES, chunked_lists
from sparkmine.operators.skew import hot_keys, salted_join
from sparkmine.session import materialize

DEFAULT_TOP_K = 10


def adjacency_to_edges(adj: DataFrame, user: str = "user", friends: str = "friends") -> DataFrame:
    """``(user, friends array<bigint>)`` -> ``(user, pos, friend)`` (one row per list entry)."""
    return adj.select(F.col(user).alias("user"), F.posexplode(friends).alias("pos", "friend"))


def normalize_edges(edges: DataFrame, multiset: bool = False) -> DataFrame:
    """Edge rows used by the two-hop join.

    Default: distinct ``(user, friend)`` without self-loops, ``pos`` rebuilt as a
    dense key is not needed (pairs are told apart by friend id).
    ``multiset=True`` keeps duplicates and self-loops and tells entries apart by
    ``pos``, which reproduces list-position semantics.
    """
    if multiset:
        if "pos" not in edges.columns:
            raise ValueError("multiset mode needs a pos column")
        return edges.select("user", "pos", "friend")
    return (
        edges.select("user", "friend")
        .where(F.col("user") != F.col("friend"))
        .distinct()
        .withColumn("pos", F.lit(0))  # unused: entries are unique by friend
    )


def two_hop_pairs(edges: DataFrame, multiset: bool = False, pairs_per_tile: int | None = None,
                  users: DataFrame | None = None, how: str = "left_semi") -> DataFrame:
    """``(user, cand, via)``: ``user`` and ``cand`` both sit in ``via``'s list.

    With ``users`` ``(user)`` only pairs of those users, or of all others (``how="left_anti"``).

    Hot via users (a third of all edges in one list) are cut into tiles of at most
    ``pairs_per_tile`` pairs, so their quadratic output is spread over many tasks.
    """
    e = normalize_edges(edges, multiset)
    a = e.select(F.col("user").alias("via"), F.col("pos").alias("pos_a"), F.col("friend").alias("user"))
    b = e.select(F.col("user").alias("via"), F.col("pos").alias("pos_b"), F.col("friend").alias("cand"))
    if users is not None:
        a = a.join(users, "user", how)
    j = salted_join(a, b, ["via"], hot_keys(a, ["via"], None if users is None else b, pairs_per_tile=pairs_per_tile))
    if multiset:
        j = j.where(F.col("pos_a") != F.col("pos_b"))
    else:
        j = j.where(F.col("user") != F.col("cand"))
    return j.select("user", "cand", "via")


def mutual_friend_counts(
    edges: DataFrame,
    multiset: bool = False,
    with_via: bool = False,
    pairs_per_tile: int | None = None,
) -> DataFrame:
    """``(user, cand, n_mutual[, mutual])`` for candidates not already in ``user``'s list.

    Counting happens before the anti join (partial aggregation right after the
    pair join), so the anti join sees one row per (user, cand).
    """
    pairs = two_hop_pairs(edges, multiset, pairs_per_tile)
    aggs = [F.count(F.lit(1)).alias("n_mutual")]
    if with_via:
        aggs.append(F.array_sort(F.collect_list("via")).alias("mutual"))
    counts = pairs.groupBy("user", "cand").agg(*aggs)
    direct = edges.select(F.col("user"), F.col("friend").alias("cand")).distinct()
    return counts.join(direct, ["user", "cand"], "left_anti")


def mutual_friend_lists(edges: DataFrame, multiset: bool = False, pairs_per_tile: int | None = None, size: int = CHUNK_ENTRIES, longest: int = CHUNK_ENTRIES) -> DataFrame:
    """``(user, cand, chunk, mutual)``: the mutual friends of every candidate in id order, at most ``size`` a row.

    The list form of ``mutual_friend_counts``; a candidate with millions of mutual friends has many rows. A user who sits in
    at most ``longest`` lists has no longer list of mutual friends, which is grouped as it is and then cut; others' lists are cut by place (``chunks``).
    """
    edges = materialize(edges, "edges")
    direct = edges.select(F.col("user"), F.col("friend").alias("cand")).distinct()

    def pairs(users=None, how="left_semi"):
        return two_hop_pairs(edges, multiset, pairs_per_tile, users, how).join(direct, ["user", "cand"], "left_anti")

    def by_place(pairs):
        return chunked_lists(pairs, ["user", "cand"], ["via"], "mutual", size).withColumn("mutual", F.col("mutual.via"))

    if multiset:  # a pair may have any number of entries in one list
        return by_place(pairs())
    hubs = materialize(normalize_edges(edges).groupBy(F.col("friend").alias("user")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > longest).select("user"), "hubs")
    some = not hubs.isEmpty()
    # the anti join has dealt the pairs out by user and candidate: they are grouped where they lie
    lists = (pairs(hubs, "left_anti") if some else pairs()).groupBy("user", "cand").agg(F.array_sort(F.collect_list("via")).alias("_l"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / size).cast("int")),
                      lambda c: F.struct(c.cast("bigint").alias("chunk"), F.slice("_l", c * size + 1, size).alias("mutual")))
    short = lists.select("user", "cand", F.explode(cut).alias("_c")).select("user", "cand", "_c.chunk", "_c.mutual")
    return short.unionByName(by_place(pairs(hubs))) if some else short


def recommend_topk(counts: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """Rank candidates by mutual count desc, then id asc; keep the first ``k``.

    ``row_number() <= k`` lets Spark plan a partial WindowGroupLimit before the
    shuffle, so a user with millions of candidates ships only k rows per task.
    """
    w = Window.partitionBy("user").orderBy(F.desc("n_mutual"), F.asc("cand"))
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("user", "cand", "n_mutual", "rank")
    )


def recommendation_keys(edges: DataFrame, multiset: bool = False) -> DataFrame:
    """Users that get an output line: users with a non-empty list, plus users that
    appear in some list next to another entry (they receive pair messages)."""
    e = normalize_edges(edges, multiset)
    owners = e.select("user")
    # a list entry is "paired" when its list has at least two entries
    list_len = e.groupBy("user").agg(F.count(F.lit(1)).alias("_len")).where(F.col("_len") >= 2)
    paired = e.join(list_len, "user", "left_semi").select(F.col("friend").alias("user"))
    return owners.union(paired).distinct()


def recommend_lists(edges: DataFrame, k: int = DEFAULT_TOP_K, multiset: bool = False, pairs_per_tile: int | None = None) -> DataFrame:
    """``(user, recs)`` with ``recs`` the top-k ids joined by ``,`` in rank order;
    every key user is kept, with ``''`` when nothing is recommended."""
    top = recommend_topk(mutual_friend_counts(edges, multiset, pairs_per_tile=pairs_per_tile), k)
    lists = top.groupBy("user").agg(  # at most k rows per user after the group limit
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand"))), lambda x: x["cand"].cast("string"))).alias("recs")
    )
    return (
        recommendation_keys(edges, multiset)
        .join(lists, "user", "left")
        .select("user", F.coalesce(F.col("recs"), F.lit("")).alias("recs"))
    )
