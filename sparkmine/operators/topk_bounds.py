"""Top-k friend recommendation that leaves out the pairs that cannot matter.

Lists are taken by rising length, level by level (a level holds lengths within a factor of ``GROWTH``).
After a level, a user has a count so far for every candidate met, and some lists left. A candidate's
count can still rise by the lists that both have left, and one never met can reach no more than
the user's lists left. A user is settled, and takes no part in any longer list, as soon as

* no list is left: the counts so far are final;
* the k-th best count so far exceeds the lists left: no new candidate can enter. Those met that can
  still reach the k-th best are looked up in the lists left (a join on list and candidate, no pairs);
* one list is left: a candidate not met has count 1 there, so of all those the first k by id can
  rank, and they lie in the list's first ``k + 1 + direct friends`` members. Candidates met are looked up.

So a list of n users (a hub) costs about n * k rows, not n * n, unless its users still have several
lists left and too few candidates. Every bound is exact: the rows equal ``recommend_topk`` of all counts.

Ids are not null (rows with a null are left out, as the equi-joins of the plain form do); repeated
edges and self-loops count once and not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.operators.graph import DEFAULT_TOP_K, normalize_edges, recommend_topk
from sparkmine.operators.numbering import numbered
from sparkmine.operators.skew import hot_keys, salted_join
from sparkmine.session import materialize

# Lengths of one level lie within this factor, so n users need about log8(n) rounds.
GROWTH = 8


def _members(edges: DataFrame) -> DataFrame:
    """``(via, member, n, place, level)``: every entry of a list of two or more, its place in it by id."""
    e = normalize_edges(edges).where("user IS NOT NULL AND friend IS NOT NULL")
    placed = numbered(e.select(F.struct(F.col("user").alias("via"), F.col("friend").alias("member")).alias("entry")), "entry")
    flat = placed.select("entry.via", "entry.member", "no")
    lists = flat.groupBy("via").agg(F.min("no").alias("start"), F.count(F.lit(1)).alias("n")).where("n >= 2")
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(float(GROWTH)))).cast("int")
    return materialize(flat.join(lists, "via").select("via", "member", "n", (F.col("no") - F.col("start")).alias("place"), level.alias("level")), "members")


def _state(partial: DataFrame, left: DataFrame, k: int) -> DataFrame:
    """``(user, left, bar)`` of open users: lists left and the k-th best count so far (null: fewer than k candidates)."""
    w = Window.partitionBy("user").orderBy(F.desc("c"), F.asc("cand"))
    bar = partial.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).where(F.col("r") == k).select("user", F.col("c").alias("bar"))
    return left.join(bar, "user", "left")


def _looked_up(cands: DataFrame, rest: DataFrame) -> DataFrame:
    """``(user, cand, n_mutual)``: counts so far plus the lists of ``rest`` that hold both."""
    mine = rest.select(F.col("member").alias("user"), "via")
    asked = cands.select("user", "cand").join(mine, "user")
    found = asked.join(rest.select("via", F.col("member").alias("cand")), ["via", "cand"]).groupBy("user", "cand").agg(F.count(F.lit(1)).alias("more"))
    return cands.join(found, ["user", "cand"], "left").select("user", "cand", (F.col("c") + F.coalesce("more", F.lit(0))).alias("n_mutual"))


def _first_of_list(users: DataFrame, rest: DataFrame, direct: DataFrame, k: int) -> DataFrame:
    """``(user, cand)``: for users with one list left, the members that can be among its first k strangers."""
    own = direct.groupBy("user").agg(F.count(F.lit(1)).alias("_direct"))
    mine = users.select("user").join(rest.select(F.col("member").alias("user"), "via", "n"), "user").join(own, "user", "left")
    upto = F.least(F.col("n"), F.lit(k + 1) + F.coalesce("_direct", F.lit(0)))
    asked = mine.select("user", "via", F.explode(F.sequence(F.lit(0).cast("bigint"), upto - 1)).alias("place"))
    # a place of a hub is asked for by all of its users: the join is tiled
    there = rest.select("via", "place", F.col("member").alias("cand"))
    met = salted_join(asked, there, ["via", "place"], hot_keys(asked, ["via", "place"], there))
    return met.where("user <> cand").select("user", "cand").join(direct, ["user", "cand"], "left_anti")


def recommend_topk_bounded(edges: DataFrame, k: int = DEFAULT_TOP_K, rounds: list | None = None) -> DataFrame:
    """``(user, cand, n_mutual, rank)``: the rows of ``recommend_topk(mutual_friend_counts(edges), k)``.

    ``rounds`` receives ``(level, pairs formed)`` of every level. Each level is stored, so a lost executor costs one level;
    the driver sees the levels only (at most some twenty numbers).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = edges.sparkSession
    members = _members(edges)
    direct = materialize(edges.select("user", F.col("friend").alias("cand")).distinct(), "direct")
    levels = [r["level"] for r in members.select("level").distinct().orderBy("level").collect()]
    nothing = spark.createDataFrame([], "user bigint, cand bigint, c bigint")
    partial, settled = nothing, []
    is_open = members.select(F.col("member").alias("user")).distinct()
    for level in [None, *levels]:
        if level is not None:
            here = members.where(F.col("level") == level)
            asks = here.select("via", F.col("member").alias("user")).join(is_open, "user", "left_semi").select("via", "user")
            others = here.select("via", F.col("member").alias("cand"))
            pairs = salted_join(asks, others, ["via"], hot_keys(asks, ["via"], others)).where("user <> cand")
            met = materialize(pairs.groupBy("user", "cand").agg(F.count(F.lit(1)).alias("c")), "met")
            if rounds is not None:
                rounds.append((level, met.agg(F.sum("c")).first()[0] or 0))
            new = met.join(direct, ["user", "cand"], "left_anti")
            partial = partial.join(is_open, "user", "left_semi").union(new).groupBy("user", "cand").agg(F.sum("c").alias("c"))
            partial = materialize(partial, "partial")
        rest = members if level is None else members.where(F.col("level") > level)
        left = rest.groupBy(F.col("member").alias("user")).agg(F.count(F.lit(1)).alias("left"))
        left_of_open = is_open.join(left, "user", "left").select("user", F.coalesce("left", F.lit(0)).alias("left"))
        state = _state(partial, left_of_open, k)
        # bar > left settles; so does one list left, or none
        state = materialize(state.withColumn("done", (F.col("left") <= 1) | F.coalesce(F.col("bar") > F.col("left"), F.lit(False))), "state")
        can_rise = partial.join(state.where("done"), "user").join(left.select(F.col("user").alias("cand"), F.col("left").alias("cand_left")), "cand", "left")
        reach = F.col("c") + F.least("left", F.coalesce("cand_left", F.lit(0)))
        seen = can_rise.where(F.col("bar").isNull() | (reach >= F.col("bar"))).select("user", "cand", "c")
        one = state.where("left = 1 AND (bar IS NULL OR bar <= 1)")
        extra = _first_of_list(one, rest, direct, k).withColumn("c", F.lit(0).cast("bigint"))
        cands = seen.union(extra).groupBy("user", "cand").agg(F.max("c").alias("c"))
        settled.append(materialize(recommend_topk(_looked_up(cands, rest), k), "settled"))
        is_open = state.where("NOT done").select("user")
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out
