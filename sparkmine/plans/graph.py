"""Friend-recommendation queries on the graph of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import graph as G
from sparkmine.operators.topk_bounds import recommend_topk_bounded
from sparkmine.plans.inputs import INPUT_SQL, event_edges, events_as_lists
from sparkmine.sources import text as io

K = G.DEFAULT_TOP_K


def friend_edges(spark, sf_dir):
    return event_edges(spark, sf_dir).select("user", "friend")


def adjacency_roundtrip(spark, sf_dir):
    """Edges -> ``user \\t f1,f2`` lines in text files -> parsed lists -> edges with list positions."""
    lines = io.through_files(io.format_adjacency(event_edges(spark, sf_dir)), "adjacency")
    adj = io.parse_adjacency(lines)
    return G.adjacency_to_edges(adj).select("user", F.col("pos").cast("int").alias("pos"), "friend")


def mutual_friend_counts(spark, sf_dir):
    return G.mutual_friend_counts(event_edges(spark, sf_dir))


def friend_recommend_topk(spark, sf_dir):
    return G.recommend_topk(G.mutual_friend_counts(event_edges(spark, sf_dir)), K)


def friend_recommend_topk_bounded(spark, sf_dir):
    """The same rows without all two-hop pairs: lists by rising length, users settled by bounds."""
    return recommend_topk_bounded(event_edges(spark, sf_dir).select("user", "friend"), K)


def friend_recommend_list(spark, sf_dir):
    return G.recommend_lists(event_edges(spark, sf_dir), K)


def friend_recommend_multiset(spark, sf_dir):
    """As-written semantics: every event is a list entry (duplicates, self-loops)."""
    return G.recommend_lists(events_as_lists(spark, sf_dir), K, multiset=True)


def friend_recommend_lines(spark, sf_dir):
    return io.through_files(io.format_recommendations(G.recommend_lists(event_edges(spark, sf_dir), K)), "recommendations")


LIST_CHUNK = 4


def mutual_friend_lists(spark, sf_dir):
    """Mutual friends of every candidate in rows of at most ``LIST_CHUNK``."""
    lists = G.mutual_friend_lists(event_edges(spark, sf_dir), size=LIST_CHUNK)
    return lists.select("user", "cand", "chunk", F.array_join(F.transform("mutual", lambda x: x.cast("string")), ",").alias("mutual"))


def friend_recommend_written(spark, sf_dir):
    """The recommendation lines in files ordered by user, read back with their line numbers."""
    recs = G.recommend_lists(event_edges(spark, sf_dir), K)
    return io.through_ordered_files(io.format_recommendations(recs, keep=("user",)), "recommendations", ["user"])


_E = INPUT_SQL["event_edges"]
_L = INPUT_SQL["event_lists"]

_COUNTS = f"""
WITH e AS ({_E}),
s AS (SELECT * FROM e WHERE "user" <> friend),
pairs AS (SELECT a.friend AS "user", b.friend AS cand FROM s a JOIN s b ON a."user" = b."user" AND a.friend <> b.friend)
SELECT "user", cand, COUNT(*) AS n_mutual FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM e d WHERE d."user" = p."user" AND d.friend = p.cand)
GROUP BY "user", cand
"""

_TOPK = f"""
SELECT "user", cand, n_mutual, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY n_mutual DESC, cand ASC) AS rk FROM ({_COUNTS})
) WHERE rk <= {K}
"""


def _lists_sql(edges_sql: str, multiset: bool) -> str:
    if multiset:
        pair = 'SELECT a.friend AS "user", b.friend AS cand FROM e a JOIN e b ON a."user" = b."user" AND a.pos <> b.pos'
        base = "e"
    else:
        pair = 'SELECT a.friend AS "user", b.friend AS cand FROM s a JOIN s b ON a."user" = b."user" AND a.friend <> b.friend'
        base = "s"
    return f"""
WITH e AS ({edges_sql}),
s AS (SELECT DISTINCT "user", friend FROM e WHERE "user" <> friend),
pairs AS ({pair}),
cnt AS (SELECT "user", cand, COUNT(*) AS n FROM pairs p
        WHERE NOT EXISTS (SELECT 1 FROM e d WHERE d."user" = p."user" AND d.friend = p.cand)
        GROUP BY "user", cand),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY n DESC, cand ASC) AS rk FROM cnt) WHERE rk <= {K}),
recs AS (SELECT "user", string_agg(CAST(cand AS VARCHAR), ',' ORDER BY rk) AS recs FROM top GROUP BY "user"),
multi AS (SELECT "user" FROM {base} GROUP BY "user" HAVING COUNT(*) >= 2),
keys AS (SELECT "user" FROM {base} UNION SELECT friend FROM {base} WHERE "user" IN (SELECT "user" FROM multi))
SELECT k."user", COALESCE(r.recs, '') AS recs FROM keys k LEFT JOIN recs r ON k."user" = r."user"
"""


QUERIES = {
    "friend_edges": friend_edges,
    "adjacency_roundtrip": adjacency_roundtrip,
    "mutual_friend_counts": mutual_friend_counts,
    "friend_recommend_topk": friend_recommend_topk,
    "friend_recommend_topk_bounded": friend_recommend_topk_bounded,
    "friend_recommend_list": friend_recommend_list,
    "friend_recommend_multiset": friend_recommend_multiset,
    "friend_recommend_lines": friend_recommend_lines,
    "mutual_friend_lists": mutual_friend_lists,
    "friend_recommend_written": friend_recommend_written,
}

ORACLES = {
    "friend_edges": _E,
    "adjacency_roundtrip": f"""
SELECT "user", CAST(row_number() OVER (PARTITION BY "user" ORDER BY friend) - 1 AS INTEGER) AS pos, friend FROM ({_E})
""",
    "mutual_friend_counts": _COUNTS,
    "friend_recommend_topk": _TOPK,
    "friend_recommend_topk_bounded": _TOPK,
    "friend_recommend_list": _lists_sql(_E, multiset=False),
    "friend_recommend_multiset": _lists_sql(_L, multiset=True),
    "friend_recommend_lines": f"SELECT CAST(\"user\" AS VARCHAR) || chr(9) || recs AS value FROM ({_lists_sql(_E, multiset=False)})",
    "mutual_friend_lists": f"""
WITH e AS ({_E}),
s AS (SELECT * FROM e WHERE "user" <> friend),
pairs AS (SELECT a.friend AS "user", b.friend AS cand, a."user" AS via FROM s a JOIN s b ON a."user" = b."user" AND a.friend <> b.friend),
p AS (SELECT *, (row_number() OVER (PARTITION BY "user", cand ORDER BY via) - 1) // {LIST_CHUNK} AS chunk FROM pairs p
      WHERE NOT EXISTS (SELECT 1 FROM e d WHERE d."user" = p."user" AND d.friend = p.cand))
SELECT "user", cand, CAST(chunk AS BIGINT) AS chunk, string_agg(CAST(via AS VARCHAR), ',' ORDER BY via) AS mutual FROM p GROUP BY "user", cand, chunk
""",
    "friend_recommend_written": f"""
SELECT row_number() OVER (ORDER BY "user") - 1 AS line_no, CAST("user" AS VARCHAR) || chr(9) || recs AS value FROM ({_lists_sql(_E, multiset=False)})
""",
}
