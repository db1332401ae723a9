"""Operator inputs derived from the test tables with plain DataFrame ops.

The SQL views in ``INPUT_SQL`` define the same inputs for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.sources.tables import table


def event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed graph: user ``user_id`` lists ``props.k`` of all its events (distinct).
    ``pos`` orders a user's list by friend id."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.select(F.col("user_id").alias("user"), F.get_json_object("props", "$.k").cast("bigint").alias("friend"))
        .distinct()
        .withColumn("pos", F.col("friend"))
    )


def events_as_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset lists: every event is one list entry, in event order
    (duplicates and self-loops kept)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("user"),
        F.col("event_id").alias("pos"),
        F.get_json_object("props", "$.k").cast("bigint").alias("friend"),
    )


INPUT_SQL = {
    "event_edges": (
        "SELECT DISTINCT user_id AS \"user\", CAST(json_extract_string(props, '$.k') AS BIGINT) AS friend "
        "FROM events"
    ),
    "event_lists": (
        "SELECT user_id AS \"user\", event_id AS pos, CAST(json_extract_string(props, '$.k') AS BIGINT) AS friend "
        "FROM events"
    ),
}
