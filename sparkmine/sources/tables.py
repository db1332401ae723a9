"""Parquet table access for the test-data layout ``<sf_dir>/<name>.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table lazily; Catalyst prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a frame whose scan yields fewer tasks than the cluster has cores.

    Used before CPU-heavy per-row work (shingling). The scan's own split count
    decides (a large splittable file has many splits), so only an input smaller
    than one split per core is dealt out; anything larger is not shuffled.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
