"""Session helpers: one place for the configuration every entry point shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Memory of a local session, whose driver does all the work; a cluster sets its own.
LOCAL_MEMORY = "8g"

_SCRATCH: list[tempfile.TemporaryDirectory] = []
_STORED: list[str] = []

# Settings every job wants; all are plain Spark SQL options.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark 4 defaults to ANSI mode: integer overflow raises instead of wrapping.
    "spark.sql.ansi.enabled": "true",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "sparkmine",
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so on a
    cluster the submit-time settings win.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local") and "SPARK_DRIVER_MEMORY" not in os.environ:
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = LOCAL_MEMORY
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is. Only a session without one (unit tests) gets a
    fresh local scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        # one process, one machine: a scratch folder that goes with the process
        _SCRATCH.append(tempfile.TemporaryDirectory(prefix="sparkmine-", ignore_cleanup_errors=True))
        sc.setCheckpointDir(_SCRATCH[-1].name)
    else:
        raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS / object store) on a cluster")
    return sc.getCheckpointDir()


def keep_until_release(path: str) -> None:
    """Note a stored intermediate that ``release`` is to delete."""
    _STORED.append(path)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables and files that this session's operators have written.

    To be called when the results that were built on them have been stored.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)


def discard(stored) -> None:
    """Delete what ``materialize`` has stored for a frame that nothing reads any more."""
    spark = stored.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in stored.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of a frame that several branches reuse (computed once, not
    once per branch), keeps later plans small, and survives executor loss: the
    table lives on the shared storage named by ``spark.checkpoint.dir``.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sparkmine/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    keep_until_release(path)
    return spark.read.parquet(path)
