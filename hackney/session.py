"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# SQL settings the plans rely on; applied to any session the library is
# handed (they are runtime settings, so this works on a running cluster).
# Time zone: the raw files carry local wall time with no zone, so all parsing
# and windowing is pinned to UTC.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from planner *estimates* (an estimate after an explode or
    # a filter can be far below the real size).  AQE broadcasts a join side
    # only when its measured shuffle output is below 32 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Long text keys (medallion + licence + minute) keep state stores large;
    # RocksDB keeps them off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings every job relies on.
BASE_CONF = {
    **SQL_CONF,
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "hackney",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build or reuse a session with the library's settings.

    ``master`` is only set when given, so ``spark-submit`` on a cluster keeps
    control of it.  ``shuffle_partitions`` should be sized so one partition
    holds roughly 128-256 MB of shuffle data at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_sql_conf(spark)
    checkpoint_dir(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Set the library's SQL settings on an existing session."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster names it, or
    the folder given to ``setCheckpointDir`` (a shared file system path every
    executor can reach).  Only when it is unset
    and the master is local, as in tests, a fresh folder is made and
    registered; a cluster without the setting is an error, never a
    machine-local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: the server owns the checkpoint folder
        if not path:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        return path
    if not path:
        path = sc._conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        path = tempfile.mkdtemp(prefix="hackney-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path

