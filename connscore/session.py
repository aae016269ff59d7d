"""Session construction and the shared scratch folder.

Intermediate tables (saved models, cluster dictionaries, quarantine output)
go under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (local tests) is a local folder created and
registered as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "connscore",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; falls back to the
    SparkContext's checkpoint directory; only when neither is set and the
    master is local (tests, single-machine runs) creates a local one and
    registers it.  On a cluster without a shared folder it refuses to guess.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by the cluster (HDFS / object "
            "store): models, dictionaries and checkpoints are written there")
    local = tempfile.mkdtemp(prefix="connscore-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/connscore/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    conf = spark.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return max(1, int(conf))
    except (TypeError, ValueError):
        return max(1, spark.sparkContext.defaultParallelism)
