"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join by hash, without a sort, where every shuffled part of the small side is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # HotSpot interprets methods above this size, so wide expressions run faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Timers and per-key state of the live tracker need this store.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on; sizing is left to the cluster and AQE."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A machine-local folder is made only in local mode, where there is one machine.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="contrail-")
        spark.conf.set("spark.checkpoint.dir", path)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
