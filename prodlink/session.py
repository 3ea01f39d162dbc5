"""Session helpers: a local session for tests/bench and a shared scratch folder.

Scratch data (rendered fixtures, sink read-backs, lineage cuts) goes under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
unset (local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "prodlink") -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    ``spark.checkpoint.dir`` from the session wins. Only when it is unset
    (tests / local mode) a fresh local folder is registered with
    ``setCheckpointDir`` (the setting itself cannot change at runtime).
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="prodlink-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"
