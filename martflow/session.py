"""Session construction and the shared work folder.

On a cluster the session is created by the platform; ``build_session`` is
for tests, the bench and local runs. ``work_dir`` never invents a
machine-local folder when the cluster names one: it reads
``spark.checkpoint.dir`` and only falls back to a fresh temporary folder
when the setting is absent (local mode, tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that shape every plan: AQE re-plans joins and partition counts from
# measured shuffle sizes, splits skewed join partitions, and turns a join into a
# broadcast when a side it has measured is small. No query carries a hint.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "martflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MARTFLOW_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (``spark.checkpoint.dir``).

    Only in local mode, and only when the setting is absent, a fresh
    temporary folder is used instead (``spark.checkpoint.dir`` cannot be set
    on a running session, so the choice is remembered per application).
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if sc.applicationId in _LOCAL_FALLBACK:
        return _LOCAL_FALLBACK[sc.applicationId]
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not (sc.master or "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, name a shared "
                           "folder (HDFS/object store) that every executor can reach")
    local = tempfile.mkdtemp(prefix="martflow-ckpt-")
    sc.setCheckpointDir(local)
    _LOCAL_FALLBACK[sc.applicationId] = local
    return local


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, unique per call."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/martflow/{name}-{uuid.uuid4().hex[:12]}"
