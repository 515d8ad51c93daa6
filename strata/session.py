"""Session helpers: a sane local/test session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata job expects: AQE for runtime re-planning (broadcast
# conversion, partition coalescing, skew splitting) and a fixed session zone so
# text -> timestamp parsing is reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "strata",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with strata's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` so each shuffle partition is ~128-256 MB at the
    target scale (AQE coalesces them down for small inputs).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one machine's process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a path every executor can reach
    (HDFS, object store); it is an error if it is not.  Only a local session
    gets a fresh local folder when it is unset.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared checkpoint root for written tables (writers make it)."""
    return f"{checkpoint_root(spark)}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package wherever the driver was started.

    On a cluster the package is shipped with the job (``--py-files``) or installed.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
