"""Session defaults and a shared working folder.

Library code never creates its own session; ``local_session`` is for tests,
benchmarks and scripts.  ``work_dir`` resolves the shared folder a cluster
names in ``spark.checkpoint.dir`` and only invents one (under the system temp
folder) when the session has none, as in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for correctness of comparisons and for plan quality.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tablesync") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the session settings the operators rely on (UTC, AQE)."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    When a session on one machine has none (tests), a fresh temp folder is
    created and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tablesync-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tablesync/{name}/{uuid.uuid4().hex}"
