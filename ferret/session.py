"""Session helpers: sensible defaults for search jobs and a checkpoint folder.

The cluster names its shared checkpoint folder in ``spark.checkpoint.dir``.
We only read it; a private folder is made only when nothing is set (tests,
local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "ferret",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use your own builder."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    conf["spark.driver.memory"] = os.environ.get("FERRET_DRIVER_MEMORY", "4g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def get_session(app: str = "ferret") -> SparkSession:
    """The session for a job: the cluster's master when submitted, local otherwise."""
    b = SparkSession.builder.appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session uses.

    A private temporary folder is made only for a local master with nothing set
    (tests, local runs); a cluster must name a shared folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        # A machine-local folder is not shared between executors and driver.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ferret-ckpt-"))
    return sc.getCheckpointDir()
