"""Session helpers: a tuned builder for local runs and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "loanlake", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session for ``master`` (None: as submitted). On a cluster it sets only
    what the caller passes, so submitted settings survive; a local master gets
    laptop defaults."""
    b = SparkSession.builder.appName(app)
    conf = {}
    if master:
        b = b.master(master)
        if master.startswith("local"):
            conf = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false"}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a local-mode session (tests, laptops) with nothing set
    gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    path = tempfile.mkdtemp(prefix="loanlake-ckpt-", dir=os.environ.get("LOANLAKE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
