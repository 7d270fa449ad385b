"""Session construction and the shared scratch location."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on (ANSI stays on; the operators use try_* forms).
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "terroir",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder comes from `spark.checkpoint.dir` (or one already set on the
    context). Only when neither is set -- local runs and tests -- a fresh
    folder under the system temp directory is created, and removed at exit.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(a machine-local folder is not visible to other executors)")
        conf_dir = tempfile.mkdtemp(prefix="terroir-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)  # made here, so removed here
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written
    intermediate tables (never a machine-local folder on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "DEFAULT_CONF"]
