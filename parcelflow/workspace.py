"""Shared folder for replays, checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else the one the
    application has set for its checkpoints.

    Only where neither is set, and only in local mode, is it this machine's
    temporary folder: on a cluster other machines could not read that.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="parcelflow-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared root, never used before."""
    return f"{shared_root(spark)}/parcelflow/{label}-{uuid.uuid4().hex}"
