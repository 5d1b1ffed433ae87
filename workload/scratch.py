"""Folders for tables a query writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the one the session names for checkpoints.

    A session on this machine alone may go without that setting; a cluster must have it, as its
    machines share no temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all machines share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
