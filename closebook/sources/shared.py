"""Where results that must outlive a task are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint directory.

    The location comes from `spark.checkpoint.dir`.  Only a local session, as
    in tests, may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="closebook-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
