"""A new folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder's path below spark.checkpoint.dir; where that is unset, a local one in local mode (as in tests) and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/copperleaf-shared"
    return f"{root.rstrip('/')}/tables-{uuid.uuid4().hex}"
