"""Where the conformance queries put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ratingloom-{application_id}-")


def shared_root(spark: SparkSession) -> str:
    """The shared folder the session names; a local folder only on a local master."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _local_root(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
