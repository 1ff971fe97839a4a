"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names. Where it is unset, a session in one process (tests) gets a
    folder of this machine; on a cluster, whose executors would each see their own, that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path there."""
    return f"{scratch_dir(spark)}/sw-{name}-{uuid.uuid4().hex}"
