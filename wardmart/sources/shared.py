"""The folder for intermediate tables: always on storage that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or spark.sparkContext.getCheckpointDir())
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder the executors share")
    return tempfile.mkdtemp(prefix="wardmart-")
