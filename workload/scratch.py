"""Folders for queries that write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from wardmart.sources.shared import shared_folder


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/wardmart-{uuid.uuid4().hex}"
