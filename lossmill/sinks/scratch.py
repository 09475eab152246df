"""A fresh shared folder for tables that only live as long as a run."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder. A cluster has no such
    way out: its executors would each write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        return tempfile.mkdtemp(prefix=f"{label}-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
