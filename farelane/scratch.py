"""Where a job may leave intermediate tables, checkpoints and state."""

from __future__ import annotations

import tempfile
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local_base() -> tempfile.TemporaryDirectory:
    """Goes with the process that made it."""
    return tempfile.TemporaryDirectory(prefix="farelane-", ignore_cleanup_errors=True)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. A temporary
    folder of this machine is used only in local mode, where all tasks run here.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base().name
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme under which Spark finds it, for code that opens files by itself.

    Spark reads a path without a scheme in the cluster's default file system, others on the
    machine's own disk; where Spark puts a small file tells.
    """
    if "://" in folder:
        return folder
    probe = f"{folder.rstrip('/')}/place-{uuid4().hex}"
    spark.range(1).write.parquet(probe)
    written = spark.read.parquet(probe).select("_metadata.file_path").first()[0]
    return written.split("/place-", 1)[0]
