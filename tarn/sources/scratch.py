"""A private folder for a query's own tables, where every executor can reach it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from ..errors import TarnError


def private_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the session's ``spark.checkpoint.dir``.

    Where that is unset, a local session gets one of our own; a cluster's machines share no such folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise TarnError("invalid_connection_options", "spark.checkpoint.dir is unset: it names the folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "tarn-scratch")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
