"""Intermediate tables in the shared folder the cluster names.

Written tables cut lineage and survive the loss of executors.  The folder is
``spark.checkpoint.dir``; only a session on the local master may go without it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path for one table, stream or run state."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tallyweir/{purpose}-{uuid.uuid4().hex}"


def written(table: DataFrame, purpose: str) -> DataFrame:
    """Write ``table`` once and read it back, so that several uses do not recompute it."""
    path = shared_folder(table.sparkSession, purpose)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
