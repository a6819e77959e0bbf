"""Cutting the lineage of iterative operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.  Where that is unset,
    a temporary one serves local masters only (tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
