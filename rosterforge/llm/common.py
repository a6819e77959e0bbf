"""What several operators of this subpackage share: reading, lineage cuts, row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the word separator of every operator here (fixed value).
SPACE = "[\\x20\\x09-\\x0D]"


#: Rows of whole texts that pass between Spark and Python at a time.  Both hold a batch
#: outside the executor's heap, so this bounds what a task needs beside it.
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any store works.  Sets the session's
    Arrow batches to ``BATCH_ROWS``: the default suits rows of numbers, not of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


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
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage of a large table: written to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def row_key(*cols: str) -> Column:
    """A key for rows whose id may be null or repeated: equal only for equal rows
    (up to a 64-bit hash), so equal rows get equal decisions."""
    return F.xxhash64(*[F.col(c) for c in cols])


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{SPACE.replace('[', '[^')}++")), F.lit(0)).cast("long")
