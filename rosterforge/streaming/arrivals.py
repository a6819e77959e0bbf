"""Structured Streaming of incoming records into a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterforge.operators.match import append_new
from rosterforge.schema import ROW_ID
from rosterforge.sources.catalog import sanitized_rows


def incoming(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    """Record files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def append_arrivals(stream: DataFrame, catalog: str, checkpoint: str, now: bool = True) -> StreamingQuery:
    """Appends the arrivals whose names the catalog lacks.  A batch that is run again finds
    its rows in the catalog and adds none, so each row is added once."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            existing = spark.read.parquet(catalog)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            existing = spark.createDataFrame([], sanitized_rows(batch).schema)
        top = existing.agg(F.coalesce(F.max(ROW_ID), F.lit(-1).cast("long"))).first()[0]
        fresh = sanitized_rows(append_new(batch, existing))
        fresh.withColumn(ROW_ID, F.monotonically_increasing_id() + top + 1).write.mode("append").parquet(catalog)

    out = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if now else out).start()
