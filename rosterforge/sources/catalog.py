"""Reading, writing and versioning catalogs.

Parquet is the working format, partitioned by chain; CSV is for import and
export.  All paths are read by Spark, so any store works.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.functions.text import sanitized
from rosterforge.schema import CATALOG, CHAIN, CHAIN_ID, REQUIRED, ROW_ID, cell, missing_columns, ordered

CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "emptyValue": "", "nullValue": "\u0000", "enforceSchema": False}


class MissingColumns(ValueError):
    """A catalog lacks columns that every step needs."""


def with_row_id(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Adds ``row_id``: unique and in reading order (or by a column), without a shuffle
    into one task.  The values leave gaps; only their order counts."""
    if order_by:
        df = df.repartitionByRange(order_by).sortWithinPartitions(order_by)
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def validated(df: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    if missing := missing_columns(df, required):
        raise MissingColumns(f"missing required columns: {', '.join(missing)}")
    return df


def with_current_names(df: DataFrame) -> DataFrame:
    """The legacy column ``Chain`` under its present name."""
    return df.withColumnRenamed("Chain", CHAIN) if "Chain" in df.columns and CHAIN not in df.columns else df


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 unless the head of a file is not valid UTF-8, then Latin-1."""
    head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 1 << 16).alias("b")).first()
    if head is None:
        return "UTF-8"
    text = bytes(head["b"])
    try:
        text.decode("utf-8")
    except UnicodeDecodeError as e:
        if e.start < len(text) - 3:  # else only the cut is in the middle of a character
            return "ISO-8859-1"
    return "UTF-8"


def read_csv(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """A catalog file: all strings, legacy names mapped, rows numbered."""
    header = spark.read.options(**CSV).csv(path).limit(0).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = with_current_names(spark.read.options(**CSV).schema(schema).csv(path))
    return with_row_id(validated(df) if validate else df)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """An import sheet: tab-separated if its first line has a tab, else commas; UTF-8 or
    Latin-1; an empty file has no rows and no columns but ``row_id``."""
    code = encoding_of(spark, path)
    first = spark.read.option("encoding", code).text(path).limit(1).collect()
    if not first or not first[0]["value"].strip():
        return spark.createDataFrame([], T.StructType([T.StructField(ROW_ID, T.LongType())]))
    sep = "\t" if "\t" in first[0]["value"] else ","
    return with_row_id(spark.read.options(**CSV, sep=sep, encoding=code).csv(path))


def names(spark: SparkSession, path: str) -> DataFrame:
    """One column of a catalog; the scan is pruned to it."""
    return read_csv(spark, path, validate=False).select("Project Name")


def sanitized_rows(df: DataFrame, columns: Iterable[str] = CATALOG) -> DataFrame:
    return ordered(df, columns).withColumns({c: sanitized(c) for c in columns})


def write_csv(df: DataFrame, path: str, columns: Iterable[str] = CATALOG, mode: str = "overwrite") -> None:
    """Canonical columns in order, absent ones empty, every cell sanitized."""
    out = sanitized_rows(df, columns).select(*[F.col(f"`{c}`") for c in columns])
    out.write.mode(mode).options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def append_csv(df: DataFrame, path: str, columns: Iterable[str] = CATALOG) -> None:
    write_csv(df, path, columns, mode="append")


def write_table(df: DataFrame, path: str) -> None:
    """The working table, one folder per chain; only the chains in ``df`` are replaced."""
    (
        sanitized_rows(df)
        .withColumn(CHAIN_ID, cell(CHAIN_ID) if CHAIN_ID in df.columns else cell(CHAIN))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(CHAIN_ID)
        .parquet(path)
    )


def read_chain(spark: SparkSession, path: str, chain_id: str) -> DataFrame:
    """One chain's rows; the other folders are not read."""
    return spark.read.parquet(path).where(F.col(CHAIN_ID) == chain_id)


def snapshot(df: DataFrame, root: str, stage: str, run: str) -> DataFrame:
    """Writes a stage's table and reads it again; earlier stages stay for ``restore``."""
    path = f"{root}/stage={stage}/run={run}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def restore(spark: SparkSession, root: str, stage: str, run: str) -> DataFrame:
    return spark.read.parquet(f"{root}/stage={stage}/run={run}")


def export(tables: list[DataFrame]) -> DataFrame:
    """The union of chain tables: canonical columns, then others as first seen; missing cells are empty."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    out = ordered(out)
    texts = [c for c, kind in out.dtypes if kind == "string"]
    return out.withColumns({c: cell(c) for c in texts})


def freshest(versions: DataFrame, max_age_days: int = 7, now: str = "current_timestamp()", by: list[str] | None = None) -> DataFrame:
    """Of snapshot versions (``version, fetched_at``) the newest, for each value of ``by``, and how
    to use it: reuse while young enough, else rebuild with it as the fallback."""
    row = F.struct(*versions.columns)
    newest = versions.groupBy(*(by or [])).agg(F.max_by(row, F.struct("fetched_at", "version")).alias("_r")).where("_r IS NOT NULL").select("_r.*")
    age = F.datediff(F.expr(now), F.col("fetched_at"))
    return newest.withColumn("action", F.when((F.lit(max_age_days) > 0) & (age <= max_age_days), "reuse").otherwise("rebuild"))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by row id (a top-k, not a sort)."""
    return df.orderBy(ROW_ID).limit(n)


def in_order(df: DataFrame) -> DataFrame:
    return df.orderBy(ROW_ID)
