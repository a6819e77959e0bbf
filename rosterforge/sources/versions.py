"""Published tables: a write is seen whole or not at all.

A version is written to a folder of its own; then one small commit file names
it.  Readers take the folder of the newest commit, so they never see a folder
that is being written, a failed write changes nothing for them, and those who
have begun to read an older version go on.  All reading and writing is Spark's,
on any store that it reaches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.schema import CATALOG
from rosterforge.sources.catalog import CSV, sanitized_rows

COMMIT = "version long, folder string, format string, at timestamp"


class Conflict(RuntimeError):
    """Another writer has published since the caller read."""


def _files(spark: SparkSession, path: str):
    """The store of a path, and the path, by Hadoop's names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def history(spark: SparkSession, root: str) -> DataFrame:
    """``version, folder, format, at``: the commits of a table (no rows before the first)."""
    fs, commits = _files(spark, f"{root}/_commits")
    if not fs.exists(commits):
        return spark.createDataFrame([], COMMIT)
    # a commit that is being written stands in a folder that readers skip
    return spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(f"{root}/_commits")


def latest(spark: SparkSession, root: str) -> int:
    """The number of the newest version; 0 before the first."""
    return history(spark, root).agg(F.max("version")).first()[0] or 0


def _commit(spark: SparkSession, root: str, version: int, folder: str, kind: str) -> None:
    row = spark.createDataFrame([(version, folder, kind)], "version long, folder string, format string").withColumn("at", F.current_timestamp())
    try:
        row.coalesce(1).write.mode("errorifexists").json(f"{root}/_commits/v{version:012d}")
    except Exception as e:
        if "PATH_ALREADY_EXISTS" in str(e):
            raise Conflict(f"version {version} is there already") from e
        raise


def publish(df: DataFrame, root: str, columns: Iterable[str] | None = CATALOG, kind: str = "parquet", seen: int | None = None, by: Iterable[str] = ()) -> int:
    """Publishes ``df`` as the table's next version and returns its number.

    With ``columns`` the rows get those columns in order, absent ones empty, every
    cell sanitized; None writes them as they are, in folders by the columns ``by``.  ``seen`` is the version that the
    caller's rows derive from: if another has been published since, nothing is
    (``Conflict``).  If writing fails, readers keep the version that they had."""
    spark = df.sparkSession
    if kind not in ("parquet", "csv"):
        raise ValueError(f"no such kind of table: {kind}")
    before = latest(spark, root)
    if seen is not None and seen != before:
        raise Conflict(f"version {before} has been published since {seen}")
    out = df if columns is None else sanitized_rows(df, columns).select(*[F.col(f"`{c}`") for c in columns])
    folder = f"data/{uuid.uuid4().hex}"
    writer = out.write.mode("errorifexists")
    writer = writer.options(header=True, quote='"', escape='"', emptyValue="") if kind == "csv" else writer
    writer = writer.partitionBy(*by) if by else writer
    writer.format(kind).save(f"{root}/{folder}")
    _commit(spark, root, before + 1, folder, kind)
    return before + 1


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of a published table, or an older one."""
    found = history(spark, root)
    found = found.orderBy(F.desc("version")).limit(1) if version is None else found.where(F.col("version") == version)
    row = found.first()
    if row is None:
        raise FileNotFoundError(f"no version {version or ''} of {root}")
    options = CSV if row["format"] == "csv" else {}
    return spark.read.options(**options).format(row["format"]).load(f"{root}/{row['folder']}")


def restore(spark: SparkSession, root: str, version: int) -> int:
    """Publishes an older version's rows again, without copying them."""
    row = history(spark, root).where(F.col("version") == version).first()
    if row is None:
        raise FileNotFoundError(f"no version {version} of {root}")
    number = latest(spark, root) + 1
    _commit(spark, root, number, row["folder"], row["format"])
    return number


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Removes folders that none of the newest ``keep`` versions names, those of failed writes
    among them; returns how many.  Not to be run while a version is being written."""
    if keep < 1:
        raise ValueError("the newest version stays")
    rows = history(spark, root).orderBy(F.desc("version")).limit(keep).collect()
    kept = {r["folder"].rpartition("/")[2] for r in rows}
    fs, data = _files(spark, f"{root}/data")
    gone = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName() not in kept] if rows and fs.exists(data) else []
    for path in gone:
        fs.delete(path, True)
    return len(gone)
