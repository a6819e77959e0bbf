"""Folders of import sheets, each file with its own separator, header and encoding.

One pass over the bytes tells each file's kind: whether all its lines are valid
UTF-8, and what its first line holds.  Files of one kind are then scanned
together, so the plan has a scan per kind and not per file.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.schema import ROW_ID
from rosterforge.sources.catalog import CSV

#: Files whose numbers may be broadcast (an address and a number each).
BROADCAST_FILES = 100_000
#: Rows of a file that a row id has room for.
ROWS = 1 << 33


def file_kinds(spark: SparkSession, path: str) -> DataFrame:
    """``file, head, sep, encoding``, and ``code``, the bytes of ``head`` in hex: a row for each file under ``path`` that is not blank.

    A tab in the first line makes it tab-separated, else commas.  The encoding is
    UTF-8 if the whole file is valid, else Latin-1; a mark of byte order is no part of
    the first line."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)  # a line's bytes as they are
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"), "value")
    told = lines.groupBy("file").agg(F.min_by("value", F.struct("at", "id")).alias("head"), F.min(F.is_valid_utf8("value")).alias("valid"))
    code = F.regexp_replace(F.hex(F.col("head").cast("binary")), "^EFBBBF", "")
    head = F.unhex(code).cast("string")
    told = told.select("file", head.alias("head"), code.alias("code"), F.when(head.contains("\t"), "\t").otherwise(",").alias("sep"), F.when(F.col("valid"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"))
    return told.where(F.trim("head") != "")


def _literal(file: str) -> str:
    """A file's address as a path that readers take as it is, without wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def _columns(head: str, sep: str) -> T.StructType:
    """The columns of a header: blank names by place, names that repeat with their place."""
    cells = [c.strip() or f"_c{i}" for i, c in enumerate(next(csv.reader([head], delimiter=sep)))]
    often = Counter(c.lower() for c in cells)
    return T.StructType([T.StructField(f"{c}{i}" if often[c.lower()] > 1 else c, T.StringType()) for i, c in enumerate(cells)])


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a folder of sheets as text columns, ``row_id`` in the order of file names and
    lines, and ``source_file``.

    Columns are those of all headers; a file without one has nulls there.  Blank files,
    and a first line of white space, give no rows; a folder of such files has
    no other columns.  The driver sees one row for each file."""
    files = file_kinds(spark, path).drop("head").orderBy("file").collect()
    if not files:
        return spark.createDataFrame([], T.StructType([T.StructField(ROW_ID, T.LongType()), T.StructField("source_file", T.StringType())]))
    numbers = spark.createDataFrame([(f["file"], i) for i, f in enumerate(files)], "source_file string, _file long")
    kinds: dict[tuple[str, str, str], list[str]] = {}
    for f in files:
        kinds.setdefault((f["encoding"], f["sep"], f["code"]), []).append(f["file"])
    scans = []
    for (encoding, sep, code), own in kinds.items():
        schema = _columns(bytes.fromhex(code).decode(encoding), sep)
        rows = spark.read.options(**CSV | {"enforceSchema": True}, sep=sep, encoding=encoding).schema(schema).csv([_literal(f) for f in own])
        # sheets of several lines a cell are not split: a file is in one task, in order
        rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().bitwiseAND(ROWS - 1).alias("_line"))
        scans.append(rows)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    out = out.join(F.broadcast(numbers) if len(files) <= BROADCAST_FILES else numbers, "source_file")
    data = [c for c in out.columns if c not in ("source_file", "_line", "_file")]
    return out.select((F.col("_file") * ROWS + F.col("_line")).alias(ROW_ID), *[F.col(f"`{c}`") for c in data], "source_file")
