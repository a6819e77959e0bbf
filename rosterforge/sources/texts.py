"""Reports as text files, written in order by many tasks.

A report is a table of lines with a section, a place and a number within the
place.  Ranges of that order are dealt over tasks and sorted there, so the part
files read one after another are the report; no task holds all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.schema import CATEGORY, NAME, NOTES, ROW_ID, WEBSITE, X_HANDLE, cell, filled, trim

ORDER = ["section", "place", "line"]
#: What divides sections, and how many duplicates are told (fixed values).
RULE, DOUBLE_RULE, TOLD = "-" * 60, "=" * 60, 30


def _lines(rows: DataFrame, section: int, place: Column, lines: list[Column]) -> DataFrame:
    """The lines of each row; null ones are left out."""
    return rows.select(F.lit(section).alias("section"), place.cast("long").alias("place"), F.posexplode(F.array_compact(F.array(*lines))).alias("line", "value"))


def _said(label: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(f"  {label}: "), value))


def _tvl() -> Column:
    """The value in a note, as it is written there."""
    return F.regexp_extract(cell(NOTES), r"TVL: (\$[0-9,]+)", 1)


def comparison_lines(duplicates: DataFrame, new: DataFrame, existing: DataFrame, chain: str, source: str) -> DataFrame:
    """``section, place, line, value``: a comparison's report, from the two tables of
    ``match.split_new`` and the catalog they were compared with.

    Counts, the first 30 duplicates with what they matched and how well, then all new rows,
    both in row order; empty fields have no line."""
    spark = existing.sparkSession
    counts = existing.agg(F.count("*").alias("existing")).crossJoin(duplicates.agg(F.count("*").alias("duplicates"))).crossJoin(new.agg(F.count("*").alias("new")))  # a row each
    told = [
        F.lit(DOUBLE_RULE), F.lit("ECOSYSTEM DATA COMPARISON REPORT"), F.lit(f"Chain: {chain} | Source: {source}"), F.lit(DOUBLE_RULE), F.lit(""),
        F.concat(F.lit("Existing CSV entries: "), F.col("existing").cast("string")),
        F.concat(F.lit(f"{source} scraped items: "), (F.col("duplicates") + F.col("new")).cast("string")),
        F.concat(F.lit("Duplicates found: "), F.col("duplicates").cast("string")),
        F.concat(F.lit("New projects to add: "), F.col("new").cast("string")), F.lit(""),
    ]
    titles = spark.createDataFrame([(1, "DUPLICATES (may need data enhancement)"), (3, "NEW PROJECTS TO ADD")], "s int, title string")
    heads = titles.select(F.col("s").alias("section"), F.lit(0).cast("long").alias("place"), F.posexplode(F.array(F.lit(RULE), F.col("title"), F.lit(RULE))).alias("line", "value"))
    names = existing.select(F.col(ROW_ID).alias("match_id"), cell(NAME).alias("_ours"))
    first = duplicates.orderBy(ROW_ID).limit(TOLD).join(names, "match_id", "left")
    more = [_said("URL", trim(WEBSITE)), _said("Twitter", trim(X_HANDLE))]
    both = [F.concat(F.lit(f"  {source}: "), cell(NAME)), F.concat(F.lit("  CSV:    "), F.coalesce("_ours", F.lit("")), F.lit(" (match: "), F.format_number(F.col("score") * 100, 0), F.lit("%)"))]
    fresh = [F.concat(F.lit("  Name: "), F.when(filled(NAME), cell(NAME)).otherwise("?")), *more, _said("Category", trim(CATEGORY)), _said("TVL", _tvl()), F.lit("")]
    out = [_lines(counts, 0, F.lit(0), told), heads, _lines(first, 2, F.col(ROW_ID), [*both, *more, _said("TVL", _tvl()), F.lit("")]), _lines(new, 4, F.col(ROW_ID), fresh)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def write_lines(lines: DataFrame, path: str) -> None:
    """Writes ``section, place, line, value`` as text; files in the order of their names hold the lines in order."""
    ranges = lines.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ranges.select("value").write.mode("errorifexists").text(path)


def read_lines(spark, path: str) -> DataFrame:
    """``file, at, value`` of a written report; the order of ``file, at`` is that of the lines."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
