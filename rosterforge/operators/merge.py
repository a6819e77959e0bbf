"""Importing a sheet: matches, preview, upsert, and what it changes per chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions.text import chain_slug
from rosterforge.functions.urls import root_id
from rosterforge.operators.match import chain_of
from rosterforge.schema import CATALOG, CHAIN, MATCHED_URL, NAME, ROOT, ROW_ID, cell, filled, ordered, trim

UNKNOWN = "__unknown__"
#: A strategy per column that avoids joined names and flags; the others append.
RECOMMENDED = {c: "keep_ours" for c in CATALOG if c not in ("Notes", "Evidence & Source URLs", "Source", "Category")}


def combined(ours: Column, theirs: Column, strategy: str) -> Column:
    """One cell from two: append (unless ours holds theirs), keep_ours (fills empties),
    keep_theirs (unless empty), skip."""
    a, b = trim(ours), trim(theirs)
    if strategy == "skip":
        return ours
    if strategy == "keep_ours":
        return F.when(a != "", a).otherwise(b)
    if strategy == "keep_theirs":
        return F.when(b != "", b).otherwise(a)
    return F.when(b == "", a).when(a == "", b).when(a.contains(b), a).otherwise(F.concat(a, F.lit("; "), b))


def field_diff(pairs: DataFrame, columns: list[str], ours: str = "ours", theirs: str = "theirs", computed: tuple[str, ...] = ()) -> DataFrame:
    """Pairs with two structs in long form: one row per pair and column whose trimmed values differ."""
    pair_cols = [c for c in pairs.columns if c not in (ours, theirs)]
    fields = F.array(
        *[F.struct(F.lit(c).alias("column"), trim(F.col(ours)[c]).alias("ours"), trim(F.col(theirs)[c]).alias("theirs"), F.lit(c in computed).alias("is_computed")) for c in columns]
    )
    changed = F.filter(fields, lambda f: f["ours"] != f["theirs"])
    return pairs.select(*pair_cols, F.explode(changed).alias("d")).select(*pair_cols, "d.*")


def preview(pairs: DataFrame, columns: list[str], strategies: dict[str, str], default: str = "append", computed: tuple[str, ...] = ()) -> DataFrame:
    """``field_diff`` with the strategy and the value it leads to; computed columns are left out."""
    diff = field_diff(pairs, columns, computed=computed).where(~F.col("is_computed"))
    strategy, resolved = F.lit(default), combined(F.col("ours"), F.col("theirs"), default)
    for c, s in strategies.items():
        here = F.col("column") == c
        strategy, resolved = F.when(here, s).otherwise(strategy), F.when(here, combined(F.col("ours"), F.col("theirs"), s)).otherwise(resolved)
    return diff.withColumns({"strategy": strategy, "resolved": resolved})


def match_counts(matches: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One row: new, merged and skipped incoming rows of ``import_matches``."""
    m = matches.withColumn("skip", F.lit(False))
    if skipped is not None:
        m = matches.join(skipped.select("row_id").distinct().withColumn("skip", F.lit(True)), "row_id", "left").fillna(False, ["skip"])
    return m.agg(
        F.count_if(~F.col("skip") & F.col("match_id").isNull()).alias("new_rows"),
        F.count_if(~F.col("skip") & F.col("match_id").isNotNull()).alias("merged_rows"),
        F.count_if("skip").alias("skipped_rows"),
    )


def _of_column(i: int):
    return lambda x: x["i"] == i


def upsert(existing: DataFrame, incoming: DataFrame, matches: DataFrame, strategies: dict[str, str] | None = None, default: str = "append") -> DataFrame:
    """The existing table with its matched incoming rows applied in their order and new rows
    appended; root ids are then filled from admin URLs.

    A match names an existing row; it lands on the last row of the same lower name
    (as a reader by name would find it).  Each cell is an ordered aggregate of its
    target's incoming rows that combines within tasks: the first or last filled value,
    or the different values to append.  Targets without such rows are left as they are."""
    strategies = strategies or {}
    columns = [c for c in incoming.columns if c != ROW_ID]
    target = existing.select(F.col(ROW_ID).alias("match_id"), F.lower(trim(NAME)).alias("_low"))
    last = target.groupBy("_low").agg(F.max("match_id").alias("_last"))
    to = target.join(last, "_low").select("match_id", F.when(F.col("_low") != "", F.col("_last")).otherwise(F.col("match_id")).alias("target"))
    rows = incoming.join(matches.select(ROW_ID, "match_id"), ROW_ID).join(to, "match_id", "left")
    rule = {c: strategies.get(c, default) for c in columns}
    # what fills or replaces a cell is one value a task; what is appended, its different values in order
    order = F.struct(ROW_ID, "match_id")
    held = {c: F.when(filled(c), order) for c in columns}
    aggs = [(F.max_by if rule[c] == "keep_theirs" else F.min_by)(trim(c), held[c]).alias(f"_v{i}") for i, c in enumerate(columns) if rule[c] in ("keep_ours", "keep_theirs")]
    matched = rows.where("target is not null")
    updates = matched.groupBy("target").agg(F.lit(True).alias("_is"), *aggs)
    joined = [(i, c) for i, c in enumerate(columns) if rule[c] == "append"]
    if joined:
        values = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), trim(c).alias("v")) for i, c in joined]), lambda x: x["v"] != "")
        each = matched.select("target", order.alias("o"), F.explode(values).alias("x")).groupBy("target", "x.i", "x.v").agg(F.min("o").alias("o"))
        told = each.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("o", "i", "v"))).alias("_in"))
        updates = updates.join(told, "target", "left")
    merged = existing.join(updates, F.col(ROW_ID) == F.col("target"), "left")
    out = {}
    for i, c in enumerate(columns):
        ours = cell(c) if c in existing.columns else F.lit("")
        if rule[c] == "append":
            # a value that came before is held by then; the first step alone may find an empty cell
            new = F.aggregate(F.filter("_in", _of_column(i)), ours, lambda acc, x: combined(acc, x["v"], "append"))
            new = F.when(F.col("_in").isNull() | ~F.exists("_in", _of_column(i)), trim(ours)).otherwise(new)
        else:
            theirs = F.lit("") if rule[c] == "skip" else F.coalesce(f"_v{i}", F.lit(""))
            new = combined(ours, theirs, rule[c])
        out[c] = F.when(F.col("_is"), new).otherwise(ours)
    merged = merged.withColumns(out).drop("target", "_is", "_in", *[f"_v{i}" for i in range(len(columns))])
    base = existing.agg(F.coalesce(F.max(ROW_ID) + 1, F.lit(0).cast("long")).alias("_base"))
    new = rows.where("target is null").select(ROW_ID, *[F.col(f"`{c}`") for c in columns]).crossJoin(F.broadcast(base))
    new = new.withColumn(ROW_ID, F.col(ROW_ID) + F.col("_base")).drop("_base")
    everything = ordered(merged.unionByName(new, allowMissingColumns=True))
    return everything.withColumn(ROOT, root_id(ROOT, MATCHED_URL))


def ecosystem_counts(df: DataFrame, column: str = CHAIN) -> DataFrame:
    return df.groupBy(F.when(filled(column), trim(column)).otherwise("(blank)").alias("ecosystem")).agg(F.count("*").alias("n"))


def split_by_chain(df: DataFrame, chains: DataFrame, column: str = CHAIN) -> DataFrame:
    """Rows with ``chain_id``: the known chain's id, else the raw name, else ``__unknown__``;
    ``known_chain`` tells which.  Write with ``partitionBy`` for one folder each."""
    eco = df.withColumn("eco", trim(column))
    found = chain_of(eco.select("eco").distinct(), chains)
    # a name may hold most rows, hence each is met in as many parts as there are tasks to share it
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = found.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    r = eco.withColumn("_part", F.spark_partition_id() % tasks).join(shared, ["eco", "_part"], "left").drop("_part")
    known = F.col("chain_id").isNotNull()
    return r.withColumns(
        {
            "known_chain": known,
            column: F.when(known, F.col("chain_id")).otherwise(cell(column)),
            "chain_id": F.when(known, F.col("chain_id")).when(F.col("eco") != "", F.col("eco")).otherwise(UNKNOWN),
        }
    ).drop("eco")


def unmatched_ecosystems(split: DataFrame) -> DataFrame:
    return split.where(~F.col("known_chain") & (F.col("chain_id") != UNKNOWN)).select(F.col("chain_id").alias("ecosystem")).distinct()


def new_chains(split: DataFrame, chains: DataFrame, assets: tuple[str, ...] = ("USDT", "USDC")) -> DataFrame:
    """Unknown ecosystems as chain rows with default assets, after the known ones; ids that exist are skipped."""
    fresh = unmatched_ecosystems(split).select(chain_slug("ecosystem").alias("id"), F.col("ecosystem").alias("name")).where("id <> ''")
    fresh = fresh.groupBy("id").agg(F.min("name").alias("name")).join(chains.select("id"), "id", "left_anti")
    return fresh.withColumn("target_assets", F.array(*map(F.lit, assets)))


def valid_chain_id(chain_id: str) -> bool:
    import re

    return bool(re.fullmatch(r"[a-z0-9][a-z0-9-]*", chain_id))


def import_rollup(split: DataFrame, matches: DataFrame, existing: DataFrame) -> DataFrame:
    """Per chain and in total (null chain): incoming, new, duplicate and existing rows."""
    m = split.join(matches, ROW_ID)
    per = m.groupBy("chain_id").agg(
        F.count("*").alias("incoming"), F.count_if(F.col("match_id").isNull()).alias("new"), F.count_if(F.col("match_id").isNotNull()).alias("duplicates"), F.bool_or("known_chain").alias("known")
    )
    there = existing.groupBy("chain_id").agg(F.count("*").alias("existing"))
    per = per.join(there, "chain_id", "left").fillna(0, ["existing"])
    return per.rollup("chain_id").agg(*[F.sum(c).alias(c) for c in ("incoming", "new", "duplicates", "existing")], F.bool_or("known").alias("known"))
