"""Dedup within a catalog: grouping by name and domain, survivorship, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions import evidence
from rosterforge.functions.text import name_key
from rosterforge.functions.urls import domain
from rosterforge.schema import EVIDENCE, NAME, NOTES, ROW_ID, SOURCE, STABLE, USDT, WEB3, WEBSITE, cell, filled, trim

#: What a filled field says of a row's richness (fixed values).
RICHNESS = {
    "Matched URL": 10,
    "Root ID": 10,
    "Profile Name": 10,
    "Website": 5,
    "X Link": 3,
    "X Handle": 3,
    "Telegram": 2,
    "Suspect USDT support?": 5,
    "General Stablecoin Adoption": 3,
    "Evidence & Source URLs": 3,
    "Category": 1,
    "Notes": 1,
}
#: Fields that poorer rows may fill (fixed values).
FILLED_IN = ["Website", "X Link", "X Handle", "Telegram", "Category", "Profile Name", "Root ID", "Matched URL", "Matched via", "The Grid Status"]
TRUE_WINS = [USDT, STABLE, WEB3]


def richness() -> Column:
    total = F.lit(0)
    for field, weight in RICHNESS.items():
        counts = trim(field) == "TRUE" if field in (USDT, STABLE) else filled(field) & (trim(field) != "FALSE")
        total = total + F.when(counts, weight).otherwise(0)
    return total


def grouped(df: DataFrame, match_empty_key: bool = False) -> DataFrame:
    """Adds ``_key, _sub, _dom``: rows with equal key and sub-key are one entity.

    The key is the name's; names of one key are split by domain only if they show
    more than one, and then rows without a domain stay alone.  Blank names stay
    alone, and so do names with an empty key unless ``match_empty_key``."""
    df = df.withColumns({"_key": name_key(trim(NAME)), "_dom": domain(WEBSITE)})
    alone = ~filled(NAME) if match_empty_key else (F.col("_key") == "")
    own = F.concat(F.lit("r:"), F.col(ROW_ID).cast("string"))
    # one number per key instead of a window over all rows of a key
    doms = df.where(F.col("_dom") != "").select("_key", "_dom").distinct().groupBy("_key").agg(F.count("*").alias("_n"))
    df = df.join(doms, "_key", "left")
    sub = F.when(alone, own).when(F.coalesce("_n", F.lit(0)) <= 1, "").when(F.col("_dom") != "", F.concat(F.lit("d:"), "_dom")).otherwise(own)
    return df.withColumn("_sub", sub).drop("_n")


def _places(rows: DataFrame, kinds: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``_key, _sub`` and, for each kind, its distinct non-empty values in order (array).

    ``kinds`` has an array of values and an order per row.  A value meets its group as
    often as tasks hold it, not as often as rows do, so a group is as large as what
    its cells will say, however many rows it has."""
    items = [F.transform(values, _item(k, order)) for k, (values, order) in kinds.items()]
    each = rows.select("_key", "_sub", F.explode(F.concat(*items)).alias("x")).select("_key", "_sub", "x.*").where("v <> ''")
    first = each.groupBy("_key", "_sub", "kind", "v").agg(F.min(F.struct("o", "i")).alias("at"))
    told = first.groupBy("_key", "_sub").agg(F.array_sort(F.collect_list(F.struct("at", "kind", "v"))).alias("x"))
    return told.select("_key", "_sub", *[F.transform(F.filter("x", _of_kind(k)), lambda x: x["v"]).alias(k) for k in kinds])


def _item(kind: str, order: Column):
    return lambda v, i: F.struct(F.lit(kind).alias("kind"), order.alias("o"), i.alias("i"), v.alias("v"))


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def survivors(df: DataFrame, match_empty_key: bool = False) -> DataFrame:
    """One row per entity, in place of its first row.

    The richest row is the base (ties: rows with a domain, then row order).
    Others fill its empty fields in that order; TRUE wins for flags; notes gain
    unseen segments; evidence is the distinct segments of all; sources are
    joined in row order; a note tells what was merged.

    Every field is an ordered aggregate that combines within tasks; no entity's rows
    stand together in one place, so an entity of any share of the rows is one row's
    work to finish."""
    g = grouped(df, match_empty_key)
    texts = [c for c in df.columns if c != ROW_ID]
    # a row's rank as a base, and its place in the table; a sparse (null) order takes no part
    by_score = F.struct((-richness()).alias("s"), (F.col("_dom") == "").alias("late"), F.col(ROW_ID).alias("id"))
    g = g.withColumns({"_best": by_score, "_place": F.struct("_best.late", "_best.id")})
    held = {c: trim(c) for c in {NAME, *texts} if c in df.columns}
    aggs = {"_n": F.count("*"), "_id": F.min("_place"), "_base": F.min_by(F.struct(*[cell(c).alias(f"c{i}") for i, c in enumerate(texts)]), "_best")}
    for i, c in enumerate(texts):
        if c in FILLED_IN or c == NOTES:
            aggs[f"_f{i}"] = F.min_by(held[c], F.when(held[c] != "", F.col("_best")))
        elif c in TRUE_WINS:
            aggs[f"_t{i}"] = F.count_if(held[c] == "TRUE")
    groups = g.groupBy("_key", "_sub").agg(*[v.alias(k) for k, v in aggs.items()])
    kinds = {"_names": (F.array(held[NAME]), F.struct(F.lit(0).alias("s"), F.col("_place.late").alias("late"), F.col("_place.id").alias("id")))}
    if SOURCE in texts:
        kinds["_sources"] = (F.array(held[SOURCE]), kinds["_names"][1])
    if EVIDENCE in texts:
        kinds["_evidence"] = (evidence.segments(EVIDENCE), F.col("_best"))
    several = groups.where("_n > 1").select("_key", "_sub")
    rows = g.join(several, ["_key", "_sub"], "left_semi")
    groups = groups.join(_places(rows, kinds), ["_key", "_sub"], "left")
    if NOTES in texts:
        # of each different note but the first, what stands after its first segment
        i = texts.index(NOTES)
        notes = rows.where(held[NOTES] != "").groupBy("_key", "_sub", held[NOTES].alias("note")).agg(F.min("_best").alias("o"))
        notes = notes.join(groups.where("_n > 1").select("_key", "_sub", F.col(f"_f{i}").alias("first")), ["_key", "_sub"]).where("note <> first")
        tails = F.expr(r"slice(split(note, ' \\| '), 2, size(split(note, ' \\| ')))")
        notes = notes.select("_key", "_sub", "first", "o", F.posexplode(F.transform(tails, trim)).alias("i", "v")).where((F.col("v") != "") & ~F.col("first").contains(F.col("v")))
        notes = notes.groupBy("_key", "_sub").agg(F.array_sort(F.collect_list(F.struct("o", "i", "v"))).alias("x")).select("_key", "_sub", F.transform("x", lambda x: x["v"]).alias("_fresh"))
        groups = groups.join(notes, ["_key", "_sub"], "left")
    nothing = F.array().cast("array<string>")
    names, n = F.coalesce("_names", nothing), F.col("_n")
    sources = F.coalesce("_sources", nothing) if SOURCE in texts else nothing
    out = {}
    for i, c in enumerate(texts):
        base = F.col("_base")[f"c{i}"]
        if c in TRUE_WINS:
            out[c] = F.when(F.col(f"_t{i}") > F.when(trim(base) == "TRUE", 1).otherwise(0), "TRUE").otherwise(base)
        elif c in FILLED_IN:
            out[c] = F.when(trim(base) != "", base).otherwise(F.coalesce(f"_f{i}", base))
        elif c == EVIDENCE:
            joined = F.array_join(F.coalesce("_evidence", nothing), " | ")
            out[c] = F.when(joined != "", joined).otherwise(base)
        elif c == SOURCE:
            out[c] = F.when(F.size(sources) > 1, F.array_join(sources, "; ")).otherwise(base)
        elif c == NOTES:
            why = F.when(F.size(names) > 1, F.concat(F.lit("fuzzy dedup: merged from "), F.array_join(names, "; "))).otherwise(F.concat(F.lit("dedup: merged "), n.cast("string"), F.lit(" rows")))
            told = F.concat(F.lit("("), why, F.when(F.size(sources) > 1, F.concat(F.lit(" | sources: "), F.array_join(sources, "; "))).otherwise(""), F.lit(")"))
            out[c] = F.array_join(F.filter(F.concat(F.array(F.coalesce(f"_f{i}", F.lit(""))), F.coalesce("_fresh", nothing), F.array(told)), lambda p: p != ""), " | ")
        else:
            out[c] = base
    return groups.select(
        F.col("_id.id").alias(ROW_ID),
        *[F.when(n == 1, F.col("_base")[f"c{i}"]).otherwise(out[c]).alias(c) for i, c in enumerate(texts)],
        n.cast("int").alias("merged_rows"),
    )


def counters(df: DataFrame, match_empty_key: bool = False) -> DataFrame:
    """One row: total, unique, exact and fuzzy removals (fuzzy: differing names in a group)."""
    g = grouped(df, match_empty_key).withColumn("_name", trim(NAME))
    groups = g.groupBy("_key", "_sub").agg(F.count("*").alias("n"), F.min("_name").alias("a"), F.max("_name").alias("b"))
    fuzzy = F.col("a") != F.col("b")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(
        total(F.col("n")).alias("total_rows"),
        F.count("*").alias("unique_rows"),
        total(F.when(~fuzzy, F.col("n") - 1).otherwise(0)).alias("exact_removed"),
        total(F.when(fuzzy, F.col("n") - 1).otherwise(0)).alias("fuzzy_removed"),
    )
