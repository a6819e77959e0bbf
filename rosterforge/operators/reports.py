"""Coverage and quality reports.  Each is one pass over the columns it names."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.functions import evidence
from rosterforge.functions.text import category_list, percent, title
from rosterforge.operators.filters import DEAD
from rosterforge.schema import CATEGORY, EVIDENCE, MATCHED_URL, NAME, NOTES, PROFILE, ROW_ID, SOURCE, STABLE, STATUS, TELEGRAM, USDT, VIA, WEB3, WEBSITE, X_HANDLE, X_LINK, cell, filled, is_true, trim

#: Assets whose findings are counted (fixed values).
TICKERS = ["USDT", "USDC", "SOL", "STRK", "ADA", "APT", "ETH", "BTC"]

#: Less than any row's id.
BEFORE = Decimal(-(1 << 63) - 1)


def is_matched() -> Column:
    return filled(PROFILE) | filled(MATCHED_URL)


def kpis(df: DataFrame) -> DataFrame:
    """One row: totals, filled and true counts, three percentages (zeros of nothing)."""
    n = F.count("*")
    filled_counts = {"with_website": filled(WEBSITE), "with_x": filled(X_LINK) | filled(X_HANDLE), "with_telegram": filled(TELEGRAM), "with_category": filled(CATEGORY), "matched": is_matched(), "with_evidence": filled(EVIDENCE)}
    true_counts = {"skipped": is_true("Skip"), "added": is_true("Added"), "processed": is_true("Processed?"), "in_admin": is_true("In Admin")}
    counts = df.agg(n.alias("total"), *[F.count_if(c).alias(k) for k, c in (filled_counts | true_counts).items()])
    return counts.withColumns({f"{k}_pct": percent(F.col(k), F.col("total")) for k in ("with_website", "matched", "with_evidence")})


def flag_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(is_true(USDT)).alias("suspect_usdt"), F.count_if(is_true(WEB3)).alias("web3_no_stablecoin"), F.count_if(is_true(STABLE)).alias("general_stablecoin"))


def evidence_coverage(df: DataFrame) -> DataFrame:
    """Rows per evidence source (a row may have several), their shares, rows without any."""
    kinds = F.transform(evidence.segments(EVIDENCE), evidence.kind)
    marked = df.select(kinds.alias("k"))
    names = ("grid", "defillama", "coingecko", "website")
    has = {k: F.array_contains("k", k) for k in names}
    none = ~(has["grid"] | has["defillama"] | has["coingecko"] | has["website"])
    out = marked.agg(F.count("*").alias("total"), *[F.count_if(c).alias(k) for k, c in has.items()], F.count_if(none).alias("no_evidence"))
    return out.withColumns({f"{k}_pct": percent(F.col(k), F.col("total")) for k in names})


def _seen(p: Column) -> Column:
    """A number in the order of row (null first) and place in it.  Its minimum is aggregated by
    hash, where that of a struct has Spark sort all rows first."""
    row = F.coalesce(F.col(ROW_ID).cast("decimal(20,0)"), F.lit(BEFORE).cast("decimal(20,0)"))
    return row * F.lit(10_000_000_000).cast("decimal(11,0)") + p.cast("decimal(10,0)")


def _breakdown(df: DataFrame, items: Column, name: str, k: int) -> DataFrame:
    rows = df.select(ROW_ID, F.posexplode(items).alias("p", name))
    counts = rows.groupBy(name).agg(F.count("*").alias("n"), F.min(_seen(F.col("p"))).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(k).select(name, "n")


def source_breakdown(df: DataFrame, k: int = 20) -> DataFrame:
    """The most frequent sources, ties to the first seen."""
    return _breakdown(df, category_list(SOURCE), "source", k)


def category_breakdown(df: DataFrame, k: int = 15) -> DataFrame:
    return _breakdown(df, F.transform(category_list(CATEGORY), title), "category", k)


def match_status(df: DataFrame) -> DataFrame:
    """Long form: matched and unmatched totals, then status and method counts of matched rows."""
    flag = F.when(is_matched(), "matched").otherwise("unmatched")
    total = df.groupBy(flag.alias("value")).agg(F.count("*").alias("n")).select(F.lit("total").alias("dimension"), "value", "n")
    m = df.where(is_matched()).select(F.when(filled(STATUS), trim(STATUS)).otherwise("(none)").alias("status"), F.when(filled(VIA), trim(VIA)).otherwise("(none)").alias("method"))
    sets = m.groupingSets([["status"], ["method"]], "status", "method").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    return total.unionByName(sets.select(F.when(F.col("g") == 1, "status").otherwise("method").alias("dimension"), F.coalesce("status", "method").alias("value"), "n"))


def scan_hits(df: DataFrame) -> DataFrame:
    """One row: rows with scan findings, and how many name each ticker, stablecoins, web3."""
    text = F.substring(cell(NOTES), F.instr(cell(NOTES), evidence.UNVERIFIED), F.length(cell(NOTES)))
    hits = df.where(cell(NOTES).contains(evidence.UNVERIFIED)).select(text.alias("t"))
    return hits.agg(
        F.count("*").alias("hits"),
        *[F.count_if(F.col("t").contains(f"{a} keywords")).alias(a.lower()) for a in TICKERS],
        F.count_if(F.col("t").contains("stablecoin mentions")).alias("stablecoin"),
        F.count_if(F.lower("t").contains("web3")).alias("web3"),
    )


def scan_hit_rows(df: DataFrame) -> DataFrame:
    text = F.substring(cell(NOTES), F.instr(cell(NOTES), evidence.UNVERIFIED), F.length(cell(NOTES)))
    return df.where(cell(NOTES).contains(evidence.UNVERIFIED)).select(ROW_ID, cell(NAME).alias("name"), text.alias("findings"))


def health_rollup(df: DataFrame) -> DataFrame:
    """One row: rows per health state, without URL, unchecked; checked and dead totals and shares."""
    s = evidence.health_status(EVIDENCE)
    r = df.select(s.alias("s"), filled(WEBSITE).alias("url"))
    states = ["alive", *DEAD]
    out = r.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("s") == x).alias(x) for x in states],
        F.count_if(~F.col("url")).alias("no_url"),
        F.count_if(F.col("url") & (F.col("s") == "")).alias("unchecked"),
    )
    checked, dead = sum((F.col(x) for x in states), F.lit(0)), sum((F.col(x) for x in DEAD), F.lit(0))
    out = out.withColumns({"checked_total": checked.cast("long"), "dead_total": dead.cast("long")})
    return out.withColumns({"checked_pct": percent(F.col("checked_total"), F.col("total")), "dead_pct": percent(F.col("dead_total"), F.col("checked_total"))})


def dead_sites(df: DataFrame, k: int = 50) -> DataFrame:
    """The first dead sites by name, with what the note says or else the state."""
    s = evidence.health_status(EVIDENCE)
    told = F.trim(F.regexp_extract(cell(NOTES), r"\[website-health\] DEAD: ([^|]*)", 1))
    rows = df.where(s.isin(DEAD)).select(ROW_ID, cell(NAME).alias("name"), cell(WEBSITE).alias("website"), s.alias("status"), F.when(told != "", told).otherwise(s).alias("detail"))
    return rows.orderBy("name", ROW_ID).limit(k)


def filter_options(df: DataFrame) -> DataFrame:
    """Distinct categories and sources in long form, to be sorted at the edge."""
    one = lambda c, name: df.select(F.lit(name).alias("field"), F.explode(category_list(c)).alias("value")).distinct()
    return one(CATEGORY, "category").unionByName(one(SOURCE, "source"))


def chain_row_counts(df: DataFrame, chains: DataFrame) -> DataFrame:
    """Every chain with its rows and whether it has any."""
    n = df.groupBy("chain_id").agg(F.count("*").alias("n_rows"))
    return chains.select(F.col("id").alias("chain_id"), "name").join(n, "chain_id", "left").fillna(0, ["n_rows"]).withColumn("available", F.col("n_rows") > 0)


def comparison(duplicates: DataFrame, new: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: existing, scraped, duplicate and new counts."""
    n = lambda df, c: df.agg(F.count("*").alias(c))
    return n(existing, "existing").crossJoin(n(duplicates, "duplicates")).crossJoin(n(new, "new")).withColumn("scraped", F.col("duplicates") + F.col("new"))


def duplicate_lines(duplicates: DataFrame, k: int = 30) -> DataFrame:
    """The first duplicates of a comparison as report lines."""
    line = F.concat(F.lit("  - "), cell(NAME), F.lit(" ("), F.format_number(F.col("score") * 100, 0), F.lit("%)"))
    return duplicates.orderBy(ROW_ID).limit(k).select(line.alias("value"))


def _shortened(c: str, n: int) -> Column:
    return F.when(F.length(cell(c)) > n, F.concat(F.substring(cell(c), 1, n), F.lit("..."))).otherwise(cell(c))


def summary_view(df: DataFrame) -> DataFrame:
    """The columns of a result list: long cells are shortened for display."""
    own = {"name": NAME, "website": WEBSITE, "x_handle": X_HANDLE, "category": CATEGORY, "source": SOURCE, "status": STATUS, "profile": PROFILE, "matched_url": MATCHED_URL, "matched_via": VIA}
    return df.select(
        ROW_ID,
        *[cell(c).alias(k) for k, c in own.items()],
        is_true(USDT).alias("suspect_usdt"),
        is_true(WEB3).alias("web3_no_stablecoin"),
        is_true(STABLE).alias("general_stablecoin"),
        _shortened(EVIDENCE, 120).alias("evidence"),
        _shortened(NOTES, 150).alias("notes"),
    )


def dashboard(df: DataFrame, sources: int = 20, categories: int = 15) -> DataFrame:
    """``report, item, n, pct``: all counts of the result page from one scan.

    Each row says which items it counts for; they are counted together, within tasks
    first, so the scan and the shuffle are one for all reports.  Items that no row
    counts for are rows with 0; sources and categories are the most frequent ones, ties
    to the first seen.  ``pct`` is the share of all rows, of matched rows for ``status``
    and ``method``."""
    state = evidence.health_status(EVIDENCE)
    kinds = F.transform(evidence.segments(EVIDENCE), evidence.kind)
    of = {k: F.array_contains("_kinds", k) for k in ("grid", "defillama", "coingecko", "website")}
    found = cell(NOTES).contains(evidence.UNVERIFIED)
    text = F.substring(cell(NOTES), F.instr(cell(NOTES), evidence.UNVERIFIED), F.length(cell(NOTES)))
    fixed = {
        "kpi": {"total": F.lit(True), "with_website": filled(WEBSITE), "with_x": filled(X_LINK) | filled(X_HANDLE), "with_telegram": filled(TELEGRAM), "with_category": filled(CATEGORY), "matched": is_matched(), "with_evidence": filled(EVIDENCE),
                "skipped": is_true("Skip"), "added": is_true("Added"), "processed": is_true("Processed?"), "in_admin": is_true("In Admin")},
        "flag": {"suspect_usdt": is_true(USDT), "web3_no_stablecoin": is_true(WEB3), "general_stablecoin": is_true(STABLE)},
        "evidence": of | {"no_evidence": ~(of["grid"] | of["defillama"] | of["coingecko"] | of["website"])},
        "scan": {"hits": found} | {a.lower(): found & F.col("_scan").contains(f"{a} keywords") for a in TICKERS} | {"stablecoin": found & F.col("_scan").contains("stablecoin mentions"), "web3": found & F.lower("_scan").contains("web3")},
        "health": {x: F.col("_state") == x for x in ["alive", *DEAD]} | {"no_url": ~filled(WEBSITE), "unchecked": filled(WEBSITE) & (F.col("_state") == "")},
    }

    def item(report: str, name: Column, place: Column = F.lit(0)) -> Column:
        return F.struct(F.lit(report).alias("report"), name.alias("item"), place.alias("p"))

    once = [F.when(c, item(r, F.lit(k))) for r, items in fixed.items() for k, c in items.items()]
    matched = [F.when(is_matched(), item(r, F.when(filled(c), trim(c)).otherwise("(none)"))) for r, c in (("status", STATUS), ("method", VIA))]
    lists = [F.transform(items, _listed(r)) for r, items in (("source", category_list(SOURCE)), ("category", F.transform(category_list(CATEGORY), title)))]
    rows = df.withColumns({"_kinds": kinds, "_state": state, "_scan": text})
    said = rows.select(ROW_ID, F.explode(F.concat(F.array_compact(F.array(*once, *matched)), *lists)).alias("x"))
    counts = said.groupBy("x.report", "x.item").agg(F.count("*").alias("n"), F.min(F.when(F.col("x.report").isin("source", "category"), _seen(F.col("x.p")))).alias("_first"))
    zeros = df.sparkSession.createDataFrame([(r, k) for r, items in fixed.items() for k in items], "report string, item string")
    counts = counts.unionByName(zeros.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True).groupBy("report", "item").agg(F.sum("n").alias("n"), F.min("_first").alias("_first"))
    of_report = W.partitionBy("report")  # a row for each item, not for each row of the table
    everything = W.partitionBy(F.lit(0))
    total, all_matched = (F.max(F.when((F.col("report") == "kpi") & (F.col("item") == k), F.col("n"))).over(everything) for k in ("total", "matched"))
    ranked = counts.withColumns({"_nth": F.row_number().over(of_report.orderBy(F.desc("n"), "_first")), "_all": F.when(F.col("report").isin("status", "method"), all_matched).otherwise(total)})
    kept = ranked.where(~((F.col("report") == "source") & (F.col("_nth") > sources)) & ~((F.col("report") == "category") & (F.col("_nth") > categories)))
    return kept.select("report", "item", "n", percent(F.col("n"), F.col("_all")).alias("pct"))


def _listed(report: str):
    return lambda v, i: F.struct(F.lit(report).alias("report"), v.alias("item"), i.alias("p"))


def sorted_by(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Rows of a table view by a column's text in any case, ties by row."""
    key = F.lower(cell(column))
    return df.orderBy(key.desc() if descending else key.asc(), ROW_ID)
