from pathlib import Path

from helpers import catalog
from pyspark.sql import functions as F

from rosterforge import schema as S
from rosterforge.operators import match
from rosterforge.sources import texts


def written(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*"))).split("\n")[:-1]


def test_comparison_report(spark, tmp_path):
    old = catalog(spark, [{"name": "Alpha"}, {"name": "Beta Swap"}])
    new = catalog(spark, [{"name": "alpha", "site": "https://a.example", "handle": "@a"}, {"name": "Gamma", "cat": "Dex", "notes": "TVL: $1,234 | x"}, {"name": "Beta", "handle": ""}])
    duplicates, fresh = match.split_new(new, old)
    texts.write_lines(texts.comparison_lines(duplicates, fresh, old, "near", "Site"), str(tmp_path / "r"))
    rule = "-" * 60
    assert written(tmp_path / "r") == [
        "=" * 60, "ECOSYSTEM DATA COMPARISON REPORT", "Chain: near | Source: Site", "=" * 60, "",
        "Existing CSV entries: 2", "Site scraped items: 3", "Duplicates found: 2", "New projects to add: 1", "",
        rule, "DUPLICATES (may need data enhancement)", rule,
        "  Site: alpha", "  CSV:    Alpha (match: 100%)", "  URL: https://a.example", "  Twitter: @a", "",
        "  Site: Beta", "  CSV:    Beta Swap (match: 100%)", "",
        rule, "NEW PROJECTS TO ADD", rule, "  Name: Gamma", "  Category: Dex", "  TVL: $1,234", "",
    ]


def test_long_reports_are_in_order_over_many_files(spark, tmp_path):
    rows = spark.range(40_000).select(F.col("id").alias("row_id"), F.concat(F.lit("n"), "id").alias(S.NAME), *[F.lit("").alias(c) for c in S.CATALOG if c != S.NAME]).repartition(7)
    none = rows.limit(0).withColumns({"match_id": F.lit(0).cast("long"), "score": F.lit(1.0)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    texts.write_lines(texts.comparison_lines(none, rows, rows.limit(0), "c", "s"), str(tmp_path / "r"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = written(tmp_path / "r")
    assert [x for x in lines if x.startswith("  Name")] == [f"  Name: n{i}" for i in range(40_000)]
    assert len(list((tmp_path / "r").glob("part-*"))) > 2 and texts.read_lines(spark, str(tmp_path / "r")).count() == len(lines)
