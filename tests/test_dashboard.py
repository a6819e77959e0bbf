import difflib
import random

import helpers
from pyspark.sql import functions as F

from rosterforge.functions import kernels
from rosterforge.operators import reports as R
from rosterforge.plans import tables as D

SF = "/root/testdata/sf0.001"


def test_dashboard_is_the_reports(spark):
    df = D.catalog(spark, SF)
    got = {(r.report, r["item"]): r.n for r in R.dashboard(df).collect()}
    for report, one in (("kpi", R.kpis), ("flag", R.flag_counts), ("evidence", R.evidence_coverage), ("scan", R.scan_hits), ("health", R.health_rollup)):
        row = one(df).first().asDict()
        mine = {k: n for (r, k), n in got.items() if r == report}
        assert mine and {k: row[k] for k in mine} == mine
    for report, one in (("source", R.source_breakdown(df)), ("category", R.category_breakdown(df))):
        assert {r[0]: r[1] for r in one.collect()} == {k: n for (r, k), n in got.items() if r == report}
    status = {(r.dimension, r.value): r.n for r in R.match_status(df).collect() if r.dimension != "total"}
    assert status == {k: n for k, n in got.items() if k[0] in ("status", "method")}


def test_one_scan(spark):
    plan = R.dashboard(D.catalog(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_dashboard_of_nothing(spark):
    got = R.dashboard(D.catalog(spark, SF).where(F.lit(False))).collect()
    assert len(got) == 37 and all(r.n == 0 and r.pct == 0 for r in got)


def test_ratios_are_difflibs():
    r = random.Random(1)
    a, b = (["".join(r.choice("abcde") for _ in range(r.randint(0, 12))) for _ in range(3000)] for _ in "ab")
    want = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)]
    assert kernels.ratios(a, b) == want
    for least in (0.5, 0.8):
        assert all(g == w or (w <= least and g == 0) for g, w in zip(kernels.ratios(a, b, least), want, strict=True))


def test_counts_are_aggregated_by_hash_and_ties_go_to_the_first_seen(spark):
    rows = [{"id": 12, "src": "A; B", "cat": "x"}, {"id": 3, "src": "C; D; A", "cat": "y"}, {"id": -5, "src": "D; B; E", "cat": "z"}]
    df = helpers.catalog(spark, rows)
    for report in (R.dashboard(df), R.source_breakdown(df), R.category_breakdown(df)):
        assert "SortAggregate" not in report._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in R.source_breakdown(df, 4).collect()] == [("D", 2), ("B", 2), ("A", 2), ("E", 1)]
    found = {r["item"] for r in R.dashboard(df, sources=4, categories=2).where("report in ('source', 'category')").collect()}
    assert found == {"D", "B", "A", "E", "Z", "Y"}
