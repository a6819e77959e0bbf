"""What grows with the rows and what only with their different names."""

import pytest
from helpers import catalog
from pyspark.sql import functions as F

from rosterforge import schema as S
from rosterforge.functions.text import sanitized
from rosterforge.operators import enrich, match, merge
from rosterforge.plans import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def counted(spark, monkeypatch):
    """Counts how many values a key function of ``match`` is asked for."""

    def of(name):
        calls, real = spark.sparkContext.accumulator(0), getattr(match, name)

        def seen(text):
            calls.add(1)
            return text

        tap = F.udf(seen, "string")
        monkeypatch.setattr(match, name, lambda c: real(tap(F.col(f"`{c}`") if isinstance(c, str) else c)))
        return calls

    return of


def test_a_pair_of_keys_is_listed_once_and_by_as_many_tasks_as_set(spark, capsys):
    one = lambda keys, c: spark.createDataFrame([(k,) for k in keys], f"{c} string")
    keys = [f"hot ring {i} network" for i in range(40)]
    found = match.candidate_pairs(one(keys, "a"), one(keys, "b"))
    pairs = [(r.a, r.b) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) == 40 * 39
    found.explain()
    assert "REPARTITION_BY_NUM" in capsys.readouterr().out


def test_names_are_matched_by_their_different_values(spark, counted):
    calls = counted("name_key")
    df = lambda rows: spark.createDataFrame(rows, "id long, name string")
    old = [(i, ["Gate", "Stargate Finance", "Swap", "Reflow"][i % 4]) for i in range(200)]
    new = [(i, ["gate", "Reflov", None, "Swap"][i % 4]) for i in range(200)]
    got = {(r.id % 4, r.match_id, round(r.score, 4)) for r in match.best_name_match(df(new), df(old)).collect()}
    assert got == {(0, 0, 1.0), (1, 3, round(5 / 6, 4))}
    assert calls.value < 200


def test_coins_are_looked_up_by_different_names(spark, counted):
    calls = counted("spaced_key")
    coins = spark.createDataFrame([(f"c{i % 2}", ["Alpha Token", "Wrapped Beta"][i % 2], "", i) for i in range(200)], "id string, name string, symbol string, pos long")
    rows = catalog(spark, [{"name": ["alpha-token", "Wrappd Beta", "", "None such"][i % 4]} for i in range(200)])
    got = {(r.row_id % 4, r.coin_id, r.method) for r in match.coin_lookup(rows, coins).collect()}
    assert got == {(0, "c0", "exact"), (1, "c1", "fuzzy")}
    assert calls.value < 200


def test_rows_without_an_id_get_their_deployments(spark):
    coins = spark.createDataFrame([("c", "Alpha Token", "", 0, {"solana": "0x1"})], "id string, name string, symbol string, pos long, platforms map<string,string>")
    rows = catalog(spark, [{"name": "Alpha Token"}, {"name": "Alpha Token"}, {"name": "Other"}]).withColumn("row_id", F.lit(None).cast("long"))
    out = enrich.enrich_deployments(rows, coins, ["SOL"]).select(S.NAME, S.EVIDENCE).collect()
    assert sorted((r[0], r[1]) for r in out) == [("Alpha Token", "SOL: deployed on solana (CoinGecko)")] * 2 + [("Other", "")]


def test_one_file_of_rows_is_dealt_over_all_cores(spark):
    assert tables.base(spark, SF, "part").rdd.getNumPartitions() == 1
    assert tables.catalog(spark, SF).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_sanitizing_misses_no_white_space(spark):
    blank = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    codes = [c for c in range(1, 0x3100)]
    df = spark.createDataFrame([(c, f"a{chr(c)}b", f"{chr(c)}ab{chr(c)}") for c in codes], "c int, inner string, outer string")
    for c, inner, outer in df.select("c", sanitized("inner"), sanitized("outer")).collect():
        x = " " if c in blank else ";" if c == ord(",") else chr(c)
        assert (inner, outer) == (f"a{x}b", "ab" if c in blank else f"{x}ab{x}")
    odd = spark.createDataFrame([("a  b",), (" a",), ("a\n",), ("&amp;lt;,",), ("",), (None,)], "t string")
    assert [r[0] for r in odd.select(sanitized("t")).collect()] == ["a b", "a", "a", "<;", "", ""]


def test_a_chain_of_most_rows_is_split_by_several_tasks(spark):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        chains = spark.createDataFrame([("near", "NEAR", 0)], "id string, name string, pos long")
        rows = catalog(spark, [{"eco": ["Near", "Other"][i % 50 == 0]} for i in range(400)]).repartition(4)
        split = merge.split_by_chain(rows, chains).select("row_id", "chain_id", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.row_id, r.chain_id) for r in split) == [(i, ["near", "Other"][i % 50 == 0]) for i in range(400)]
    assert len({r.task for r in split if r.chain_id == "near"}) > 1
