import random

from pyspark.sql import functions as F

from rosterforge.llm import mixing
from rosterforge.llm.common import word_count


def test_targets_stop_at_twice_the_size():
    t = mixing.shared_targets({"a": 100, "b": 1000, None: 10, "c": 0}, (3, 1, 2), 1.5, 2)
    assert t["a"] == 200 and t["c"] == 0 and t[None] == 20
    assert abs(sum(t.values()) - 1.5 * 1110) < 1e-6 and t["b"] <= 2000
    assert mixing.shared_targets({}, (3, 1, 2), 1.5, 2) == {}


def cheapest(sizes, members, quotas, repeats):
    """Brute force over whole tokens: the lowest total repetition cost at the largest flow."""
    import itertools

    arcs = [(p, s) for p, own in members.items() for s in own]
    best = (0, 0)
    for flow in itertools.product(*[range(int(sizes[p] * repeats) + 1) for p, _ in arcs]):
        out, into = dict.fromkeys(sizes, 0), [0] * len(quotas)
        for (p, s), f in zip(arcs, flow, strict=True):
            out[p] += f
            into[s] += f
        if all(out[p] <= repeats * n for p, n in sizes.items()) and all(i <= q for i, q in zip(into, quotas, strict=True)):
            cost = sum(sum(i // n for i in range(out[p])) for p, n in sizes.items() if n)
            best = max(best, (sum(out.values()), -cost))
    return best


def test_flow_is_largest_and_cheapest():
    r = random.Random(5)
    for _ in range(12):
        sizes = {p: r.randint(0, 2) for p in range(3)}
        members = {0: [0], 1: [0, 1], 2: [1]}
        quotas = [r.randint(0, 4), r.randint(0, 4)]
        used = mixing.min_cost_flow(sizes, members, quotas, 2)
        cost = sum(sum(i // n for i in range(round(used[p]))) for p, n in sizes.items() if n)
        assert (round(sum(used.values())), -cost) == cheapest(sizes, members, quotas, 2)


def test_overlapping_sources_repeat_only_what_they_must():
    # b's quota is served by fresh shared documents, a's repeats its own
    used = mixing.min_cost_flow({0: 10, 1: 10, 2: 10}, {0: [0], 1: [0, 1], 2: [1]}, [18, 12], 2)
    assert used == {0: 10.0, 1: 10.0, 2: 10.0}


def mixed(docs, **how):
    sized = docs.withColumn("words", word_count(F.col("text")))
    return mixing.mix(sized, "words", F.array("source"), F.xxhash64(F.lit("s"), F.col("doc_id")), **how)


def test_sources_meet_their_targets(spark, make, prose):
    texts = prose(7, 900, 5, 30)
    rows = [(i, t, "en", [None, "a", "b", "b", "b", "b"][i % 6]) for i, t in enumerate(texts)]
    taken, sizes, targets = mixed(make(rows))
    got = taken.collect()
    assert len(got) == len(rows)
    sums = {}
    for r in got:
        assert r.taken in (0, r.words, 2 * r.words)
        sums[r.source] = sums.get(r.source, 0) + r.taken
    assert sizes == {s: sum(len(t.split()) for _, t, _, x in rows if x == s) for s in (None, "a", "b")}
    for s, t in targets.items():
        assert abs(sums[s] - t) <= 30
    parts = mixed(make(rows), whole=False)[0].collect()
    assert all(0 <= r.taken <= 2 * r.words for r in parts)
    for s, t in targets.items():
        assert 0 <= t - sum(r.taken for r in parts if r.source == s) < 2
    again = {r.doc_id: r.taken for r in mixed(make(rows).repartition(7))[0].collect()}
    assert again == {r.doc_id: r.taken for r in got}


def test_odd_rows(spark, make, odd):
    taken, sizes, targets = mixed(make(odd))
    rows = taken.collect()
    assert len(rows) == len(odd) and all(r.taken <= 2 * r.words for r in rows)
    assert {(r.doc_id, r.words) for r in rows if not (r.text or "").strip()} == {(2, 0), (3, 0), (4, 0)}
    assert mixed(make([]))[0].count() == 0
    whole = mixing.repeated(make(odd).withColumn("words", word_count(F.col("text"))), "words", F.array("source"), F.xxhash64("doc_id"))
    assert whole.columns == make(odd).columns and whole.where("text is null").count() == 0


def test_word_count(spark):
    texts = ["", None, " ", "a", " a b\t\nc ", "a b c", "\x1ca b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [0, 0, 0, 1, 3, 2, 2]


def test_word_count_at_odd_line_ends_and_long_runs(spark):
    texts = ["a  ", "a \x85", "one two  ", "\n", "a\n", "a" + " " * 1_000_000 + "b", "w" * 1_000_000 + " x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [2, 2, 3, 0, 1, 2, 2]


def test_sources_with_any_character(spark, make):
    names = ["a\x1fb", "a", "=b", "-", "", None, "b", *[f"s{chr(i)}" for i in range(32)]]
    rows = [(i, "one two three", "en", s) for i, s in enumerate(names)]
    taken, sizes, targets = mixed(make(rows))
    assert sorted(str(r.source) for r in taken.collect()) == sorted(map(str, names))
    assert sizes == dict.fromkeys(names, 3) and set(targets) == set(names)
