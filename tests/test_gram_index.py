import random

import pytest

from rosterforge.sources import gram_index as G
from rosterforge.sources import versions


def texts(spark, rows):
    return spark.createDataFrame(rows, "text_id string, text string")


def by_loop(rows, terms, limit=None):
    out = set()
    for term in set(terms):
        if term and len(term) >= 3:
            found = sorted(i for i, t in rows if t is not None and term in t)
            out |= {(term, i) for i in found[:limit]}
    return out


def got(spark, terms, root, limit=None):
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    found = G.search(df, root, limit).collect()
    out = {(r.term, r.text_id) for r in found}
    assert len(out) == len(found) and all(r.term in r.text for r in found)
    return out


def test_index_follows_its_texts(spark, tmp_path):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcä") for _ in range(r.randint(1, 9)))
    rows = [(f"t{i:03}", word()) for i in range(200)] + [("n", None), ("e", "")]
    terms = [word()[: r.randint(1, 5)] for _ in range(120)] + [None, "", "ab"]
    root = str(tmp_path / "index")
    G.build(texts(spark, rows), root)
    assert got(spark, terms, root) == by_loop(rows, terms)
    assert got(spark, terms, root, 2) == by_loop(rows, terms, 2)
    now = [(i, word() if int(i[1:] or 0) % 40 == 0 else t) for i, t in rows if len(i) == 4 and i != "t007"] + [("t999", "abcabc")]
    n = G.update(texts(spark, now), root)
    assert n == len(set(now) ^ {x for x in rows if x[1] is not None}) - sum(1 for i, t in now if (i, t) not in rows and i != "t999")
    assert got(spark, [*terms, "abca"], root) == by_loop(now, [*terms, "abca"])
    assert G.update(texts(spark, now), root) == 0 and versions.latest(spark, f"{root}/texts") == 2
    with pytest.raises(ValueError, match="update"):
        G.build(texts(spark, rows), root)


def test_an_empty_index(spark, tmp_path):
    root = str(tmp_path / "none")
    assert got(spark, ["abc"], root) == set()
    G.build(texts(spark, []), root)
    assert got(spark, ["abc"], root) == set()
    assert G.update(texts(spark, [("a", "xabcx")]), root) == 1 and got(spark, ["abc"], root) == {("abc", "a")}
