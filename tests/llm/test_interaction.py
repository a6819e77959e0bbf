import itertools
import math
import random
import re

import duckdb
from pyspark.sql import functions as F

from rosterforge.llm import interaction as ia
from rosterforge.llm.sql import OP11


def fails(rows):
    low = {}
    for i, t, *_ in rows:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        out.append(
            {
                "A": len(w) < 50,
                "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and low[t] < i,
            }
        )
    return out


def by_running_every_order(rows, labels):
    """Applies every order to the documents themselves."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, failed = {}, fails(rows)
    for part in {r[3] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, failed, strict=True) if (r[3] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        found = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [i for i, f in left if f[x]]
                left = [(i, f) for i, f in left if not f[x]]
                total[x] += len(gone)
                alone = sum(f[x] and sum(f.values()) == 1 for _, f in own)
                found[order, step] = [len(left), len(gone), sum(f[x] for _, f in own) - len(gone), alone, sum(i in good for i in gone), sum(i in toxic for i in gone)]
        out |= {(part, o, s): (*v, total[o[s - 1]]) for (o, s), v in found.items()}
    return out


def run(spark, docs, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    counts = ia.profile(docs, ia.text_conditions(F.col("text")), marks)
    got = ia.audit(counts, "ABCDE", ["good", "toxic"])
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = got.collect()
    out = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_equal_to_running_every_order(spark, make, prose):
    r = random.Random(3)
    texts = prose(4, 60, 20, 120)
    rows = []
    for i in range(300):
        t = r.choice(texts) if r.random() < 0.5 else r.choice(prose(i, 1, 30, 150))
        t = t.upper() if r.random() < 0.2 else t
        t = t + " $5 | x" if r.random() < 0.2 else t
        rows.append((r.randrange(250), t, "en", r.choice(["a", "b", "b", "b", None, ""])))
    labels = [(r.randrange(250), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(150)]
    assert run(spark, make(rows).repartition(5), labels) == by_running_every_order(rows, labels)


def test_odd_rows_and_one_text_in_a_third(spark, make, odd):
    rows = [*odd, *[(100 + i, "the same text", "en", "a" if i % 2 else "b") for i in range(20)], (None, "the same text", "en", "a")]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (100, None, 1)]
    got = run(spark, make(rows), labels)
    assert got == by_running_every_order(rows, labels)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", [(*r, *(None,) * (4 - len(r))) for r in rows])
    con.execute("create table labels (doc_id bigint, quality int, toxic int)")
    con.executemany("insert into labels values (?, ?, ?)", labels)
    assert {tuple(x)[:3]: tuple(x)[3:] for x in con.execute(OP11).fetchall()} == got
    assert run(spark, make([]), []) == {}


def test_path_weights_count_orders():
    for k in (1, 2, 5, 7):
        w = ia.path_weights(k)
        assert sum(w.values()) == k * math.factorial(k)
        assert all(n == math.factorial(bin(s).count("1")) * math.factorial(k - 1 - bin(s).count("1")) for (s, _), n in w.items())
