import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rosterforge.llm import grams, kneser_ney, lm_scoring
from rosterforge.llm.common import row_key

PAD = "￿"


def ngrams(text):
    units = text.encode("utf-16-le", "surrogatepass")
    u = [PAD] * 3 + [units[i : i + 2] for i in range(0, len(units), 2)]
    return [tuple(u[i : i + 4]) for i in range(len(u) - 3)]


def plain_kneser_ney(trusted):
    """Interpolated modified Kneser-Ney from its definition."""
    counts = {4: Counter(g for t in trusted for g in ngrams(t))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    less, total, freed = {}, {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        d = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0 for i in (1, 2, 3)]
        d = [x if 0 < x < i else i / 2 for i, x in zip((1, 2, 3), d, strict=True)]
        less[k] = lambda v, d=d: d[min(v, 3) - 1]
        total[k], freed[k] = defaultdict(float), defaultdict(float)
        for g, v in c.items():
            total[k][g[:-1]] += v
            freed[k][g[:-1]] += less[k](v)
    base = 1 / (len(counts[1]) + 1)

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else base
        if g[:-1] not in total[k]:
            return low
        v = counts[k].get(g, 0)
        return ((v - less[k](v) if v else 0) + freed[k][g[:-1]] * low) / total[k][g[:-1]]

    return p


@pytest.fixture(scope="module")
def corpus(prose):
    good = prose(21, 60, 5, 25)
    bad = [t.upper().replace(" ", "!! ") for t in prose(22, 8, 5, 25)]
    return [(i, t, "en" if i % 3 else "de") for i, t in enumerate([*good, *bad])]


def test_perplexities_are_kneser_neys(spark, make, corpus, odd):
    trusted = spark.range(0, 50).withColumnRenamed("id", "doc_id")
    p = plain_kneser_ney([t for i, t, _ in corpus if i < 50])
    extra = [(100, None, "en"), (101, "", "en"), (102, "q😀z", None)]
    got = {r.doc_id: r for r in kneser_ney.classify(make([*corpus, *extra]), trusted).collect()}
    for i, t, *_ in [*corpus, extra[2]]:
        want = -sum(math.log(p(g)) for g in ngrams(t)) / len(ngrams(t))
        assert got[i].log_perplexity == pytest.approx(want, abs=1e-5)
    assert sum(math.exp(math.log(p((PAD, PAD, PAD, c[-1])))) for c in {g[-1:] for t in corpus[:50] for g in ngrams(t[1])}) < 1.0001
    assert got[100].log_perplexity is None and not got[100].keep and not got[101].keep
    assert all(got[i].keep for i in range(60)) and not any(got[i].keep for i in range(60, 68))
    kept = kneser_ney.keep_good(make([*corpus, *extra]), trusted)
    assert kept.columns == make([]).columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].keep}


def test_thresholds_are_quartiles_of_the_language(spark):
    df = spark.createDataFrame([("en", float(i)) for i in range(1, 101)] + [(None, 5.0)], "lang string, log_perplexity double")
    t = {r.lang: r.threshold for r in kneser_ney.thresholds(df).collect()}
    assert t["en"] == pytest.approx(75 + 3 * 50, abs=0.01) and t[None] == pytest.approx(5, abs=0.01)


def test_both_ways_of_summing_agree(spark, make, corpus, odd):
    docs = make([*corpus, *odd])
    values = grams.counts(docs, F.col("text"), {"n": F.lit(True)}).select("gram", (F.col("gram") % 7).cast("double").alias("v"))
    rows = docs.withColumn("row", row_key("doc_id", "text"))
    a, b = (sorted(map(str, grams.document_sums(rows, "doc_id", "text", ["row"], values, ["v"], most).collect())) for most in (10**6, 0))
    assert a == b and len(a) == len(corpus) + len(odd)


def test_scores_are_loss_differences(spark, make, corpus):
    target = spark.range(0, 20).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r for r in lm_scoring.score(make(corpus), target).collect()}
    t, b = Counter(), Counter()
    for i, text, *_ in corpus:
        for g in ngrams(text):
            b[g] += 1
            t[g] += i < 20
    scale = sum(t.values()) / sum(b.values())
    vocabulary = len({g[-1] for g in b})

    def model(counts, by):
        tables = {4: {g: counts[g] * by for g in b}}
        for k in (3, 2, 1):
            tables[k] = defaultdict(float)
            for g, v in tables[k + 1].items():
                tables[k][g[1:]] += v
        totals = {k: defaultdict(float) for k in tables}
        for k, table in tables.items():
            for g, v in table.items():
                totals[k][g[:-1]] += v
        p = lambda g: (tables[len(g)][g] + lm_scoring.PRIOR * (p(g[1:]) if len(g) > 1 else 1 / vocabulary)) / (totals[len(g)][g[:-1]] + lm_scoring.PRIOR)
        return p

    pt, pb = model(t, 1), model(b, scale)
    for i, text, *_ in corpus[::7]:
        lt = -sum(math.log(pt(g)) for g in ngrams(text)) / len(ngrams(text))
        lb = -sum(math.log(pb(g)) for g in ngrams(text)) / len(ngrams(text))
        assert got[i].target_loss == pytest.approx(lt, abs=1e-5) and got[i].score == pytest.approx(lt - lb, abs=1e-5)
    mean = lambda ids: sum(got[i].score for i in ids) / len(ids)
    assert mean(range(20)) < mean(range(20, 60)) < mean(range(60, 68))


def test_odd_rows(spark, make, odd):
    none = spark.createDataFrame([], "doc_id long")
    for target in (none, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")):
        scores = lm_scoring.score(make(odd), target).collect()
        assert len(scores) == len(odd) and {r.score for r in scores if r.doc_id in (2, 3)} == {None}
        assert len(kneser_ney.classify(make(odd), target).collect()) == len(odd)
        assert lm_scoring.score(make([]), target).count() == 0 and kneser_ney.classify(make([]), target).count() == 0
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(50)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    assert kneser_ney.trusted_ids(labels, 10).count() == 10 and kneser_ney.trusted_ids(labels).count() == 25


def test_copies_of_one_text_do_not_move_the_threshold(spark, make, prose):
    texts = prose(23, 40, 5, 25)
    trusted = spark.range(0, 20).withColumnRenamed("id", "doc_id")
    rows = [(i, t, "de") for i, t in enumerate(texts)]
    copies = [(1000 + i, texts[3], "de") for i in range(150)]
    alone, skewed = ({r.doc_id: (r.threshold, r.keep) for r in kneser_ney.classify(make(x), trusted).collect()} for x in (rows, [*rows, *copies]))
    assert all(skewed[i] == alone[i] for i in range(40))
    assert {skewed[1000 + i] for i in range(150)} == {alone[3]} and sum(k for _, k in alone.values()) >= 38


def test_the_model_learns_from_all_trusted_documents(spark):
    labels = spark.range(21_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert kneser_ney.trusted_ids(labels).count() == 21_000


def test_many_trusted_ids_are_joined_alike(spark, make, prose, monkeypatch):
    docs, trusted = make([(i, t, "de") for i, t in enumerate(prose(29, 30, 5, 25))]), spark.range(0, 20).withColumnRenamed("id", "doc_id")
    told = sorted(map(str, kneser_ney.classify(docs, trusted).collect()))
    monkeypatch.setattr(kneser_ney, "BROADCAST_IDS", 0)
    assert sorted(map(str, kneser_ney.classify(docs, trusted).collect())) == told


def test_discounts_of_all_orders_take_one_query(spark):
    table = lambda *c: spark.createDataFrame([(i, x) for i, x in enumerate(c)], "gram long, c long")
    found = kneser_ney._discounts({1: table(1, 1, 1, 2, 2, 3, 4, 9), 2: table(), 3: table(5, 6)})
    y = 3 / 7
    assert found == {1: (8, [1 - 2 * y * 2 / 3, 2 - 3 * y / 2, 3 - 4 * y]), 2: (0, [0.5, 1.0, 1.5]), 3: (2, [0.5, 1.0, 1.5])}
