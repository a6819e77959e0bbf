"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

Counts of trusted text, continuation counts, discounts and context weights are
tables keyed (and so sharded) by n-gram; joined with the corpus' distinct
n-grams they give each one's log probability, and these each document's
perplexity.  A document is rejected where its log perplexity lies above that of
``SHARE`` of its language's trusted texts.  A language with fewer than ``ENOUGH`` of
these has the upper quartile of all its texts, raised by ``FENCE`` times the distance
of the quartiles.  All quantiles are over distinct texts: copies of a text, however
many, must not draw them to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.llm.common import cut, row_key
from rosterforge.llm.grams import ORDER, context, counts, document_sums, shorter

#: Trusted ids up to which they are broadcast to the scan (8 bytes each).
BROADCAST_IDS = 2_000_000
#: Share of a language's trusted texts that its threshold lets pass.
SHARE = 0.998
#: Trusted texts for such a threshold.
ENOUGH = 40
FENCE = 3.0
#: Languages up to which their thresholds are broadcast.
BROADCAST_LANGUAGES = 100_000
#: Log perplexities are counted in steps of so much, for exact quantiles.
STEP = 0.001


def good_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of all documents labelled good and not toxic."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct()


def trusted_ids(labels: DataFrame, bound: int | None = None) -> DataFrame:
    """``doc_id`` of all of these; of ``bound`` at most, if given, those whose ids have the smallest hashes."""
    good = good_ids(labels)
    return good if bound is None else good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def _discounts(tables: dict[int, DataFrame]) -> dict[int, tuple[int, list[float]]]:
    """By order, the n-grams and D1, D2 and D3+ from the counts of counts; fixed ones where
    these are too few.  One query over all tables."""
    all_ = reduce(DataFrame.unionAll, [t.select(F.lit(k).alias("k"), "c") for k, t in tables.items()])
    counted = all_.groupBy("k").agg(F.count("*"), *[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)])
    found = dict.fromkeys(tables, (0, 0, 0, 0, 0)) | {k: tuple(n) for k, *n in counted.collect()}

    def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        raw = [(i, i - (i + 1) * y * b / a if a else 0.0) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        return [d if 0 < d < i else i / 2 for i, d in raw]

    return {k: (n, discounts(*of)) for k, (n, *of) in found.items()}


def log_probabilities(trained: DataFrame, asked: DataFrame) -> DataFrame:
    """``trained(gram, c)`` and distinct ``asked(gram)`` of order ``ORDER`` -> ``gram, logp``."""
    tables = {ORDER: trained.select("gram", "c")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct units before the n-gram
        tables[k] = cut(tables[k + 1].groupBy(shorter(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("c")))
    found = _discounts(tables)
    alphabet = found[1][0]
    below = None
    for k in range(1, ORDER + 1):
        table = tables[k]
        d1, d2, d3 = map(F.lit, found[k][1])
        less = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        contexts = table.groupBy((context(F.col("gram")) if k > 1 else F.lit(0).cast("long")).alias("ctx")).agg(
            F.sum("c").alias("total"), F.sum(less).alias("freed")
        )
        here = asked.select(shorter(F.col("gram"), k).alias("gram")).distinct() if k < ORDER else asked.select("gram")
        here = here.withColumns({"ctx": context(F.col("gram")) if k > 1 else F.lit(0).cast("long"), "low": shorter(F.col("gram"), k - 1) if k > 1 else F.lit(0).cast("long")})
        here = here.join(table.withColumn("own", F.col("c") - less).select("gram", "own"), "gram", "left").join(contexts, "ctx", "left")
        here = here.join(below, "low") if below is not None else here.withColumn("p", F.lit(1.0 / (alphabet + 1)))
        p = F.when(F.col("total").isNull(), F.col("p")).otherwise((F.coalesce("own", F.lit(0.0)) + F.col("freed") * F.col("p")) / F.col("total"))
        below = cut(here.select(F.col("gram").alias("low"), p.alias("p")))
    return below.select(F.col("low").alias("gram"), F.log("p").alias("logp"))


def perplexities(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", carried: tuple[str, ...] = ()) -> DataFrame:
    """``key, lang, units, log_perplexity`` (nats a unit) and the ``carried`` columns of
    every row; texts without units have none (null)."""
    ids = trusted.select(F.col("doc_id").alias(key))
    mine = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_semi")
    trained = cut(counts(mine, F.col(text), {"c": F.lit(True)}))
    asked = cut(counts(docs, F.col(text), {"c": F.lit(True)}).select("gram"))
    known = log_probabilities(trained, asked)
    sums = document_sums(docs, key, text, [lang, *carried], known, ["logp"])
    return sums.select(key, *carried, F.col(lang).alias("lang"), "units", F.when(F.col("units") > 0, F.round(-F.col("logp") / F.col("units"), 6)).alias("log_perplexity"))


def thresholds(scored: DataFrame) -> DataFrame:
    """``lang, threshold`` from ``lang, log_perplexity`` and, where there is one, ``good`` of
    distinct texts.  They come from a histogram, so the same rows always give the same
    thresholds; its steps bound what a language's window holds."""
    good = F.coalesce(F.col("good"), F.lit(False)) if "good" in scored.columns else F.lit(False)
    bins = scored.where("log_perplexity is not null").groupBy("lang", F.floor(F.col("log_perplexity") / STEP).alias("bin"))
    bins = bins.agg(F.count("*").alias("n"), F.count_if(good).alias("g"))
    w = W.partitionBy("lang")
    sums = {"upto": F.sum("n").over(w.orderBy("bin")), "all": F.sum("n").over(w), "g_upto": F.sum("g").over(w.orderBy("bin")), "g_all": F.sum("g").over(w)}
    bins = bins.withColumns(sums)
    quantile = lambda q, of, all_: F.min(F.when(F.col(of) >= q * F.col(all_), F.col("bin"))) * STEP
    found = bins.groupBy("lang").agg(
        quantile(0.25, "upto", "all").alias("q1"), quantile(0.75, "upto", "all").alias("q3"), quantile(SHARE, "g_upto", "g_all").alias("share"), F.first("g_all").alias("g_all")
    )
    fence = F.col("q3") + FENCE * (F.col("q3") - F.col("q1"))
    return found.select("lang", F.round(F.when(F.col("g_all") >= ENOUGH, F.col("share")).otherwise(fence) + STEP, 6).alias("threshold"))


def classify(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", carried: tuple[str, ...] = (), good: DataFrame | None = None
) -> DataFrame:
    """``key, lang, units, log_perplexity, threshold, keep`` and the ``carried`` columns of every row.

    The model is trained on ``trusted(doc_id)``; the thresholds come from all of ``good(doc_id)``
    (the same, if not given).  Null languages are a language of their own.  Texts without
    units (null or empty) are not kept.  Without trusted text all units are equally likely
    and every other text is kept.  Repeated rows stay; an empty table gives none.  Columns
    of ``docs`` beyond those named are not looked at, whatever their names."""
    marked = docs.select(*dict.fromkeys([key, text, lang, *carried])).withColumn("_same", F.xxhash64(text))
    scored = cut(perplexities(marked, trusted, key, text, lang, ("_same", *carried)))
    of = (trusted if good is None else good).select(F.col("doc_id").alias(key), F.lit(True).alias("_good")).distinct()
    texts = scored.select(key, "lang", "_same", "log_perplexity").join(of, key, "left")
    texts = texts.groupBy("lang", "_same").agg(F.min("log_perplexity").alias("log_perplexity"), F.max("_good").alias("good"))
    limits = thresholds(texts).withColumnRenamed("lang", "_lang")
    limits = cut(limits)
    limits = F.broadcast(limits) if limits.count() <= BROADCAST_LANGUAGES else limits
    joined = scored.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    keep = F.coalesce(F.col("log_perplexity") <= F.col("threshold"), F.lit(False))
    return joined.select(key, *carried, "lang", "units", "log_perplexity", "threshold", keep.alias("keep"))


def keep_good(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", good: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with their columns; equal rows share their fate."""
    rows = docs.withColumn("_id", row_key(key, text, lang))
    found = classify(rows, trusted, key, text, lang, carried=("_id",), good=good)
    return rows.join(found.where(~F.col("keep")).select("_id").distinct(), "_id", "left_anti").drop("_id")
