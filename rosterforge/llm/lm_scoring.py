"""Language-model scoring: cross-entropy difference of two matched n-gram models.

The target model counts trusted documents, the background model all documents.
Both use one vocabulary (every unit of the corpus), one order and one smoothing
(Dirichlet priors from the next shorter n-gram); the background's counts are
scaled to the target's total, so that neither gains from its size.  A document's
score is the mean over its tokens of target loss minus background loss: the
lower, the more it is like the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut
from rosterforge.llm.grams import ORDER, context, counts, document_sums, shorter

#: Tokens that the shorter n-gram's estimate weighs.
PRIOR = 8.0
#: Target ids up to which they are broadcast to the scan (8 bytes each).
BROADCAST_IDS = 2_000_000


def losses(grams: DataFrame) -> DataFrame:
    """``grams(gram, target, background)`` of the whole corpus -> ``gram``, the loss (nats)
    of its last unit under each model."""
    total = grams.agg(F.coalesce(F.sum("target"), F.lit(0)).alias("t"), F.coalesce(F.sum("background"), F.lit(0)).alias("b")).first()
    scale = total["t"] / total["b"] if total["b"] else 0.0
    tables = {ORDER: grams.select("gram", F.col("target").cast("double").alias("t"), (F.col("background") * scale).alias("b"))}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = cut(tables[k + 1].groupBy(shorter(F.col("gram"), k).alias("gram")).agg(F.sum("t").alias("t"), F.sum("b").alias("b")))
    vocabulary = max(1, tables[1].count())
    below = None
    for k in range(1, ORDER + 1):
        here = tables[k].withColumn("ctx", context(F.col("gram")) if k > 1 else F.lit(0).cast("long"))
        contexts = here.groupBy("ctx").agg(F.sum("t").alias("all_t"), F.sum("b").alias("all_b"))
        here = here.join(contexts, "ctx").withColumn("low", shorter(F.col("gram"), k - 1) if k > 1 else F.lit(0).cast("long"))
        if below is None:
            here = here.withColumns({"p_t": F.lit(1.0 / vocabulary), "p_b": F.lit(1.0 / vocabulary)})
        else:
            here = here.join(below, "low")
        p = {m: (F.col(m) + PRIOR * F.col(f"p_{m}")) / (F.col(f"all_{m}") + PRIOR) for m in ("t", "b")}
        below = cut(here.select(F.col("gram").alias("low"), p["t"].alias("p_t"), p["b"].alias("p_b")))
    return below.select(F.col("low").alias("gram"), (-F.log("p_t")).alias("target_loss"), (-F.log("p_b")).alias("background_loss"))


def score(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, tokens, target_loss, background_loss, score`` of every row, losses a token.

    ``target(doc_id)`` names the target documents.  Texts without tokens (null
    or empty) have null losses and score.  Without target documents both models
    are equal and all scores are 0.  Repeated rows count and stay."""
    ids = target.select(F.col("doc_id").alias(key)).where(F.col(key).isNotNull()).distinct().withColumn("_in", F.lit(True))
    few = ids.count() <= BROADCAST_IDS
    marked = docs.select(key, text).join(F.broadcast(ids) if few else ids, key, "left")
    grams = cut(counts(marked, F.col(text), {"target": F.col("_in"), "background": F.lit(True)}))
    known = losses(grams)
    sums = document_sums(docs, key, text, [], known, ["target_loss", "background_loss"])
    mean = {m: F.when(F.col("units") > 0, F.round(F.col(m) / F.col("units"), 6)) for m in ("target_loss", "background_loss")}
    return sums.select(key, F.col("units").alias("tokens"), mean["target_loss"].alias("target_loss"), mean["background_loss"].alias("background_loss")).withColumn(
        "score", F.round(F.col("target_loss") - F.col("background_loss"), 6)
    )
