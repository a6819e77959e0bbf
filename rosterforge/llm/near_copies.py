"""Near copies: texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Covering locality-sensitive hashing of the sets' SimHashes proposes the closest
pairs, and their sets are compared before any is linked.  Pairs at the threshold
differ in about ten of 64 bits, out of its reach: the join of ``jaccard_join``
finds the links between what is not yet in one group, so none is lost.  Texts
of one shingle set are one node from the start, so exact copies, however many, cost nothing more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut, row_key
from rosterforge.llm.jaccard_join import BROADCAST_ROWS, linked
from rosterforge.llm.simhash import links

WORDS = 5
SIMILAR = (80, 100)


def proposed(sets: DataFrame) -> DataFrame:
    """``sets(s, fp)`` -> pairs ``(u, v)`` of sets to compare: those of one SimHash with the
    smallest of them, and these as the covering tables link SimHashes of at most two differing bits."""
    fps = cut(sets.groupBy("fp").agg(F.min("s").alias("low"), F.max("s").alias("top")))
    same = sets.join(fps.where("low < top"), "fp").where(F.col("s") != F.col("low")).select(F.col("s").alias("u"), F.col("low").alias("v"))
    ends = [fps.select(F.col("fp").alias(x), F.col("low").alias(f"s_{x}")) for x in ("u", "v")]
    near = links(fps.select("fp")).join(ends[0], "u").join(ends[1], "v").select("s_u", "s_v")
    return same.unionAll(near).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def groups(docs: DataFrame, text: str = "text", words: int = WORDS, key: str = "doc_id") -> DataFrame:
    """``_key, _row, component_id, root`` of every row: the smallest ``key`` that a chain of
    links reaches (null only if the group has no other).  Texts without words, null
    ones among them, are one group."""
    marked, kinds, stars = linked(docs, text, key, words, SIMILAR, proposed)
    rooted = kinds.join(stars, kinds["s"] == stars["node"], "left").select("s", "low", F.coalesce("root", "s").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return marked.join(rooted.join(ids, "root").select("s", "component_id", "root"), "s").select("_key", "_row", "component_id", "root")


def keep_one(docs: DataFrame, text: str = "text", words: int = WORDS, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near copies.

    The row with the group's smallest key stays; among rows of that key, the one
    with the smallest row hash; of fully equal rows, one.  Texts without words are
    one group; null keys come last.  An empty table gives no rows."""
    found = groups(docs, text, words, key)
    best = found.groupBy("root").agg(
        F.min(F.struct(F.coalesce(F.col("_key") != F.col("component_id"), F.lit(True)), F.col("_row"))).alias("b")
    )
    best = best.select(F.col("b._row").alias("_row"), F.lit(True).alias("_stays"))
    # what goes, and what stays but repeats: few beside the texts, which then need not be shuffled
    marks = found.groupBy("_row").agg(F.count("*").alias("n")).join(best, "_row", "left").where("_stays is null or n > 1")
    marks = cut(marks.select("_row", "_stays"))
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks
    keyed = docs.withColumn("_row", row_key(key, text))
    single = keyed.join(marks, "_row", "left_anti")
    repeats = keyed.join(marks.where("_stays"), "_row", "left_semi").dropDuplicates(["_row"])
    return single.unionByName(repeats).drop("_row")
