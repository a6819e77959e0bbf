"""A stored index of texts by their trigrams: which texts hold a term, without reading them all.

Postings (trigram, text) are stored in folders by bucket of the trigram, so a
search reads the buckets of its terms' trigrams only.  An update stores what has
changed, as one more published part; a posting counts while its text's newest
entry has the same number, so nothing is rewritten until ``build`` is called again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.sources import versions

#: Folders that postings are dealt over; an index keeps the number that it was built with.
BUCKETS = 64
GRAM = 3
TEXTS = "text_id string, text string"
POSTINGS = "g string, text_id string, of long, bucket int"


def _grams(text: Column) -> Column:
    n = F.length(text)
    return F.array_distinct(F.when(n >= GRAM, F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>")))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _parts(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    """All published entries of a table of the index, with the number of their part."""
    rows = versions.history(spark, root).orderBy("version").collect()  # a row for each update
    parts = [spark.read.schema(schema).parquet(f"{root}/{r['folder']}").withColumn("part", F.lit(r["version"]).cast("long")) for r in rows]
    return reduce(DataFrame.unionByName, parts) if parts else None


def entries(spark: SparkSession, root: str) -> DataFrame:
    """``text_id, text, part``: the newest entry of each text; removed ones are absent."""
    parts = _parts(spark, f"{root}/texts", TEXTS)
    if parts is None:
        return spark.createDataFrame([], f"{TEXTS}, part long")
    newest = parts.groupBy("text_id").agg(F.max_by(F.struct("text", "part"), "part").alias("x")).select("text_id", "x.*")
    return newest.where("text IS NOT NULL")


def _add(changed: DataFrame, root: str) -> int:
    """Publishes entries (a null text removes one).  The postings come first and count for
    nothing until their texts are there under the same number."""
    spark = changed.sparkSession
    seen = versions.latest(spark, f"{root}/texts")
    postings = changed.where("text IS NOT NULL").select(F.explode(_grams(F.col("text"))).alias("g"), "text_id").withColumns({"of": F.lit(seen + 1).cast("long"), "bucket": _bucket(F.col("g"))})
    versions.publish(postings, f"{root}/grams", columns=None, by=["bucket"])
    return versions.publish(changed, f"{root}/texts", columns=None, seen=seen)


def build(texts: DataFrame, root: str) -> int:
    """A new index in an empty folder, of ``texts(text_id, text)``; ids are text, unique and not
    null, null texts are not there."""
    if versions.latest(texts.sparkSession, f"{root}/texts"):
        raise ValueError(f"there is an index in {root}: update it, or build in a new folder")
    return _add(texts.where("text IS NOT NULL").select("text_id", "text"), root)


def update(texts: DataFrame, root: str) -> int:
    """Makes the index that of ``texts``: stores new, changed and removed texts, and returns how many."""
    old = entries(texts.sparkSession, root).select("text_id", F.col("text").alias("old"))
    new = texts.where("text IS NOT NULL").select("text_id", "text")
    changed = new.join(old, "text_id", "full").where(~F.col("text").eqNullSafe(F.col("old"))).select("text_id", "text")
    n = changed.count()
    if n:
        _add(changed, root)
    return n


def search(terms: DataFrame, root: str, limit: int | None = None) -> DataFrame:
    """``term, text_id, text`` for ``terms(term)``: the indexed texts that hold each term, or the first
    ``limit`` of them by id.

    Exact: a text that holds the term has the term's rarest trigram.  Terms under
    three characters, and nulls, find nothing.  The limit is applied within each task
    before hits are shuffled."""
    spark = terms.sparkSession
    postings = _parts(spark, f"{root}/grams", POSTINGS)
    live = entries(spark, root)
    asked = terms.where(F.length("term") >= GRAM).select("term").distinct().select("term", F.explode(_grams(F.col("term"))).alias("g"))
    if postings is None:
        return live.select(F.lit("").alias("term"), "text_id", "text").limit(0)
    wanted = asked.select("g").distinct().withColumn("bucket", _bucket(F.col("g")))
    held = postings.join(wanted, ["bucket", "g"]).select("g", "text_id", "of")
    often = held.groupBy("g").agg(F.count("*").alias("n"))
    rarest = asked.join(often, "g", "left").groupBy("term").agg(F.min_by("g", F.struct(F.coalesce("n", F.lit(0)), F.col("g"))).alias("g"))
    met = rarest.join(held, "g").join(live.withColumnRenamed("part", "of"), ["text_id", "of"]).where(F.col("text").contains(F.col("term")))
    met = met.select("term", "text_id", "text")
    if limit is None:
        return met
    nth = F.row_number().over(W.partitionBy("term").orderBy("text_id"))
    return met.withColumn("_nth", nth).where(F.col("_nth") <= limit).drop("_nth")
