"""A training corpus from raw documents: quality, lines, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm import kneser_ney, line_templates, mixing, near_copies, packing
from rosterforge.llm.common import stored, table, word_count
from rosterforge.llm.queries import word_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity under the trusted model is out of their language's range."""
    labels = table(spark, sf_dir, "labels")
    return kneser_ney.keep_good(docs, kneser_ney.trusted_ids(labels), good=kneser_ney.good_ids(labels)).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines whose template recurs in enough texts, fewer if it fixes more; their first occurrence stays."""
    return line_templates.dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: 0.8 or more of five-word shingles in common."""
    return near_copies.keep_one(docs).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents once, twice or not at all, so that sources meet their targets."""
    sized = docs.withColumn("_size", word_count(F.col("text")))
    order = F.xxhash64(F.lit("mix-1"), F.col("doc_id"))
    return mixing.repeated(sized, "_size", F.array("source"), order).select(COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' ids into sequences of at most 2048."""
    return packing.pack(packing.pieces(docs, word_tokenizer(), 2048), 2048, ["doc_id", "piece", "start", "ids_crc32"])


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("sequences", sequences),
]

#: SQL has neither the model nor the hashes nor the search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
