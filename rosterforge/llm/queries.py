"""The production query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm import interaction, jaccard_join, kneser_ney, line_templates, lm_scoring, merkle, mixing, nra, packing, sanitise, simhash, sql, token_counts, whitening
from rosterforge.llm.common import table, word_count


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents against those labelled good and not toxic."""
    labels = table(spark, sf_dir, "labels")
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexities of all documents, and which are kept."""
    labels = table(spark, sf_dir, "labels")
    return kneser_ney.classify(table(spark, sf_dir, "documents"), kneser_ney.trusted_ids(labels), good=kneser_ney.good_ids(labels))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents: sources weigh 3, 1, 2, repeating; 150% of all words; twice at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    order = F.xxhash64(F.lit("mix-1"), F.col("doc_id"))
    taken, sizes, targets = mixing.mix(docs, "size", F.array("source"), order, whole=False)
    of = spark.createDataFrame([(s, n, float(targets[s])) for s, n in sizes.items()], "s string, source_size long, target double")
    of = F.broadcast(of) if len(sizes) <= mixing.BROADCAST_PATTERNS else of
    return taken.join(of, F.col("source").eqNullSafe(F.col("s")), "left").select("doc_id", "size", "source_size", "target", "taken")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links all documents whose fingerprints differ in at most 2 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)
    return found.select(F.col("_key").alias("doc_id"), "fingerprint", "component_id")


def word_tokenizer() -> str:
    """The path of the public tokenizer that packing uses; each node has its own copy."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs the ids of all documents into sequences of at most 2048."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, word_tokenizer(), 2048), 2048, ["doc_id", "piece", "start", "ids_crc32"])


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts."""
    return merkle.compare_edited(table(spark, sf_dir, "documents"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose template recurs."""
    return line_templates.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def piece_vocabulary() -> str:
    """The path of the public vocabulary that token counts use; each node has its own copy."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, piece_vocabulary()).drop("text")


def op9_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for each whose id is divisible by 50."""
    return nra.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op10_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents and the terms that reveal them."""
    return sanitise.find(table(spark, sf_dir, "documents"))


def op11_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of five filters over all documents, by source."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    marks = labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    counts = interaction.profile(docs, interaction.text_conditions(F.col("text")), marks)
    return interaction.audit(counts, "ABCDE", ["good", "toxic"])


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links all documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_join.groups(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened along their 8 strongest components."""
    return whitening.whiten(whitening.quantised(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_kneser_ney,
        op3_mixing,
        op4_simhash,
        op5_packing,
        op6_merkle,
        op7_line_templates,
        op8_token_counts,
        op9_nra,
        op10_sanitise,
        op11_interaction,
        op12_jaccard_join,
        op13_whitening,
    )
}

#: The other queries are tested against brute force.
SQL: dict[str, str] = {"op7_line_templates": sql.OP7, "op9_nra": sql.OP9, "op11_interaction": sql.OP11}
