"""SimHash near-duplicates by covering locality-sensitive hashing.

A 64-bit SimHash of word shingles stands for each text.  Every bit position
gets one of the 2^(r+1)-1 non-zero vectors of r+1 bits; table v keeps the
positions whose vector has an odd product with v.  Any r positions leave a
non-zero v orthogonal to all their vectors, so two fingerprints that differ in
at most r bits agree on all that some table keeps: no pair within the radius
is missed.  Fingerprints alone in all their buckets are done; the others are
linked through midpoints (see ``links``), with no pairs within a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut, row_key
from rosterforge.llm.components import connected_components

BITS = 64
#: The radius for which ``links`` is exact: two points at distance 2 have a
#: common point at distance 1 from both.
RADIUS = 2


def shingles(text: str | None, words: int) -> np.ndarray:
    """Hashes (uint64) of a text's word shingles in order; a shorter text is one shingle."""
    w = text.encode().lower().split() if text else ()  # bytes: A-Z and ASCII space only
    if not w:
        return np.empty(0, np.uint64)
    buf, n = b" ".join(w), len(w)
    if n <= words:
        return np.asarray([xxhash.xxh64_intdigest(buf, 42)], np.uint64)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, last = xxhash.xxh64_intdigest, n - words + 1
    return np.fromiter(
        (digest(buf[a:b], 42) for a, b in zip(starts[:last].tolist(), ends[words - 1 :].tolist(), strict=True)),
        np.uint64,
        last,
    )


def text_fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included."""
    return set_fingerprint(shingles(text, words))


def set_fingerprint(h: np.ndarray) -> int:
    """Signed 64-bit SimHash of hashes (uint64), each as often as it stands there; none give 0."""
    last = len(h)
    if not last:
        return 0
    ones = np.zeros(BITS, np.int64)
    for part in range(0, last, 65536):  # bounds the unpacked bits of very long texts
        ones += np.unpackbits(h[part : part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, out: str = "fp") -> DataFrame:
    """Adds ``out`` (long): the SimHash of ``text``; null or wordless text gives 0."""

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_fingerprint(t, words) for t in texts], dtype="int64")

    return docs.withColumn(out, simhash(F.col(text)))


def covering_masks(radius: int) -> list[int]:
    """The kept bit positions of each table as 64-bit masks."""
    vectors = range(1, 2 ** (radius + 1))
    of = [1 + i % len(vectors) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if bin(of[i] & v).count("1") % 2) for v in vectors]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame) -> DataFrame:
    """``fps(fp)`` distinct -> ``(u, v)``: true links (at most ``RADIUS`` differing
    bits) that connect exactly what all links of the table connect.

    Buckets of the covering tables show which fingerprints can have a partner and
    in which positions they may differ from it (those its shared buckets leave
    out).  Each such fingerprint goes to itself and to its one-bit neighbours in
    those positions.  All that meet at a point lie within two bits of each other,
    and each pair within two bits meets, so linking every point's visitors to the
    smallest one keeps all components at a cost linear in the visitors."""
    tables = [
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("k"), F.lit(_signed(~m & (1 << BITS) - 1)).alias("free"))
        for t, m in enumerate(covering_masks(RADIUS))
    ]
    spread = fps.select("fp", F.explode(F.array(*tables)).alias("b")).select("fp", "b.t", "b.k", "b.free")
    shared = spread.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1").select("t", "k")
    free = spread.join(shared, ["t", "k"]).groupBy("fp").agg(F.expr("bit_or(free)").alias("free"))
    single_bits = F.array(*[F.lit(_signed(1 << i)) for i in range(BITS)])
    steps = F.concat(F.array(F.lit(0).cast("long")), F.filter(single_bits, lambda b: F.col("free").bitwiseAND(b) != 0))
    visits = free.select("fp", F.explode(steps).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("mid"))
    low = visits.groupBy("mid").agg(F.min("fp").alias("v"), F.max("fp").alias("top")).where("v < top")
    edges = visits.join(low.select("mid", "v"), "mid").where("fp > v")
    return edges.select(F.col("fp").alias("u"), "v").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", words: int = 3, key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with ``fp`` (long), ``fingerprint`` (16 hex digits) and
    ``component_id``: the smallest ``key`` that a chain of links reaches.

    Exact copies share a fingerprint and are grouped first, with map-side
    minima; only distinct fingerprints are compared.  Null or empty texts have
    fingerprint zero and link like any other.  Null keys get the component's id
    (null only if the component has no other).  Repeated rows stay.  An empty
    table gives no rows; more columns are not carried along."""
    marked = fingerprints(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), row_key(key, text).alias("_row")), "_text", words, "_fp")
    marked = cut(marked.select("_key", "_row", "_fp"))
    fps = cut(marked.groupBy(F.col("_fp").alias("fp")).agg(F.min("_key").alias("low")))
    stars = connected_components(links(fps.select("fp")))
    rooted = fps.join(stars, fps["fp"] == stars["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(groups, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(of, "_fp").select(
        "_key", "_row", "_fp", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, text: str = "text", words: int = 3, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near-duplicates.

    The row with the component's smallest key stays; among rows of that key, the
    one with the smallest row hash; of fully equal rows, one."""
    found = near_duplicates(docs, text, words, key)
    best = found.groupBy("component_id").agg(
        F.min(F.struct(F.coalesce(F.col("_key") != F.col("component_id"), F.lit(True)), F.col("_row"))).alias("b")
    )
    rows = best.select(F.col("b._row").alias("_row"))
    keyed = docs.withColumn("_row", row_key(key, text))
    once = keyed.join(rows, "_row", "left_semi")
    # equal rows share a key; a table without any passes through unchanged
    return once.dropDuplicates(["_row"]).drop("_row")
