"""Counts and sums over the n-grams of whole texts, shared by the language models.

Tokens are UTF-16 code units, so an n-gram of order 4 is one 64-bit number, its
context that number shifted right by 16 and its shorter n-grams its low bits.
The alphabet bounds the tables, whatever the corpus holds of rare words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import row_key

ORDER = 4
#: What stands before a text's first unit (not a character).
START = np.full(ORDER - 1, 0xFFFF, np.uint16)
#: Units whose n-grams are in memory at a time.
PART = 500_000
#: Distinct n-grams that a task gathers before it passes their counts on.
GATHERED = 1_000_000
#: Entries up to which a table of values is broadcast (8 bytes a value and key); larger ones are joined.
BROADCAST_GRAMS = 3_000_000
#: Copies of such a joined table, among which an n-gram's documents are dealt.
SALTS = 16


def context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def shorter(gram: Column, order: int) -> Column:
    """The last ``order`` units of an n-gram."""
    return gram.bitwiseAND((1 << 16 * order) - 1)


def parts(texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text's number, units of each text, all their n-grams in a row)."""
    first, pieces, lens, size = 0, [], [], 0

    def grams() -> tuple[int, np.ndarray, np.ndarray]:
        n = np.asarray(lens, np.int64)
        a = np.concatenate(pieces).astype(np.uint64)
        g = reduce(lambda x, y: (x << np.uint64(16)) | y, [a[i : len(a) - ORDER + 1 + i] for i in range(ORDER)])
        # skip the n-grams that end in the start units of the next text
        at = np.arange(n.sum()) + np.repeat(np.arange(len(n)) * len(START), n)
        return first, n, g[at].view(np.int64)

    for i, text in enumerate(texts):
        units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
        pieces += [START, units]
        lens.append(len(units))
        size += len(units)
        if size >= PART:
            yield grams()
            first, pieces, lens, size = i + 1, [], [], 0
    if lens:
        yield grams()


def counts(docs: DataFrame, text: Column, marks: dict[str, Column]) -> DataFrame:
    """``gram`` and, for each of ``marks``, how often it occurs in rows where the mark holds.

    Tasks add up what they read before anything is shuffled."""
    names = list(marks)
    rows = docs.select(F.coalesce(text, F.lit("")).alias("text"), *[F.coalesce(c, F.lit(False)).alias(m) for m, c in marks.items()])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def total() -> pd.DataFrame:
            return pd.concat(held).groupby("gram", sort=False, as_index=False).sum()

        held, size = [], 0
        for batch in batches:
            on = {m: batch[m].to_numpy(bool) for m in names}
            for first, n, g in parts(batch["text"]):
                codes, distinct = pd.factorize(g)
                found = {"gram": distinct}
                for m in names:
                    mine = np.repeat(on[m][first : first + len(n)], n)
                    found[m] = np.bincount(codes if mine.all() else codes[mine], minlength=len(distinct))
                held.append(pd.DataFrame(found))
                size += len(distinct)
                if size > GATHERED:
                    held = [total()]
                    size = len(held[0])
                    if size > GATHERED // 2:
                        yield held.pop()
                        size = 0
        if held:
            yield total()

    schema = ", ".join(["gram long", *[f"{m} long" for m in names]])
    return rows.mapInPandas(count, schema).groupBy("gram").agg(*[F.sum(m).alias(m) for m in names])


def document_sums(docs: DataFrame, key: str, text: str, carried: list[str], values: DataFrame, names: list[str], broadcast_up_to: int = BROADCAST_GRAMS) -> DataFrame:
    """``docs``' ``key`` and ``carried`` columns with ``units`` (long) and, for each of
    ``names``, the sum (double) of that column of ``values(gram, ...)`` over the
    n-grams of the text.  ``values`` must hold every n-gram of the texts.

    A table of checked size goes to all tasks; a larger one is joined with each
    document's distinct n-grams, frequent ones dealt among copies of it."""
    n = values.count()
    rows = docs.withColumns({"_text": F.coalesce(F.col(text), F.lit("")), "_row": row_key(key, text)}).select(*dict.fromkeys([key, *carried]), "_row", "_text")
    schema = "_row long, units long, " + ", ".join(f"{m} double" for m in names)
    if n <= broadcast_up_to:
        table = values.select("gram", *names).toPandas().sort_values("gram")
        known = docs.sparkSession.sparkContext.broadcast((table["gram"].to_numpy(np.int64), table[names].to_numpy(np.float64)))

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grams, of = known.value
            for batch in batches:
                total, units = np.zeros((len(batch), len(names))), np.zeros(len(batch), np.int64)
                for first, n, g in parts(batch["_text"]):
                    codes, distinct = pd.factorize(g)
                    worth = of[np.searchsorted(grams, distinct)]
                    own = np.flatnonzero(n)
                    units[first : first + len(n)] = n
                    if len(own):
                        ends = np.concatenate(([0], np.cumsum(n)))[own]
                        for j in range(len(names)):
                            total[first + own, j] = np.add.reduceat(worth[codes, j], ends)
                yield batch.drop(columns="_text").assign(units=units, **{m: total[:, j] for j, m in enumerate(names)})

        out = rows.drop("_text").schema.simpleString()[7:-1].replace(":", " ") + ", units long, " + ", ".join(f"{m} double" for m in names)
        found = rows.mapInPandas(add, out)
        return found.select(*rows.columns[:-2], "units", *[F.round(m, 6).alias(m) for m in names])

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, n, g in parts(batch["_text"]):
                doc = np.repeat(np.arange(len(n)) + first, n)
                found = pd.DataFrame({"_row": batch["_row"].to_numpy()[doc], "gram": g, "n": 1})
                yield found.groupby(["_row", "gram"], as_index=False).sum()

    mine = rows.dropDuplicates(["_row"]).select("_row", "_text").mapInPandas(spread, "_row long, gram long, n long")
    mine = mine.withColumn("salt", F.pmod("_row", F.lit(SALTS)).cast("int"))
    copies = values.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    sums = mine.join(copies, ["gram", "salt"]).groupBy("_row").agg(F.sum("n").alias("units"), *[F.sum(F.col("n") * F.col(m)).alias(m) for m in names])
    found = rows.drop("_text").join(sums, "_row", "left")
    return found.select(*rows.columns[:-2], F.coalesce("units", F.lit(0)).alias("units"), *[F.round(F.coalesce(m, F.lit(0.0)), 6).alias(m) for m in names])
