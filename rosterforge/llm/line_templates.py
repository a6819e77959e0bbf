"""Line dedup by a log-template tree, in DataFrame functions only.

Lines descend a tree of fixed depth: by their number of tokens, then by their
leading tokens (tokens with a digit count as one variable field).  Within a
leaf a token is constant if it stands at its position in lines of enough
distinct texts, else variable; a line's template is its constants with the
variable fields left open.  Templates that recur in enough distinct texts are
dropped but for their first occurrence.  How many are enough falls with what a
template fixes (``LEVELS``).
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut, row_key, stored


class Level(NamedTuple):
    """``texts`` distinct texts make a template of lines with ``least`` to ``most`` tokens
    recur, if it has at least ``fixed`` constant tokens.  Exact copies are one text."""

    texts: int
    least: int
    most: int
    fixed: int


MOST = 1 << 30
#: A line of one or two words recurs by chance; one that fixes 40 words is a copy wherever it recurs.
LEVELS = (Level(50, 1, 2, 0), Level(10, 3, MOST, 0), Level(2, 40, MOST, 40))
#: Leading tokens that the tree looks at.
DEPTH = 3
#: Share of a template's tokens that must be constant.
CONSTANT = 0.6
FIELD = "<*>"
#: Leaves and templates up to which they are broadcast (some dozens of bytes each).
BROADCAST_LEAVES = 1_000_000


def _masked(line: Column) -> Column:
    """A line with every token that holds a digit as one variable field."""
    word = "[^0-9\\x20]*+"
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, f"{word}(?:[0-9]{word})++", FIELD)).otherwise(line)


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line that is not blank: ``_key, _row, _same`` (of the text), ``pos``,
    ``line`` (single spaces), ``n`` (tokens), ``leaf``.

    Only a line's head is looked at here; its tokens are split where its leaf recurs."""
    spaces = "[\\x20\\x09\\x0B-\\x0D]+"
    even = F.when(F.col(text).rlike("[\\x09\\x0B-\\x0D]|  "), F.regexp_replace(text, spaces, " ")).otherwise(F.col(text))
    rows = docs.select(F.col(key).alias("_key"), row_key(key, text).alias("_row"), F.xxhash64(text).alias("_same"), F.posexplode(F.split(even, "\n")).alias("pos", "line"))
    rows = rows.withColumn("line", F.trim("line")).where("line <> ''")
    rows = rows.withColumn("n", F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    return rows.withColumn("leaf", F.xxhash64("n", _masked(F.substring_index("line", " ", DEPTH))))


def _of(level: Level, by: str) -> Column:
    return (F.col("n") >= level.least) & (F.col("n") <= level.most) & (F.col(by) >= level.texts)


def _at(levels: tuple[Level, ...], field: str) -> Column:
    """A field of the row's level."""
    return F.get(F.array(*[F.lit(getattr(x, field)) for x in levels]), F.col("level"))


def _templates(kinds: DataFrame, levels: tuple[Level, ...]) -> DataFrame:
    """``kind, level, template`` of the kinds of lines whose template recurs on a level.

    All levels go through the same joins.  A slot is a token at its place in a leaf, a
    template the slots that are constant; both are 64-bit hashes, so what is shuffled does
    not grow with the tokens' length."""
    of = F.array_compact(F.array(*[F.when(_of(x, "leaf_texts"), F.lit(i)) for i, x in enumerate(levels)]))
    mine = kinds.withColumn("level", F.explode(of))
    words = mine.select("level", "leaf", "kind", "texts", F.posexplode(F.split("line", " ")).alias("at", "word")).where(F.col("word") != FIELD)
    words = words.select("level", "kind", "texts", F.xxhash64("leaf", "at", "word").alias("slot"))
    held = words.groupBy("level", "slot").agg(F.sum("texts").alias("by")).where(F.col("by") >= _at(levels, "texts")).select("level", "slot")
    fixed = words.join(held, ["level", "slot"]).groupBy("level", "kind").agg(F.count("*").alias("fixed"), F.bit_xor(F.xxhash64("slot")).alias("slots"))
    enough = (F.col("fixed") >= _at(levels, "fixed")) & (F.col("fixed") / F.col("n") >= CONSTANT)
    slots = mine.select("level", "leaf", "n", "kind", "texts").join(fixed, ["level", "kind"]).where(enough)
    slots = slots.select("level", "kind", "texts", F.xxhash64("leaf", "fixed", "slots").alias("template"))
    often = slots.groupBy("level", "template").agg(F.sum("texts").alias("all")).where(F.col("all") >= _at(levels, "texts")).select("level", "template")
    return cut(slots.join(often, ["level", "template"]).select("kind", "level", "template"))


def recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", levels: tuple[Level, ...] = LEVELS) -> DataFrame:
    """The lines to drop: ``_row`` (the row's key) and ``pos``, perhaps more than once.

    Two passes read the texts.  Only lines in leaves of enough distinct texts are kept;
    equal lines are one kind with a count from then on."""
    lines = _lines(docs, key, text)
    leaves = lines.select("leaf", "n", "_same").distinct().groupBy("leaf", "n").agg(F.count("*").alias("leaf_texts"))
    leaves = cut(leaves.where(reduce(Column.__or__, [_of(x, "leaf_texts") for x in levels])).select("leaf", "leaf_texts"))
    few = leaves.count() <= BROADCAST_LEAVES
    found = lines.join(F.broadcast(leaves) if few else leaves, "leaf").withColumn("line", _masked(F.col("line")))
    found = stored(found.withColumn("kind", F.xxhash64("leaf", "line")))
    texts = found.select("kind", "_same").distinct().groupBy("kind").agg(F.count("*").alias("texts"))
    kinds = found.groupBy("kind").agg(*[F.first(c).alias(c) for c in ("leaf", "n", "leaf_texts", "line")])
    kinds = stored(kinds.join(texts, "kind"))

    often = _templates(kinds, levels)
    few = often.count() <= BROADCAST_LEAVES
    there = found.select("kind", "_key", "_row", "pos").join(F.broadcast(often) if few else often, "kind")
    place = F.struct(F.col("_key").isNull().alias("null"), F.col("_key"), F.col("_row"), F.col("pos"))
    first = there.groupBy("level", "template").agg(F.min(place).alias("first"))
    # one row per template: small beside the lines, so a very common template's need not meet in one task
    first = F.broadcast(first) if few else first
    late = there.join(first, ["level", "template"]).where((F.col("_row") != F.col("first._row")) | (F.col("pos") != F.col("first.pos")))
    return late.select("_row", "pos")


def _without(lines: Column, gone: Column) -> Column:
    """An array without the items at the sorted positions ``gone``: the stretches between them."""
    ends = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice(lines, F.get(ends, i) + 2, F.get(ends, i + 1) - F.get(ends, i) - 1)))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", levels: tuple[Level, ...] = LEVELS) -> DataFrame:
    """``docs`` with ``text`` without its recurring lines, ``n_lines`` and ``n_dropped`` (long).

    Every row stays, if with an empty text; null texts stay null with no lines.
    Blank lines stay.  Of a template, the occurrence in the smallest key (nulls last,
    then the row's hash, then the line) stays; fully equal rows are treated alike.  An
    empty table gives no rows.  A line goes if one of the levels drops it.  A level with
    fewer texts has finer templates, each within one of the coarser level's, so the first
    of a coarse one is never lost."""
    gone = recurring(docs, key, text, levels).groupBy("_row").agg(F.sort_array(F.collect_set("pos")).alias("_gone"))
    out = docs.withColumn("_row", row_key(key, text)).join(gone, "_row", "left")
    lines = F.split(text, "\n")
    return out.withColumns(
        {
            text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(_without(lines, F.col("_gone")), "\n")),
            "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
        }
    ).drop("_row", "_gone")
