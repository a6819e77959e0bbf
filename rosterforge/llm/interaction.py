"""Filter interaction audit: what every filter removes in every order, and its Shapley share.

Each document fails a set of filters, a mask.  The filters already applied are a
state of the subset lattice; an edge adds one filter to a state.  Documents are
counted by part and mask first, so that whatever follows handles at most 2^k
counts per part.  Path counting runs forward (orders that reach a state) and
backward (orders that leave it to the end); their product weighs an edge's
removals for the Shapley value.  An order is a path, and its steps read the
same edges, so no order is ever run over documents.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.llm.common import SPACE

#: Filters above which all orders are too many to list (8! paths of 8 steps are broadcast).
MOST_FILTERS = 8


def path_weights(k: int) -> dict[tuple[int, int], int]:
    """(state, filter) -> the orders of ``k`` filters that apply the filter right
    after exactly the filters of the state (a bit mask)."""
    full = (1 << k) - 1
    edges = [(s, i) for s in range(full + 1) for i in range(k) if not s >> i & 1]
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for s, i in edges:  # a state's number is above those of its subsets
        reach[s | 1 << i] += reach[s]
    for s, i in reversed(edges):
        leave[s] += leave[s | 1 << i]
    return {(s, i): reach[s] * leave[s | 1 << i] for s, i in edges}


def text_conditions(text: Column) -> list[Column]:
    """Failure conditions of a text (null: empty), words being runs of all but ASCII
    space: under 50 words; under 65% distinct words; over 5% A-Z among the code
    points; any of ``#$%&*|``."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, f"{SPACE}+"), "")
    return [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * F.length(F.regexp_replace(t, "[^A-Z]+", "")) > 5 * F.length(t),
        t.rlike("[#$%&*|]"),
    ]


def profile(docs: DataFrame, conditions: list[Column], marks: DataFrame, part: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``part, mask, n`` and one count per column of ``marks``: documents by failed filters.

    Bit i of ``mask`` is condition i; the last bit is set if another row has an equal
    text and a smaller key, anywhere in the table.  ``marks(key, ...)`` has booleans
    by document; repeated keys are joined by "or", rows without a mark count as
    false.  Null texts are empty texts, null parts the empty part; a null
    condition has not failed; null keys fail for no copy and are no one's copy.
    Repeated rows count each.  An empty table gives no rows; more columns of ``docs``
    are not looked at.

    The rows that travel are hashes of 32 bytes with counts.  Copies are merged before
    they are shuffled, by part and marks, so a text that a third of the table
    repeats is a few rows."""
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))
    names = [c for c in marks.columns if c != key]
    same = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(part), F.lit("")).alias("part"), mask.alias("mask"), same.alias("_same"))
    rows = rows.groupBy("_key", "part", "mask", "_same").agg(F.count("*").alias("n"))
    marked = marks.groupBy(F.col(key).alias("_key")).agg(*[F.max(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in names])
    rows = rows.join(marked, "_key", "left").withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in names})
    known = F.col("_key").isNotNull()
    texts = rows.groupBy("_same", "part", "mask", *names).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("_known"),
        F.min(F.when(known, F.struct(F.col("_key").alias("low"), "n"))).alias("_first"),
    )
    low = F.min("_first.low").over(W.partitionBy("_same"))  # a row for each part and marks that hold the text
    copies = F.col("_known") - F.when(F.col("_first.low") == low, F.col("_first.n")).otherwise(0)
    texts = texts.withColumn("_copies", F.coalesce(copies, F.lit(0)))
    both = F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("_copies")).alias("n")),
        F.struct((F.col("mask") + F.lit(1 << len(conditions))).alias("mask"), F.col("_copies").alias("n")),
    )
    dealt = texts.select("part", *names, F.explode(both).alias("x")).select("part", *names, "x.mask", "x.n").where("n > 0")
    return dealt.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in names])


def audit(counts: DataFrame, filters: str, marks: list[str]) -> DataFrame:
    """A row for each part of ``counts(part, mask, n, ...)``, order of the filters and step:
    ``part, filter_order, step, kept, removed, redundant, unique_fails``, a
    ``<mark>_lost`` for each mark, and ``shapley``.

    ``filters`` names them by letters, bit by bit of ``mask``.  ``redundant`` fails the
    step's filter but went earlier; ``unique_fails`` fails it alone; ``shapley`` is
    what it removes, summed over all orders.  Zeros are rows; no parts give none."""
    k = len(filters)
    if not 0 < k <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    spark, full = counts.sparkSession, (1 << k) - 1
    what = ["n", *marks]
    # how many documents are left in every state
    alive = counts.groupBy("part").agg(
        *[F.array(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) == 0, F.col(c))), F.lit(0)) for s in range(full + 1)]).alias(c) for c in what]
    )
    weights = [F.struct(F.lit(s).alias("state"), F.lit(i).alias("filter"), F.lit(1 << i).alias("bit"), F.lit(w).cast("long").alias("weight")) for (s, i), w in path_weights(k).items()]
    bit = F.col("bit")

    def at(c: str, state: Column) -> Column:
        return F.element_at(c, state + 1)

    edges = alive.withColumn("e", F.explode(F.array(*weights))).select("part", *what, "e.*")
    then = F.col("state").bitwiseOR(bit)
    edges = edges.select(
        "part",
        "state",
        "filter",
        at("n", then).alias("kept"),
        *[(at(c, F.col("state")) - at(c, then)).alias("removed" if c == "n" else f"{c}_lost") for c in what],
        (at("n", F.lit(0)) - at("n", bit)).alias("fails"),
        (at("n", F.lit(full).bitwiseXOR(bit)) - at("n", F.lit(full))).alias("unique_fails"),
        "weight",
    )
    edges = edges.withColumn("shapley", F.sum(F.col("weight") * F.col("removed")).over(W.partitionBy("part", "filter")))  # 2^(k-1) edges each
    paths = [
        ("".join(filters[i] for i in p), step + 1, sum(1 << i for i in p[:step]), i) for p in permutations(range(k)) for step, i in enumerate(p)
    ]
    steps = spark.createDataFrame(paths, "filter_order string, step int, state int, filter int")
    redundant = (F.col("fails") - F.col("removed")).alias("redundant")
    return edges.join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", redundant, "unique_fails", *[f"{c}_lost" for c in marks], "shapley"
    )
