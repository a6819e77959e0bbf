"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents may belong to several sources.  They are aggregated by membership
pattern; a flow routes each pattern's tokens to the quotas of its sources, the
n-th repetition of a token costing more than the one before (convex), so no
token repeats while a fresh one could serve.  Documents are then selected in a
seeded order up to each pattern's flow.  The driver sees one number per
pattern and one boundary per pattern and repetition, never documents.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.llm.common import cut

#: Bins of the seeded order, per pattern; only boundary bins are ever sorted.
BINS = 4096
#: Patterns that may be broadcast back to the documents; more are joined by shuffle.
BROADCAST_PATTERNS = 100_000


def shared_targets(sizes: dict[str | None, int], weights: tuple[float, ...], share: float, repeats: int) -> dict[str | None, float]:
    """``share`` times all sizes dealt to the sources by weight.

    Weights repeat over the sources by code point, null last.  Targets stop at
    ``repeats`` times a source's size; what is over goes to the rest by weight,
    until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = {}, share * sum(sizes.values()), order
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > repeats * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: float(repeats * sizes[s]) for s in over}
        left -= sum(repeats * sizes[s] for s in over)
        free = [s for s in free if s not in target]
    return target


def min_cost_flow(sizes: dict[int, float], members: dict[int, list[int]], quotas: list[float], repeats: int) -> dict[int, float]:
    """Tokens routed out of each pattern, by successive cheapest augmenting paths.

    The n-th unit of a pattern's size costs n - 1.  Reduced to patterns and
    sources: a pattern's cost is that of its current repetition, and a path may
    pass through quotas that other patterns fill to free cheaper capacity."""
    eps = 1e-6
    used = dict.fromkeys(sizes, 0.0)
    sent: dict[tuple[int, int], float] = {}
    left = list(quotas)
    of_source: dict[int, list[int]] = {}
    for p, own in members.items():
        for s in own:
            of_source.setdefault(s, []).append(p)
    for lap in range(repeats):
        room = {p: size * (lap + 1) - used[p] for p, size in sizes.items() if size > 0}
        while True:  # all paths that open this repetition: breadth first from patterns with room
            back: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None for p, r in room.items() if r > eps}
            queue, end = deque(back), None
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == "p":
                    for s in members[x]:
                        if ("s", s) not in back:
                            back["s", s] = (kind, x)
                            if left[s] > eps:
                                end = ("s", s)
                                break
                            queue.append(("s", s))
                else:
                    for p in of_source[x]:
                        if sent.get((p, x), 0) > eps and ("p", p) not in back:
                            back["p", p] = (kind, x)
                            queue.append(("p", p))
            if end is None:
                break
            path = [end]
            while (prior := back[path[-1]]) is not None:
                path.append(prior)
            path.reverse()
            flow = min([room[path[0][1]], left[end[1]], *(sent[b[1], a[1]] for a, b in zip(path, path[1:], strict=False) if a[0] == "s")])
            for a, b in zip(path, path[1:], strict=False):
                if a[0] == "p":
                    sent[a[1], b[1]] = sent.get((a[1], b[1]), 0.0) + flow
                else:
                    sent[b[1], a[1]] -= flow
            room[path[0][1]] -= flow
            used[path[0][1]] += flow
            left[end[1]] -= flow
    return used


def mix(docs: DataFrame, size: str, members: Column, order: Column, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2, whole: bool = True) -> tuple[DataFrame, dict, dict]:
    """``docs`` with ``taken`` (long): the words the mix takes of each row, repeats counted;
    the sizes and targets of the sources.

    ``members`` is an array of source names (null is a source of its own; an empty
    array takes no part), ``order`` a seeded long.  Rows are taken in the seeded order
    up to the flow's end, and so for each repetition.  The row on which the flow ends
    is taken whole or not at all, as its middle lies (then a source misses its
    target by at most half a row per pattern), or, unless ``whole``, up to there.
    Rows without words take 0.  Equal orders are settled by size; rows equal in both are
    interchangeable.  No rows give no rows and no targets."""
    name = F.transform(members, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("-")))
    marked = docs.withColumns({"_p": F.array_sort(F.array_distinct(name)), "_o": order})
    marked = cut(marked.withColumn("_b", F.pmod(F.shiftright("_o", 16), F.lit(BINS))))
    bins = marked.groupBy("_p", "_b").agg(F.sum(size).alias("n"))
    bins = cut(bins.withColumn("hi", F.sum("n").over(W.partitionBy("_p").orderBy("_b"))))

    totals = [(tuple(r["_p"]), r["n"]) for r in bins.groupBy("_p").agg(F.sum("n").alias("n")).orderBy("_p").collect()]
    decode = lambda p: [None if s == "-" else s[1:] for s in p]
    sizes: dict[str | None, int] = {}
    for p, n in totals:
        for s in decode(p):
            sizes[s] = sizes.get(s, 0) + n
    targets = shared_targets(sizes, weights, share, repeats)
    index = {s: i for i, s in enumerate(targets)}
    flow = min_cost_flow(
        {i: n for i, (_, n) in enumerate(totals)},
        {i: [index[s] for s in decode(p)] for i, (p, _) in enumerate(totals)},
        list(targets.values()),
        repeats,
    )
    spark = docs.sparkSession
    ends = spark.createDataFrame(
        [(list(p), lap, min(max(flow[i] - lap * n, 0.0), float(n))) for i, (p, n) in enumerate(totals) for lap in range(repeats)],
        "_p array<string>, lap int, upto double",
    )
    # the bin in which each repetition ends: the first whose sum passes the end
    near = bins.join(F.broadcast(ends) if len(totals) <= BROADCAST_PATTERNS else ends, "_p").where("hi >= upto")
    near = near.groupBy("_p", "lap").agg(F.min(F.struct("_b", F.col("hi") - F.col("n"), "upto")).alias("x"))
    near = near.select("_p", F.struct("lap", F.col("x._b").alias("bin"), F.col("x.upto").alias("upto"), F.col("x.col2").alias("below")).alias("e"))
    near = near.groupBy("_p").agg(F.array_sort(F.collect_list("e")).alias("_ends"))
    placed = marked.join(F.broadcast(near) if len(totals) <= BROADCAST_PATTERNS else near, "_p", "left")
    on_edge = F.coalesce(F.exists("_ends", lambda e: e["bin"] == F.col("_b")), F.lit(False))
    placed = placed.withColumn("_edge", on_edge)
    inner = placed.where(~F.col("_edge")).withColumn("_from", F.lit(None).cast("long"))
    within = W.partitionBy("_p", "_b").orderBy("_o", size).rowsBetween(W.unboundedPreceding, 0)
    outer = placed.where("_edge").withColumn("_from", F.sum(size).over(within) - F.col(size))

    def words(e: Column) -> Column:
        """What a repetition that ends at ``e`` takes of the row."""
        left = e["upto"] - e["below"] - F.col("_from")
        part = F.when(left > F.col(size) / 2, F.col(size)).otherwise(0) if whole else F.greatest(F.lit(0), F.least(F.col(size), F.floor(left)))
        return F.when(F.col("_b") < e["bin"], F.col(size)).when(F.col("_b") == e["bin"], part).otherwise(0).cast("long")

    none = F.expr("cast(array() as array<struct<lap:int,bin:long,upto:double,below:long>>)")
    taken = F.aggregate(F.coalesce("_ends", none), F.lit(0).cast("long"), lambda n, e: n + words(e))
    out = inner.unionByName(outer).withColumn("taken", taken)
    return out.drop("_p", "_o", "_b", "_edge", "_from", "_ends"), sizes, targets


def repeated(docs: DataFrame, size: str, members: Column, order: Column, **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, rows without
    words never; the columns of ``docs`` without ``size``."""
    taken, _, _ = mix(docs, size, members, order, **how)
    times = taken.where(F.col("taken") > 0).withColumn("_n", (F.col("taken") / F.col(size)).cast("int"))
    return times.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select([c for c in docs.columns if c != size])
