"""Exact top-k inner products by no-random-access aggregation, in blocks.

Each component is a list of the candidates' values with a top and a bottom end.
Per block of queries and candidates the lists are read one after the other, those
first that can move a query's scores most; no list is looked into out of turn.  What has been
read of a candidate counts exactly, what has not lies between the ends of the
unread lists.  So each candidate has a lower and an upper bound, and a query's
reading stops when few candidates' upper bounds reach its k-th lower bound:
outsiders then cannot qualify, and the final scores of the few are resolved.

The first candidates give each query a lower bound.  Then a part of all candidates passes
through one task, block by block, and the k best that a query has there raise the bound for
the next block.  Equal vectors are read once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.llm.common import cut

#: A part has so many candidates at least, unless there are fewer.
CANDIDATES = 4096
#: Queries, and numbers in their vectors, that a task has in memory.
QUERIES = 1 << 17
NUMBERS = 1 << 23
#: Pairs of query and candidate in a task, about.
PAIRS = 1 << 36
#: Candidates that give each query its first bound, and candidates of a block then, about.
FIRST = 2048
BLOCK = 2000
#: Queries whose bounds are computed together.
TOGETHER = 256
#: The same where a bound is known before.
ABREAST = 512
#: The bounds are looked at when the unread lists can move a score by so much of what all can.
UNREAD = (1 / 4, 1 / 16, 1 / 64)
#: A query stops reading when so many candidates at most are left.
LEFT = 64
#: Queries abreast do if so many are left to each on average, in no more of their stretches than the share of the lists that is unread.
FEW = 8
#: Candidates of a stretch, which is passed over by its highest sum.
STRETCH = 250
LONG = (1 << 63) - 1


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, held within the range of a long.

    Through doubles where these hold every sum exactly, which whole vectors
    times rows need; through unbounded integers where even 64 bits would not do."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[-1])
    if most < 2.0**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if most < 2.0**62:
        return q @ x.T
    return np.clip(q.astype(object) @ x.T.astype(object), -LONG - 1, LONG).astype(np.int64)


def block_top(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, k: int, told: list[float] | None = None) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, score) of each query's k best in the block, its own id
    excepted, ties to the smaller id.  ``told`` gets the share of the lists that each query read."""
    n, dims = x.shape
    top, bottom = x.max(0).astype(np.float64), x.min(0).astype(np.float64)
    lists = np.ascontiguousarray(x.T, np.float64)
    # doubles may round sums this large: bounds then give way to the exact scores
    safe = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, dims) < 2.0**53
    for at in range(0, len(q), TOGETHER):
        part, names = q[at : at + TOGETHER], own[at : at + TOGETHER]
        w = part.astype(np.float64)
        reach = np.abs(w) * (top - bottom)  # what each list can move the score by
        order = np.argsort(-reach, axis=1, kind="stable")
        sums = np.zeros((len(part), n))
        unread = np.ones(w.shape, bool)
        rest = np.arange(len(part))
        chosen: dict[int, np.ndarray] = {}
        for share in UNREAD if safe and n > LEFT else ():
            left = reach.sum(1, keepdims=True) - np.cumsum(np.take_along_axis(reach, order, 1), 1)
            depth = (left > share * reach.sum(1, keepdims=True)).sum(1) + 1
            wanted = np.zeros(w.shape, bool)
            np.put_along_axis(wanted, order, np.arange(dims) < depth[:, None], 1)
            now = wanted & unread
            sums[rest] += np.where(now, w, 0.0)[rest] @ lists
            unread &= ~now
            # lower bounds are the sums and the low ends of the unread lists, upper ones the high ends
            slack = np.where(unread, reach, 0.0).sum(1)[rest]
            here = sums[rest]
            here[names[rest][:, None] == ids[None, :]] = -np.inf
            bar = np.partition(here, n - min(k, n), axis=1)[:, n - min(k, n)]
            live = (here >= (bar - slack)[:, None]) & (here > -np.inf)
            done = live.sum(1) <= LEFT
            for i, mask in zip(rest[done], live[done], strict=True):
                chosen[int(i)] = np.flatnonzero(mask)
            if told is not None:
                told += (~unread[rest[done]]).mean(1).tolist()
            rest = rest[~done]
            if not len(rest):
                break
        if len(rest):  # lists read to their ends: every score is known
            scores = _exact(part[rest], x)
            for i, row in zip(rest, scores, strict=True):
                bar = np.partition(row, max(0, n - k - 1))[max(0, n - k - 1)]
                chosen[int(i)] = np.flatnonzero(row >= bar)
            if told is not None:
                told += [1.0] * len(rest)
        for i, who in chosen.items():
            who = who[ids[who] != names[i]]
            final = _exact(part[i : i + 1], x[who])[0]
            for j in np.lexsort((ids[who], -final))[:k] if len(who) else ():
                yield int(names[i]), int(ids[who][j]), int(final[j])


def first_bounds(q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Score and id of each query's k-th best of these candidates, its own id not excepted."""
    scores, last = np.full(len(q), -LONG - 1), np.full(len(q), LONG)
    if len(q) and len(ids) >= k:
        order = np.argsort(ids, kind="stable")
        # queries go by their place below zero, so that no candidate is their own
        found = block_top(np.arange(len(ids)), x[order].astype(np.int64), -1 - np.arange(len(q)), q.astype(np.int64), k)
        who, which, score = np.fromiter((v for row in found for v in row), np.int64).reshape(len(q), k, 3)[:, -1].T
        scores[-1 - who], last[-1 - who] = score, ids[order][which]
    return scores, last


class Best:
    """The ``k`` best candidates that each query has met, ties to the smaller id, of those
    that come up to its first bound, a score and an id.

    ``told`` gets the share of the lists that were read, for each block and each ``ABREAST`` queries."""

    def __init__(self, q: np.ndarray, k: int, bounds: tuple[np.ndarray, np.ndarray], told: list[float] | None = None) -> None:
        self.q, self.bounds, self.told, self.met = q, bounds, told, 0
        self.most = float(np.abs(q.astype(np.float64)).max(initial=0))
        self.ids = np.full((len(q), k), LONG)
        self.scores = np.full((len(q), k), -LONG - 1)
        self.held = np.zeros(len(q), int)
        self.level = 0  # of UNREAD
        self.room = np.empty(0, np.float32)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Candidates that were not met before."""
        most = self.most * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(1, x.shape[1])
        # singles and doubles hold whole numbers below these exactly, and so all sums
        kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else None
        lists = None if kind is None else np.ascontiguousarray(x.T, kind)
        top, bottom = x.max(0).astype(np.float64), x.min(0).astype(np.float64)
        if (self.met + len(ids)).bit_length() > self.met.bit_length():  # bounds have risen: fewer lists may do
            self.level = max(self.level - 1, 0)
        for at in range(0, len(self.q), ABREAST):
            rows = slice(at, at + ABREAST)
            bar, last = (np.where(self.held[rows] < self.ids.shape[1], first[rows], own[rows, -1]) for first, own in zip(self.bounds, (self.scores, self.ids), strict=True))
            need = bar + ((ids.min() > last) & (bar < LONG))  # a later id must have a higher score
            if kind is None:
                scores = _exact(self.q[rows].astype(np.int64), x.astype(np.int64))
                i, j = np.nonzero(scores >= need[:, None])
                found = scores[i, j]
            else:
                i, j, found = self._read(self.q[rows], x, lists, top, bottom, need)
            if len(i):
                self._merge(at + i, ids[j], found)
        self.met += len(ids)

    def _read(self, q: np.ndarray, x: np.ndarray, lists: np.ndarray, top: np.ndarray, bottom: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, candidates and scores that reach ``need``."""
        w, dims = q.astype(lists.dtype), len(lists)
        if self.room.size < len(q) * len(x) or self.room.dtype != lists.dtype:
            self.room = np.empty(len(q) * len(x), lists.dtype)
        sums = self.room[: len(q) * len(x)].reshape(len(q), len(x))
        stretches = sums.reshape(len(q), -1, len(x) if len(x) % STRETCH else STRETCH)
        order, read = np.arange(dims), 0
        if self.level < len(UNREAD):
            reach = np.abs(w).mean(0, dtype=np.float64) * (top - bottom)
            order = np.argsort(-reach, kind="stable")
            left = reach.sum() - np.cumsum(reach[order])
        while True:
            depth = min(dims, int((left > UNREAD[self.level] * reach.sum()).sum()) + 1) if self.level < len(UNREAD) else dims
            if read:
                sums += w[:, order[read:depth]] @ lists[order[read:depth]]
            elif depth < dims:
                np.matmul(w[:, order[:depth]], lists[order[:depth]], out=sums)
            else:
                np.matmul(w, lists, out=sums)
            read, rest = depth, order[depth:]
            # the sums and the high ends of the unread lists are upper bounds
            reached = (need - np.maximum(w[:, rest] * top[rest], w[:, rest] * bottom[rest]).sum(1)).astype(sums.dtype)
            highest = stretches.max(2)
            i, part = np.nonzero(highest >= reached[:, None])
            live = stretches[i, part] >= reached[i, None]
            if read == dims or len(i) <= highest.size * (1 - read / dims) and np.count_nonzero(live) <= FEW * len(q):
                break
            self.level += 1
        if self.told is not None:
            self.told.append(read / dims)
        which, j = np.divmod(np.flatnonzero(live), stretches.shape[2])
        i, j = i[which], part[which] * stretches.shape[2] + j
        if read == dims:
            return i, j, sums[i, j].astype(np.int64)
        found = (q[i].astype(np.float64) * x[j]).sum(1).astype(np.int64)
        kept = found >= need[i]
        return i[kept], j[kept], found[kept]

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        k = self.ids.shape[1]
        old, more = np.unique(rows, return_counts=True)
        rows = np.concatenate([np.repeat(old, k), rows])
        ids = np.concatenate([self.ids[old].ravel(), ids])
        scores = np.concatenate([self.scores[old].ravel(), scores])
        order = np.lexsort((ids, ~scores, rows))
        first = np.searchsorted(rows[order], old)
        taken = order[first[:, None] + np.arange(k)]
        self.ids[old], self.scores[old] = ids[taken], scores[taken]
        self.held[old] = np.minimum(k, self.held[old] + more)


def _packed(batches: Iterator[pa.RecordBatch], scale: float, width: int) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, ``width`` a scaled component, that sort as the vectors do."""
    for batch in batches:
        v = batch.column("v")
        values = v.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(v.offsets.to_numpy())
        whole = np.floor(np.clip(values * scale, -(2.0**62), 2.0**62)).astype(np.int64)
        coded = (whole.view(np.uint64) + np.uint64(1 << (8 * width - 1))).astype(f">u{width}")
        ends = np.concatenate([[0], np.cumsum(sizes) * width]).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(ends), pa.py_buffer(coded.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("q"), column], ["id", "q", "v"])


def _unpacked(column: pa.Array, dims: int, width: int) -> np.ndarray:
    """Rows of scaled components, short ones padded with zeros."""
    column = pa.concat_arrays([c.cast(pa.large_binary()) for c in (column.chunks if isinstance(column, pa.ChunkedArray) else [column])] or [pa.array([], pa.large_binary())])
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    coded = np.frombuffer(data, f">u{width}", (ends[-1] - ends[0]) // width, ends[0]) if ends[-1] > ends[0] else np.empty(0, np.uint64)
    whole = (coded.astype(np.uint64) - np.uint64(1 << (8 * width - 1))).view(np.int64).astype(f"i{width}")
    sizes = np.diff(ends) // width
    if (sizes == dims).all():
        return whole.reshape(-1, dims)
    x = np.zeros((len(column), dims), f"i{width}")
    x[np.arange(dims) < sizes[:, None]] = whole
    return x


def top_k(vectors: DataFrame, is_query: str, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, <key>, score``: for each row where the SQL condition
    ``is_query`` holds, the ``k`` rows of other ids with the highest integer inner
    product of floor(``scale`` * component), ties to the smaller id.

    Vectors that are null or hold a null or non-finite component, and null ids,
    take no part.  Shorter vectors count as padded with zeros; an empty vector
    scores 0.  Of rows with one id, the smallest vector stands for it.  Scaled
    components are held to the range of a long, and so are scores.  Fewer than
    ``k`` others give as many rows as there are; no rows give none."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).withColumn("q", F.coalesce(F.expr(is_query), F.lit(False)))
    rows = rows.select(F.col(key).cast("long").alias("id"), "q", F.col(vector).cast("array<double>").alias("v"))
    most = F.coalesce(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))), F.lit(0.0))
    # array_contains is null where a null may be what is looked for
    rows = rows.where(~F.array_contains("v", F.lit(float("nan"))) & (most < float("inf")))
    n, asked, dims, most = rows.agg(F.count("*"), F.count_if("q"), F.max(F.size("v")), F.max(most)).first()
    if not asked:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    dims, width = max(1, dims), next((w for w in (2, 4) if most * abs(scale) + 1 < 1 << (8 * w - 1)), 8)
    coded = rows.mapInArrow(lambda batches: _packed(batches, float(scale), width), "id long, q boolean, v binary")
    rows = cut(coded.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")))

    # equal vectors are one query, and one candidate with its first ids
    together = max(1, min(QUERIES, NUMBERS // dims))
    groups = -(-asked // together)
    tasks = 3 * spark.sparkContext.defaultParallelism
    parts = max(1, min(-(-n // CANDIDATES), -(-tasks // groups)), -(-n * min(asked, together) // PAIRS))
    nth = F.row_number().over(W.partitionBy("v").orderBy("id"))
    firsts = rows.select("id", "v", nth.alias("nth")).where(F.col("nth") <= k + 1)
    lists = firsts.groupBy("v").agg(F.min("id").alias("id"), F.collect_list("id").alias("ids"))
    lists = cut(lists.repartition(parts, "id").sortWithinPartitions("id"))
    head = lists.select("id", "v").orderBy("id").limit(FIRST).toArrow()
    head = head["id"].to_numpy(), _unpacked(head["v"], dims, width)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = first_bounds(_unpacked(batch["v"], dims, width), *head, k + 1)
            yield pa.RecordBatch.from_arrays([batch["query"], batch["v"], *map(pa.array, bounds)], ["query", "v", "bar", "last"])

    asks = rows.where("q").groupBy("v").agg(F.min("id").alias("query")).select("query", "v")
    asks = asks.repartition(max(1, min(tasks, asked // TOGETHER)), "query")
    asks = cut(asks.mapInArrow(bound, "query long, v binary, bar long, last long"))

    def searched(group: int) -> DataFrame:
        mine = asks.where(F.pmod(F.xxhash64("v"), F.lit(groups)) == group).toArrow()
        names, bar, last = (mine[c].to_numpy() for c in ("query", "bar", "last"))
        told = spark.sparkContext.broadcast((names, _unpacked(mine["v"], dims, width), bar, last))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, q, *bounds = told.value
            best, held, size = Best(q, k + 1, bounds), [], 0
            for batch in batches:
                held, size = [*held, batch], size + batch.num_rows
                if size >= BLOCK:
                    best.meet(*candidates(held))
                    held, size = [], 0
            if size:
                best.meet(*candidates(held))
            for at in range(0, len(names), BLOCK):
                some = np.arange(k + 1) < best.held[at : at + BLOCK, None]
                columns = np.repeat(names[at : at + BLOCK], some.sum(1)), best.ids[at : at + BLOCK][some], best.scores[at : at + BLOCK][some]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "id", "score"])

        return lists.select("id", "v").mapInArrow(search, "query long, id long, score long")

    def candidates(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        block = pa.Table.from_batches(held)
        return block["id"].to_numpy(), _unpacked(block["v"], dims, width)

    def ranked(df: DataFrame, query: str, k: int) -> DataFrame:
        best = W.partitionBy(query).orderBy(F.desc("score"), "id")
        return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    found = ranked(reduce(DataFrame.union, map(searched, range(groups))), "query", k + 1).drop("rank")
    more = lists.where(F.size("ids") > 1).select(F.col("id").alias("first"), "ids")
    found = found.join(more, found["id"] == more["first"], "left").select("query", F.explode(F.coalesce("ids", F.array("id"))).alias("id"), "score")
    found = ranked(found, "query", k + 1).drop("rank")
    askers = rows.where("q").join(asks, "v").select("query", F.col("id").alias("query_id"))
    found = ranked(found.join(askers, "query").where(F.col("id") != F.col("query_id")), "query_id", k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
