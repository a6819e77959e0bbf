"""Best-fit packing of tokenized documents with swap-based local search.

Pieces of one length are interchangeable, so the packing is planned on the
histogram of lengths (at most ``capacity`` numbers, whatever the input): best
fit by decreasing length over groups of equally filled bins, then local search
between underfull groups.  The plan says which ranks of each length go to which
bins; the pieces find their place by their rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.llm.common import cut
from rosterforge.llm.encoding import WordEncoder

#: Pieces ranked together at most, on average.
RANKED = 5_000

@cache
def encoder(path: str) -> WordEncoder:
    """One encoder for each tokenizer in a worker."""
    return WordEncoder(path)


Bin = tuple[tuple[int, int], ...]  # (length, how many), longest first


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of each document's ids and one ``end_id``
    (null text: only that), cut only where longer than ``capacity``."""

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stop = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for k, ids in zip(batch["k"], encoder(tokenizer).encode(batch["t"]), strict=True):
                ids += stop
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((k, p, at // 4, len(own) // 4, zlib.crc32(own)))
            if rows:
                yield pd.DataFrame(rows, columns=["k", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"))
    cut_rows = rows.mapInPandas(cut_up, "k string, piece int, start long, length long, ids_crc32 long")
    return cut_rows.select(F.col("k").cast(kind).alias(key), "piece", "start", "length", "ids_crc32")


def best_fit(counts: dict[int, int], capacity: int) -> dict[Bin, int]:
    """Bins and how many of each: every length, longest first, into the fullest bins that take it."""
    room: dict[int, dict[Bin, int]] = {}  # by free space
    free: list[int] = []

    def put(space: int, items: Bin, n: int) -> None:
        if n:
            if space not in room:
                room[space] = {}
                insort(free, space)
            room[space][items] = room[space].get(items, 0) + n

    for length in sorted(counts, reverse=True):
        c = counts[length]
        while c:
            at = bisect_left(free, length)
            if at < len(free):
                space = free[at]
                items, n = room[space].popitem()
                if not room[space]:
                    del room[space], free[at]
            else:
                space, items, n = capacity, (), -(-c // (capacity // length))
            k = space // length
            full = min(n, c // k)
            put(space - k * length, (*items, (length, k)), full)
            c -= full * k
            n -= full
            if n and c:
                put(space - c * length, (*items, (length, c)), 1)
                c, n = 0, n - 1
            if items:
                put(space, items, n)
    return {items: n for group in room.values() for items, n in group.items()}


def _changed(items: Bin, out: tuple[int, ...], new: tuple[int, ...]) -> Bin:
    n = dict(items)
    for x in out:
        n[x] -= 1
    for x in new:
        n[x] = n.get(x, 0) + 1
    return tuple((x, k) for x, k in sorted(n.items(), reverse=True) if k)


def _offers(items: Bin) -> tuple[dict[int, tuple[int, ...]], dict[int, tuple[int, ...]]]:
    """What a bin can give away, by size: single items, and pairs."""
    own = [x for x, _ in items]
    pairs = {x + y: (x, y) for i, (x, k) in enumerate(items) for y in own[i if k > 1 else i + 1 :]}
    return {x: (x,) for x in own}, pairs


def local_search(bins: dict[Bin, int], capacity: int) -> dict[Bin, int]:
    """Empties the least filled bins: an item moves, one is exchanged for a smaller
    one, or two for one, always to a bin as full or fuller that has room, so that the
    sum of squared fills rises.  Of all such steps of a bin the one that moves most is
    taken, for all equal bins at once.  Ends at the least number of bins that the
    total allows, or where no bin has a step left.

    By the length of an item that may come back (0: none), bins are sorted by their
    free space, so a step is found by one look at each length.  A bin without a step is
    looked at again only when a new kind of bin accepts what it offers."""
    bins = dict(bins)
    fill = {b: sum(x * k for x, k in b) for b in bins}
    count = sum(bins.values())
    least = -(-sum(fill[b] * n for b, n in bins.items()) // capacity)
    by_space: dict[int, list[tuple[int, Bin]]] = {}
    stuck: dict[Bin, tuple[int, int]] = {}  # sizes on offer as bits: singles, pairs
    active = [(fill[b], b) for b in bins if fill[b] < capacity]
    heapify(active)

    def shown(b: Bin) -> list[int]:
        return [0, *[x for x, _ in b]]

    for space, b in sorted((capacity - f, b) for f, b in active):
        for y in shown(b):
            by_space.setdefault(y, []).append((space, b))

    def take(b: Bin, n: int) -> None:
        bins[b] -= n
        if not bins[b]:
            del bins[b]
            stuck.pop(b, None)
            for y in shown(b):
                kinds = by_space[y]
                del kinds[bisect_left(kinds, (capacity - fill[b], b))]

    def put(b: Bin, n: int) -> None:
        bins[b] = bins.get(b, 0) + n
        fill[b] = f = sum(x * k for x, k in b)
        if f == capacity:
            return
        if bins[b] == n:
            for y in shown(b):
                insort(by_space.setdefault(y, []), (capacity - f, b))
        stuck.pop(b, None)
        heappush(active, (f, b))
        # sizes it accepts: for an item of y, more than y and at most y and its space
        runs = [((1 << capacity - f) - 1) << y + 1 for y in shown(b)]
        back = 0
        for r in runs[1:]:
            back |= r
        for a in [a for a, (one, two) in stuck.items() if fill[a] <= f and (one & (back | runs[0]) or two & back)]:
            del stuck[a]
            heappush(active, (fill[a], a))

    while active and count > least:
        f, a = heappop(active)
        if a not in bins or a in stuck:
            continue
        ys, spaces, kinds = [], [], []
        for y in sorted(by_space):
            of = by_space[y]
            i = bisect_right(of, capacity - f, key=lambda x: x[0]) - 1
            if i >= 0 and of[i][1] == a and bins[a] == 1:
                i -= 1
            if i >= 0:
                ys.append(y)
                spaces.append(of[i][0])
                kinds.append(of[i][1])
        one, two = _offers(a)
        best, step = 0, None
        for offers, low in ((one, 0), (two, 1)):
            at = bisect_left(ys, low)
            if not offers or at == len(ys):
                continue
            sizes, y = np.asarray(list(offers)), np.asarray(ys[at:])
            fits = (y < sizes[:, None]) & (sizes[:, None] <= y + np.asarray(spaces[at:]))
            first = fits.argmax(1)  # the least item that may come back moves most
            moved = np.where(fits.any(1), sizes - y[first], 0)
            if moved.max() > best:
                i = int(moved.argmax())
                j = at + int(first[i])
                best, step = int(moved[i]), (kinds[j], offers[int(sizes[i])], (ys[j],) if ys[j] else ())
        if step is None:
            stuck[a] = sum(1 << x for x in one), sum(1 << x for x in two)
            continue
        b, out, back = step
        n = bins[a] // 2 if a == b else min(bins[a], bins[b])
        take(a, n)
        take(b, n)
        if a in bins:
            heappush(active, (f, a))
        left = _changed(a, out, back)
        count -= 0 if left else n
        for new in (left, _changed(b, back, out)):
            if new:
                put(new, n)
    return bins


def _places(bins: dict[Bin, int]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks: the first rank, bins, items a bin, first bin, first offset."""
    rank: dict[int, int] = {}
    runs, first = [], 0
    for items, n in sorted(bins.items()):
        offset = 0
        for length, k in items:
            at = rank.get(length, 0)
            runs.append((length, at, k, first, offset))
            rank[length] = at + n * k
            offset += length * k
        first += n
    runs.sort()
    table = np.asarray(runs, np.int64).reshape(-1, 5)
    return {"start": (table[:, 0] << 44) + table[:, 1], "rank": table[:, 1], "k": table[:, 2], "bin": table[:, 3], "offset": table[:, 4]}


def pack(found: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """``found`` (its pieces; lengths from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``: gapless from 0 in every sequence; columns of these names are replaced.

    Pieces equal in all of ``order`` are interchangeable.  Ranks are counted
    within hashed parts of each length, so no length is ever in one task."""
    kept = [c for c in found.columns if c not in ("sequence_id", "offset")]
    found = cut(found)
    counts = {r[length]: r["n"] for r in found.groupBy(length).agg(F.count("*").alias("n")).collect()}
    bins = local_search(best_fit(counts, capacity), capacity)
    places = _places(bins)
    parts = max(1, sum(counts.values()) // RANKED)
    dealt = found.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = dealt.groupBy(length, "_part").agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(W.partitionBy(length).orderBy("_part")) - F.col("_n")).drop("_n")
    ranked = dealt.withColumn("_rank", F.row_number().over(W.partitionBy(length, "_part").orderBy(*order)) - 1)
    ranked = ranked.join(before, [length, "_part"]).withColumn("_rank", F.col("_rank") + F.col("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(places["start"], (size.to_numpy() << 44) + rank.to_numpy(), "right") - 1
        i, k = rank.to_numpy() - places["rank"][at], places["k"][at]
        return pd.DataFrame({"sequence_id": places["bin"][at] + i // k, "offset": places["offset"][at] + i % k * size.to_numpy()})

    return ranked.withColumn("_at", place(F.col(length), F.col("_rank"))).select(*kept, "_at.sequence_id", "_at.offset")
