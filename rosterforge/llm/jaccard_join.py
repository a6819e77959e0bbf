"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Texts of one shingle set are one node.  A node's shingles are put in one order
for all, common ones last; two sets that are alike share elements among the
first ones of both, their prefixes.  Small sets enumerate the pairs of their
prefix (subsets of a fixed size), so that common shingles meet only in company.
Large sets scan the inverted lists of their prefix; small ones stand in those
lists too if they may have a large partner.  The boundary is the size at which
the subsets of all smaller sets plus the lists of all larger ones cost least.

Lists of common keys are never expanded into pairs.  Their members meet leaders
first, and components found so far are not compared within; what is left over
meets everything else in its lists, so no link between components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut, row_key, stored
from rosterforge.llm.components import connected_components
from rosterforge.llm.simhash import set_fingerprint

WORDS = 4
#: Jaccard similarity as a fraction of whole numbers.
SIMILAR = (85, 100)
#: Elements of an enumerated subset.
SUBSET = 2
#: Documents above which a shingle is common, and what a common key counts for in the cost.
OFTEN = 16
#: Common shingles that every task knows (9 bytes each).  Further ones are only put in
#: another order: their lists are found by length, and results do not change.
MOST = 1_000_000
#: Shingles that a task gathers before it passes their counts on, and text per part of the counts.
GATHERED, PART_CHARS = 1_000_000, 16_000_000
#: Slots of a part.
SLOTS = 1 << 24
#: Bytes of texts that are taken apart at a time (a longer text is one block).
BLOCK = 1_000_000
#: The bytes that separate words.
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Row keys or pairs up to which the candidates' texts and sets are found by broadcast.
BROADCAST_ROWS = 1_000_000
#: Meetings per member, before sizes and places are looked at, at which the rounds over common lists end.
PER_MEMBER = 500
#: Buckets in which a set's elements are counted: two sets share at most what their buckets do.
BUCKETS = 256


def _mixed(h: np.ndarray, more: np.ndarray | int) -> np.ndarray:
    """Hashes with one more number told to each: one to one in either, then MurmurHash3's finalizer."""
    h = (h ^ more) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(where the words of lower-cased text begin, their hashes), of the words' bytes, eight at a time, and their lengths."""
    edges = np.flatnonzero(np.diff(BLANK[np.frombuffer(b" " + data + b" ", np.uint8)]))
    starts, left = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))  # from every byte on
    h, at = _mixed(left.astype(np.uint64), 42), np.arange(len(starts))
    place = starts
    while len(at):
        bits = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
        h[at] = _mixed(h[at], eights[place] << bits)
        on = left > 8
        at, place, left = at[on], place[on] + 8, left[on] - 8
    return starts, h


def shingle_sets(texts: Iterable[str | None], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a shorter text is one shingle, none have none."""

    def block(part: list[bytes]) -> Iterator[np.ndarray]:
        starts, word = _word_hashes(b" ".join(part))
        ends = np.cumsum([len(t) + 1 for t in part])
        bounds = np.searchsorted(starts, ends).tolist()
        first = _mixed(word, 43)  # other than the words that follow: their order counts
        h = first[: max(0, len(word) - words + 1)]
        for i in range(1, words):
            h = _mixed(h, word[i : len(h) + i])
        for a, b in zip([0, *bounds[:-1]], bounds, strict=True):
            if b - a >= words:
                own = np.sort(h[a : b - words + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            else:
                yield reduce(_mixed, [word[i : i + 1] for i in range(a + 1, b)], first[a : min(b, a + 1)])

    part, size = [], 0
    for text in texts:
        part.append(text.encode().lower() if text else b"")  # bytes: A-Z and ASCII space only
        size += len(part[-1])
        if size >= BLOCK:
            yield from block(part)
            part, size = [], 0
    if part:
        yield from block(part)


def _codes(h: np.ndarray, parts: int) -> np.ndarray:
    """Shingles by the part that counts them and one of its 2^24 slots (some 3 million
    shingles fall to a part whatever the input, so few share a slot)."""
    p = np.uint64(parts)
    return (h % p << np.uint64(32)) | (h // p & np.uint64(SLOTS - 1))


def _packed(slots: np.ndarray) -> bytes:
    """Rising slots as their steps, byte by byte of all: the upper bytes are mostly zero."""
    steps = np.diff(slots, prepend=np.uint32(0)).astype(np.uint32)
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32)


def common_shingles(docs: DataFrame, text: str, words: int) -> tuple[int, np.ndarray, np.ndarray, bool]:
    """(parts, sorted codes of shingles of more than ``OFTEN`` documents, log2 of their
    document counts, whether only the ``MOST`` most common are told).

    All documents are counted.  A task merges what repeats before it passes on
    packed slots, in blocks by part, so that a shingle of every document is one
    entry per task."""
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    parts = max(64, chars // PART_CHARS)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def merged(sets: list[np.ndarray]) -> pd.DataFrame:
            codes = _codes(np.concatenate(sets), parts)
            codes.sort()
            at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            codes, n = codes[at], np.diff(at, append=len(codes))
            part, rest = (codes >> np.uint64(32)).astype(np.int64), codes.astype(np.uint32)
            ends = np.flatnonzero(np.diff(part, prepend=-1))
            own = part[ends]
            rows = []
            for p, a, b in zip(own.tolist(), ends.tolist(), [*ends[1:].tolist(), len(part)], strict=True):
                r, c = rest[a:b], n[a:b]
                rows.append((p, _packed(r[c == 1]), _packed(r[c > 1]), c[c > 1].astype(np.uint32).tobytes()))
            return pd.DataFrame(rows, columns=["part", "once", "more", "n"])

        sets, size = [], 0
        for batch in batches:
            for own in shingle_sets(batch["t"], words):
                sets.append(own)
                size += len(own)
                if size >= GATHERED:
                    yield merged(sets)
                    sets, size = [], 0
        if size:
            yield merged(sets)

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ones, mores = [_unpacked(x) for x in rows["once"]], [_unpacked(x) for x in rows["more"]]
        found, n = [], [np.frombuffer(x, np.uint32) for x in rows["n"]]
        for at in range(0, SLOTS, SLOTS // 8):  # an eighth at a time: the sums of all slots would take 64 MB
            sums = np.zeros(SLOTS // 8, np.uint32)
            for x in ones:  # no slot stands twice in any of these
                a, b = np.searchsorted(x, np.asarray((at, at + len(sums)), np.uint32))
                sums[x[a:b] - np.uint32(at)] += np.uint32(1)
            for x, c in zip(mores, n, strict=True):
                a, b = np.searchsorted(x, np.asarray((at, at + len(sums)), np.uint32))
                sums[x[a:b] - np.uint32(at)] += c[a:b]
            often = np.flatnonzero(sums > OFTEN)
            found.append(pd.DataFrame({"code": (key[0] << 32) | (often + at), "level": np.log2(sums[often]).astype(np.int8)}))
        return pd.concat(found)

    spread = docs.select(F.col(text).alias("t")).mapInPandas(gather, "part long, once binary, more binary, n binary")
    often = cut(spread.groupBy("part").applyInPandas(count, "code long, level byte"))
    levels = {r["level"]: r["n"] for r in often.groupBy("level").agg(F.count("*").alias("n")).collect()}  # at most 64 rows
    least, told = 64, 0
    while least > 0 and told + levels.get(least - 1, 0) <= MOST:
        least -= 1
        told += levels.get(least, 0)
    table = often.where(F.col("level") >= least).toPandas()
    codes = table["code"].to_numpy().view(np.uint64)
    order = np.argsort(codes)
    return parts, codes[order], table["level"].to_numpy()[order], told < sum(levels.values())


def prefix(found: np.ndarray, level: np.ndarray, similar: tuple[int, int]) -> tuple[np.ndarray, int]:
    """(the first elements in the common order, how many of them are not common), long
    enough for two sets that are alike to share ``SUBSET`` elements there."""
    n = len(found)
    keep = min(n, n - -(-n * similar[0] // similar[1]) + SUBSET)
    order = np.argsort(level, kind="stable")[:keep]  # equal levels by hash
    return found[order], int((level[order] == 0).sum())


def _marked(docs: DataFrame, key: str, text: str, words: int, similar: tuple[int, int], fingerprints: bool) -> tuple[DataFrame, bool]:
    """``_key, _row, s`` (hash of the set), ``n, pre, rare, fp`` (the set's SimHash, 0 unless
    ``fingerprints``) of every row; whether some common shingles are not told."""
    parts, codes, levels, partly = common_shingles(docs, text, words)
    known = docs.sparkSession.sparkContext.broadcast((codes, levels))

    @F.pandas_udf("s long, n long, pre array<long>, rare int, fp long")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes, levels = known.value
        low = np.uint64(SLOTS // 4 - 1)
        slots = np.zeros(SLOTS // 4, bool)  # the low bits of common shingles: few others need the search
        slots[codes & low] = True
        for texts in batches:
            rows = []
            for h in shingle_sets(texts, words):
                own = _codes(h, parts)
                level = np.zeros(len(h), np.int8)
                if len(at := np.flatnonzero(slots[own & low])):
                    near = np.minimum(np.searchsorted(codes, own[at]), len(codes) - 1)
                    level[at] = np.where(codes[near] == own[at], levels[near], 0)
                pre, rare = prefix(h, level, similar)
                rows.append((xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63), len(h), pre.view(np.int64), rare, set_fingerprint(h) if fingerprints else 0))
            yield pd.DataFrame(rows, columns=["s", "n", "pre", "rare", "fp"])

    found = docs.select(F.col(key).alias("_key"), row_key(key, text).alias("_row"), sketch(F.col(text)).alias("x"))
    return stored(found.select("_key", "_row", "x.*")), partly


def _least(n: Column, similar: tuple[int, int]) -> Column:
    """The smallest overlap with which a set of size ``n`` can be alike to any other."""
    return F.ceil(n * similar[0] / similar[1]).cast("long")


def boundary(kinds: DataFrame, similar: tuple[int, int]) -> int:
    """The largest size whose sets enumerate subsets: where all subsets below and all
    lists above cost least.  A subset costs 1; an element of a list 1, a common one ``OFTEN``."""
    first = F.col("n") - _least(F.col("n"), similar) + 1
    wide = F.least(first + SUBSET - 1, F.col("n"))
    rare = F.least(F.col("rare").cast("long"), first)
    sized = kinds.select(
        F.floor(F.log2("n") * 4).alias("step"), "n", (wide * (wide - 1) / 2).alias("subsets"), (rare + OFTEN * (first - rare)).alias("lists")
    )
    steps = sized.groupBy("step").agg(F.max("n").alias("n"), F.sum("subsets").alias("subsets"), F.sum("lists").alias("lists")).orderBy("step").collect()
    cost = sum(r["lists"] for r in steps)
    best, at = cost, 0
    for r in steps:  # at most 4 rows a doubling of the longest text
        cost += r["subsets"] - r["lists"]
        best, at = (cost, r["n"]) if cost <= best else (best, at)
    return at


def _keys(kinds: DataFrame, most: int, similar: tuple[int, int]) -> DataFrame:
    """``key, s, n, reach, large, often``: where a set looks for partners.  ``reach`` bounds
    its overlap with a partner whose first common elements these are."""
    n = F.col("n")
    first = (n - _least(n, similar) + 1).cast("int")
    partner = F.floor(n * similar[1] / similar[0])
    lists = kinds.where(partner > most).select("s", "n", "rare", F.posexplode(F.slice("pre", 1, first)).alias("i", "key"))
    lists = lists.select("key", "s", "n", (n - F.col("i")).alias("reach"), (n > most).alias("large"), (F.col("i") >= F.col("rare")).alias("often"))
    small = kinds.where((n <= most) & (n > 1)).select("s", "n", "rare", "pre", F.posexplode("pre").alias("i", "a"))
    pairs = small.select("s", "n", "rare", "i", "a", F.posexplode(F.expr("slice(pre, i + 2, size(pre))")).alias("k", "b"))
    pairs = pairs.select(
        F.xxhash64("a", "b").alias("key"), "s", "n", (n - F.col("i") - F.col("k")).alias("reach"), F.lit(True).alias("large"), (F.col("i") >= F.col("rare")).alias("often")
    )
    return lists.unionByName(pairs)


def _meet(left: DataFrame, right: DataFrame, similar: tuple[int, int], on: list[str]) -> DataFrame:
    """``u, v``, u > v, and ``spare``, how far their bound is above what they need: members of
    one list whose sizes and places let them be alike."""
    names = ("s", "n", "reach", "large")
    a, b = (df.select(*on, *[F.col(c).alias(f"{c}_{x}") for c in names]) for df, x in ((left, "a"), (right, "b")))
    spare = (similar[0] + similar[1]) * F.least("reach_a", "reach_b") - similar[0] * (F.col("n_a") + F.col("n_b"))
    met = a.join(b, on).where((F.col("s_a") != F.col("s_b")) & (F.col("large_a") | F.col("large_b")) & (spare >= 0))
    return met.select(F.greatest("s_a", "s_b").alias("u"), F.least("s_a", "s_b").alias("v"), spare.alias("spare"))


def links(docs: DataFrame, kinds: DataFrame, partly: bool, key: str, text: str, words: int, similar: tuple[int, int], proposed: DataFrame | None = None) -> DataFrame:
    """``node, root`` of the components of all pairs of sets that are alike, but for the roots.

    First the ``proposed(u, v)`` pairs are compared, and every set with its likeliest partner of
    those that share a rare key with it and of the leaders of its common keys' lists (a
    list's leader has the longest reach).  Then the other such pairs that are not joined yet are compared, and
    at last the members outside their list's largest component with all
    others of the list.  If those meetings exceed ``PER_MEMBER`` a member, they meet 8, 64,
    ... leaders a list before, which joins most of them."""
    most = boundary(kinds, similar)
    rows = _keys(kinds, most, similar)
    rare, often = rows.where(~F.col("often")), rows.where("often")
    if partly:  # lists of common shingles that no task knows
        long = rare.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > OFTEN).select("key")
        often = often.unionByName(rare.join(long, "key", "left_semi"))
        rare = rare.join(long, "key", "left_anti")
    few = cut(_meet(rare, rare, similar, ["key"]).groupBy("u", "v").agg(F.max("spare").alias("spare")))
    often = stored(often.drop("often"))
    sizes = often.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = stored(often.join(sizes, "key"))

    first = few.select("u", "v").limit(0) if proposed is None else cut(proposed.select("u", "v"))
    met = few.select("u", "v") if proposed is None else few.select("u", "v").unionAll(first)
    wanted = met.select(F.col("u").alias("s")).unionAll(met.select("v")).unionAll(members.select("s")).distinct()
    sets = _sets(docs, kinds.join(wanted, "s").select("s", "_row"), key, text, words)
    found: list[DataFrame] = []  # since the last labels
    label = sets.select("s", F.col("s").alias("c")).limit(0)
    done = few.select("u", "v").limit(0)

    def component(df: DataFrame, s: str, c: str) -> DataFrame:
        return df.join(label.select(F.col("s").alias(s), F.col("c").alias("_c")), s, "left").withColumn(c, F.coalesce("_c", s)).drop("_c")

    def apart(pairs: DataFrame) -> DataFrame:
        return component(component(pairs, "u", "cu"), "v", "cv").where("cu != cv").select("u", "v")

    def of(pairs: DataFrame, side: str, few: bool) -> DataFrame:
        """The sets at one side of the pairs; others are not shuffled."""
        ids = pairs.select(side).distinct()
        return sets.withColumnRenamed("s", side).join(F.broadcast(ids) if few else ids, side, "left_semi")

    def joined(pairs: DataFrame, few: bool, column: str) -> DataFrame:
        a = of(pairs, "u", few).select("u", F.col(column).alias("a"))
        return pairs.join(a, "u").join(of(pairs, "v", few).select("v", F.col(column).alias("b")), "v")

    def compare(pairs: DataFrame) -> None:
        """Finds the links among pairs that are neither joined nor compared yet.  Each query
        costs the driver threads and plans, so none is asked about no pairs."""
        nonlocal done
        pairs = cut(apart(pairs.select("u", "v").distinct()).join(done, ["u", "v"], "left_anti"))
        n = pairs.count()
        if not n:
            return
        done = done.unionAll(pairs)

        def alike(both: Column, all_: Column) -> Column:
            return similar[1] * both >= similar[0] * (all_ - both)

        total = lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x)
        most = total(F.zip_with("a", "b", lambda x, y: F.least(x, y)))
        close = joined(pairs, n <= BROADCAST_ROWS, "counts").where(alike(most, total(F.col("a")) + total(F.col("b"))))
        close = cut(close.select("u", "v"))
        n = close.count()
        if not n:
            return
        full = joined(close, n <= BROADCAST_ROWS, "items")
        found.append(cut(full.where(alike(F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b"))).select("u", "v")))

    def relabel() -> None:
        nonlocal label
        if found:
            edges = reduce(DataFrame.unionAll, found, label.select(F.col("s").alias("u"), F.col("c").alias("v")))
            label = connected_components(edges).select(F.col("node").alias("s"), F.col("root").alias("c"))
            found.clear()

    def led(left: DataFrame, leaders: int) -> DataFrame:
        """The leaders of each list, one in each share of its members, meet ``left``."""
        share = F.pmod(F.xxhash64("s", F.lit(leaders)), F.lit(leaders)).alias("share")
        of = members.groupBy("key", share).agg(F.max(F.struct("reach", F.col("s"), F.col("n"), F.col("large"))).alias("x")).select("key", "x.*")
        return _meet(left, of, similar, ["key"])

    def left_over() -> DataFrame:
        """Members outside the largest component of their list."""
        own = component(members, "s", "comp")
        sizes = own.groupBy("key", "comp").agg(F.count("*").alias("k"))
        largest = sizes.groupBy("key").agg(F.max(F.struct("k", "comp")).alias("x")).select("key", F.col("x.comp").alias("top"), F.col("x.k").alias("k"))
        return cut(own.join(largest, "key").where("comp != top").drop("top", "k"))

    one = led(members, 1)
    both = few.unionAll(one)
    ends = both.select(F.col("u").alias("s"), "u", "v", "spare").unionAll(both.select("v", "u", "v", "spare"))
    best = ends.groupBy("s").agg(F.max(F.struct("spare", "u", "v")).alias("x")).select("x.u", "x.v")
    compare(best if proposed is None else best.unionAll(first))
    relabel()
    compare(both)
    relabel()
    n, leaders = members.count(), 8
    left = left_over()
    while (left.agg(F.sum("c")).first()[0] or 0) > PER_MEMBER * n and leaders < members.agg(F.max("c")).first()[0]:
        compare(led(left, leaders))
        relabel()
        left, leaders = left_over(), leaders * 8
    compare(_meet(left, members, similar, ["key"]))
    relabel()
    return label.select(F.col("s").alias("node"), F.col("c").alias("root"))


def _sets(docs: DataFrame, rows: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``s, items, counts`` for the texts of ``rows(s, _row)``: a set's elements, and how many fall to each bucket."""

    @F.pandas_udf("items array<long>, counts array<int>")
    def items(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [*shingle_sets(texts, words)]
            counts = [np.bincount((x % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS).astype(np.int32) for x in sets]
            yield pd.DataFrame({"items": [x.view(np.int64) for x in sets], "counts": counts})

    rows = cut(rows)
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
    texts = docs.select(row_key(key, text).alias("_row"), F.col(text).alias("_text")).join(rows, "_row")
    return stored(texts.groupBy("s").agg(F.first("_text").alias("_text")).select("s", items("_text").alias("x")).select("s", "x.*"))


def linked(
    docs: DataFrame, text: str, key: str, words: int, similar: tuple[int, int], propose: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (``_key, _row, s, n``: hash and size of each row's set), the different sets
    (``s, n, low``: with their smallest key) and ``node, root`` of those sets that are not their component's root.

    ``propose`` may give pairs ``(u, v)`` to compare first, from the sets ``(s, fp)`` and their SimHashes."""
    marked, partly = _marked(docs, key, text, words, similar, propose is not None)
    kinds = marked.groupBy("s").agg(*[F.first(c).alias(c) for c in ("n", "pre", "rare", "fp")], F.min("_row").alias("_row"), F.min("_key").alias("low"))
    kinds = stored(kinds)
    some = kinds.where("n > 0")
    stars = links(docs, some, partly, key, text, words, similar, propose(some.select("s", "fp")) if propose else None)
    return marked.select("_key", "_row", "s", "n"), kinds.select("s", "n", "low"), stars


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """A row for each row of ``docs``: ``key, n_shingles, component_id``.

    ``component_id`` is the smallest ``key`` that links reach, a link being a Jaccard
    similarity of the sets of word shingles of ``similar`` or more.  A text with fewer
    words than a shingle is one shingle; null texts and texts without words have
    an empty set, link with nothing and keep their own key.  Equal sets are linked.
    Null keys get their component's id (null only if it has no other).  Repeated
    rows stay; an empty table gives no rows; more columns are not looked at.
    Shingles are compared by 64-bit hashes."""
    marked, kinds, stars = linked(docs, text, key, words, similar)
    rooted = kinds.join(stars, kinds["s"] == stars["node"], "left").select("s", "low", F.coalesce("root", "s").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(ids, "root").select("s", "component_id")
    none = F.when(F.col("n") == 0, F.col("_key")).otherwise(F.col("component_id"))
    return marked.select("_key", "s", "n").join(of, "s", "left").select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), none.alias("component_id"))
