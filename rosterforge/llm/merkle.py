"""Document fingerprints: a Merkle tree over sections, paragraphs and spans.

Paragraphs are lines.  A section ends at a blank line or at a paragraph whose
own digest says so, hence an edit moves no section borders but its own.
Within a paragraph the leaves are spans of up to ``SPAN`` code points, cut by one rule
in texts of any length.  They end early at sentence ends, at a space after a word that
ends in one of some letters, and at some code points of scripts without spaces, so an
insertion moves the spans only up to the next such place.  Roots test equality; the short leaf digests that a
fingerprint carries show how much two texts share and where they differ.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a span at most.
SPAN = 8
#: Hex digits of a leaf in a fingerprint.
SHORT = 6
#: One paragraph in so many ends a section.
SECTION = 8
#: Where a span ends: after these, and after the first two of each sixteen code points from
#: U+2E80 to U+D7FF, the part of Unicode with scripts that write no spaces.
ENDS = ".!?。！？" + "".join(f"{chr(c)}{chr(c + 1)}" for c in range(0x2E80, 0xD800, 16))
#: A space ends a span after these letters.
WORD_ENDS = "dhlptx"
SPANS = re.compile(f"[^{ENDS}]{{1,{SPAN - 1}}}?(?:[{ENDS}]{{1,{SPAN}}}|(?<=[{WORD_ENDS}]) )|[^{ENDS}]{{1,{SPAN}}}|[{ENDS}]{{1,{SPAN}}}")

#: Spans whose digests a worker keeps at most; most spans of an edited text are those of the text.
MEMO = 300_000


class _Digests(dict):
    """Spans and their digests, worked out when asked for first."""

    def __missing__(self, span: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        self[span] = found = sha256(span.encode()).digest()
        return found


_digest = _Digests().__getitem__


class _Paragraphs(dict):
    """Lines with their digests and their leaves' short digests, worked out when asked for first.

    An edited text is made of lines of two texts but for the one at the cut."""

    def __missing__(self, line: str) -> tuple[bytes, str]:
        leaves = list(map(_digest, SPANS.findall(line)))
        self[line] = found = sha256(b"\1" + b"".join(leaves)).digest(), b"".join([x[: SHORT // 2] for x in leaves]).hex()
        return found


def fingerprint(text: str | None, lines: _Paragraphs | None = None) -> str:
    """``root:section/section``, a section ``paragraph.paragraph``, a paragraph its
    leaves' short digests in a row.  Null is the empty text, which has no sections.
    Equal texts have equal fingerprints; different ones different roots.  ``lines``
    holds lines worked out before and takes up those of this text."""
    lines = _Paragraphs() if lines is None else lines
    sections: list[str] = []
    roots: list[bytes] = []
    shorts: list[str] = []
    nodes: list[bytes] = []
    for line in text.split("\n") if text else ():
        node, short = lines[line]
        shorts.append(short)
        nodes.append(node)
        if not line or node[0] % SECTION == 0:
            sections.append(".".join(shorts))
            roots.append(sha256(b"\2" + b"".join(nodes)).digest())
            shorts, nodes = [], []
    if nodes:
        sections.append(".".join(shorts))
        roots.append(sha256(b"\2" + b"".join(nodes)).digest())
    return sha256(b"\3" + b"".join(roots)).hexdigest() + ":" + "/".join(sections)


Leaves = tuple[np.ndarray, np.ndarray]


def _leaves(print_: str) -> Leaves:
    """The distinct leaves of a fingerprint, as numbers, and how often each occurs."""
    tail = print_.partition(":")[2].replace(".", "").replace("/", "")
    parts = np.frombuffer(bytes.fromhex(tail), np.uint8).reshape(-1, SHORT // 2).astype(np.int64)
    return np.unique(parts @ (256 ** np.arange(SHORT // 2)), return_counts=True)


def _shared(a: Leaves, b: Leaves) -> float:
    (x, n), (y, m) = a, b
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return 2 * int(np.minimum(n[i], m[j]).sum()) / max(1, int(n.sum() + m.sum()))


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else the share of leaves (with repeats) that both have."""
    return 1.0 if a == b else _shared(_leaves(a), _leaves(b))


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a`` whose digests ``b`` lacks: where an edit is.
    Branches that occur in ``b`` as a whole are not entered."""
    theirs = b.partition(":")[2].split("/")
    whole, parts = set(theirs), {p for s in theirs for p in s.split(".")}
    mine = a.partition(":")[2].split("/")
    return [(i, j) for i, s in enumerate(mine) if s not in whole for j, p in enumerate(s.split(".")) if p not in parts]


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third (rounded
    down) of its code points replaced by as many first ones of the next row's.

    The next row is by descending key, nulls last, ties by row hash; after the
    last comes the first (a single row is its own next).  Returns ``key, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Ids and row hashes alone are sorted first; their range borders then deal out the texts,
    which are shuffled once.  The head of each range goes to the range above as
    well, so every row meets its next one without a global order.  Rows of one id (or
    without any) are dealt by their hash as well; only fully equal rows stay together."""
    low = -(1 << 63)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(key, text).alias("tie"))
    # ascending in (at, then) is the order of next rows from the last to the first
    rows = rows.withColumns({"at": F.coalesce("id", F.lit(low)), "then": F.bitwise_not("tie")})
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct("at", "then")
    ranges = rows.select("at", "then").repartitionByRange(parts, "at", "then").groupBy(F.spark_partition_id().alias("range"))
    heads = ranges.agg(F.min(place).alias("low"), F.max(place).alias("top")).orderBy("low").collect()
    border, within = (np.asarray([h["low"][c] for h in heads], np.int64) for c in ("at", "then"))
    # the head of each range is the next of the last row of the range above
    ghosts = docs.sparkSession.createDataFrame([(*h["top"], (i + 1) % len(heads)) for i, h in enumerate(heads)], "at long, then long, above int")

    @F.pandas_udf("int")
    def range_of(at: pd.Series, then: pd.Series) -> pd.Series:
        a, t = at.to_numpy(), then.to_numpy()
        first, last = np.searchsorted(border, a), np.searchsorted(border, a, "right")
        for i in np.unique(first[last > first]):  # ids at which ranges begin
            own = (first == i) & (last > first)
            last[own] = i + np.searchsorted(within[i : last[own][0]], t[own], "right")
        return pd.Series(last - 1).astype("int32")

    dealt = rows.withColumn("part", range_of("at", "then")).join(F.broadcast(ghosts), ["at", "then"], "left")
    own = F.struct(F.col("part"), F.lit(False).alias("ghost"))
    also = F.when(F.col("above").isNotNull(), F.array(own, F.struct(F.col("above").alias("part"), F.lit(True).alias("ghost")))).otherwise(F.array(own))
    dealt = dealt.withColumn("to", F.explode(also)).select("to.part", "to.ghost", "id", "at", "tie", "text")
    dealt = dealt.repartitionById(max(1, len(heads)), F.col("part")).sortWithinPartitions("part", "ghost", F.desc("at"), "tie")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # part, ghost, id, text, fingerprint, its leaves and lines
        for batch in batches:
            out = []
            for part, ghost, i, text in zip(batch["part"], batch["ghost"], batch["k"], batch["text"], strict=True):
                if last and last[1] and ghost and last[0] == part:
                    continue  # only the first row of the range below is a next row
                lines = _Paragraphs()
                mark = fingerprint(text, lines)
                leaves = _leaves(mark)
                if last and last[0] == part and not last[1]:
                    _, _, k, before, own, held, known = last
                    n = len(before)
                    edited = before[: n - n // 3] + text[: n // 3]
                    known.update(lines)
                    of = fingerprint(edited, known)
                    near = [1.0 if own == x else _shared(held, y()) for x, y in ((of, lambda: _leaves(of)), (mark, lambda: leaves))]
                    out.append((k, n, sha256(edited.encode()).hexdigest(), own, of, *near))
                last = (part, ghost, i, text, mark, leaves, lines)
            if out:
                yield pd.DataFrame(out, columns=["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    found = dealt.select("part", "ghost", F.col("id").cast("string").alias("k"), "text").mapInPandas(
        walk, "k string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return found.select(F.col("k").cast(kind).alias(key), *found.columns[1:])
