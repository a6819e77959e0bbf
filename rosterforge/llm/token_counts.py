"""Token counts by dynamic programming over a trie of distinct pre-tokens.

The tokenizer is a unigram model: a pre-token's tokens are the pieces of its
most probable segmentation.  The pieces are those of a public vocabulary, their
probabilities the corpus': one pass counts how often each occurs where the
vocabulary's own merges segment the texts.  The distinct pre-tokens of a stretch of text form
a trie.  It is walked depth first (in sorted order); the forward score of a
node, that is of a prefix, is computed once from those above it for all
pre-tokens that share it, and the count at a terminal is stored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands for the space before a pre-token.
MARK = "▁"
#: Distinct pre-tokens whose counts a worker keeps at most.
MEMO = 600_000
#: Characters split into pre-tokens at a time.
PART = 2_000_000


@cache
def processor(path: str):
    """One tokenizer for each vocabulary in a worker."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def piece_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> np.ndarray:
    """How often each piece of the vocabulary (by its id) occurs in all texts.

    A task adds up what it reads, so at most the vocabulary's size is shuffled from each
    and that many numbers come back."""
    size = processor(vocabulary).get_piece_size()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def add(words: Counter[str]) -> None:
            ids = processor(vocabulary).encode(list(words), num_threads=1)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.int64, int(lens.sum()))
            found[:] += np.bincount(flat, np.repeat(np.fromiter(words.values(), np.int64, len(ids)), lens), size).astype(np.int64)

        found, words, read = np.zeros(size, np.int64), Counter(), 0
        for batch in batches:
            for t in batch["text"]:
                words.update(t.split())
                read += len(t)
                if read >= PART:
                    add(words)
                    words, read = Counter(), 0
        add(words)
        some = np.flatnonzero(found)
        yield pd.DataFrame({"piece": some, "n": found[some]})

    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(count, "piece long, n long")
    out = np.zeros(size, np.int64)
    for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect():  # no more than the vocabulary holds
        out[r["piece"]] = r["n"]
    return out


class UnigramCounter:
    """The pieces of a SentencePiece vocabulary, each with the share of its count plus one;
    a character without a piece costs its UTF-8 bytes, each less probable than any piece."""

    def __init__(self, path: str, counts: np.ndarray) -> None:
        p = processor(path)
        ids = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        total = math.log(int(counts[ids].sum()) + len(ids))
        self.scores = {p.id_to_piece(i): math.log(int(counts[i]) + 1) - total for i in ids}
        self.byte = -total - 1.0
        self.back: dict = {}  # pieces by their characters from the last; None holds the score
        for piece, score in self.scores.items():
            node = self.back
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[None] = score
        self.memo: dict[str, int] = {}

    def count_distinct(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """Each pre-token with its number of tokens, in sorted order."""
        score, used = [0.0], [0]  # of the nodes on the path, that is of the prefixes
        path = ""
        for word in sorted(words):
            marked = MARK + word
            shared = 0
            for a, b in zip(path, marked, strict=False):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], used[shared + 1 :]
            for i in range(shared, len(marked)):
                c = marked[i]
                size = len(c.encode("utf-8", "surrogatepass"))
                best, n = score[i] + size * self.byte, used[i] + size
                node, j = self.back.get(c), i
                while node is not None:
                    own = node.get(None)
                    if own is not None:
                        s = score[j] + own
                        if s > best or s == best and used[j] + 1 < n:
                            best, n = s, used[j] + 1
                    j -= 1
                    if j < 0:
                        break
                    node = node.get(marked[j])
                score.append(best)
                used.append(n)
            path = marked
            yield word, used[-1]

    def count(self, texts: Iterable[str | None]) -> Iterator[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        part: list[list[str]] = []
        size = 0
        for text in texts:
            part.append(text.split() if text else [])
            size += len(text or "")
            if size >= PART:
                yield from self._add(part)
                part, size = [], 0
        yield from self._add(part)

    def _add(self, part: list[list[str]]) -> Iterator[tuple[int, int]]:
        if len(self.memo) > MEMO:
            self.memo = {}
        # asked word by word: a difference of sets would walk the whole memo
        self.memo.update(self.count_distinct([w for w in set().union(*part) if w not in self.memo]))
        get = self.memo.__getitem__
        for words in part:
            yield len(words), sum(map(get, words))


@cache
def counter(path: str, counts: bytes) -> UnigramCounter:
    """One counter for each vocabulary and its counts in a worker."""
    return UnigramCounter(path, np.frombuffer(counts, np.int64))


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` (long) of the whole text; columns of
    these names are replaced.

    Pre-tokens are what white space separates.  Null and blank texts have none.
    Repeated rows stay; an empty table gives no rows.  Texts are not shuffled: a worker
    holds one stretch of text, a bounded memo and the vocabulary's counts."""
    counts = docs.sparkSession.sparkContext.broadcast(piece_counts(docs, vocabulary, text).tobytes())  # 8 bytes a piece

    @F.pandas_udf("n_pretokens long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(list(counter(vocabulary, counts.value).count(batch)), columns=["n_pretokens", "n_tokens"], dtype="int64")

    kept = [c for c in docs.columns if c not in ("n_pretokens", "n_tokens")]
    return docs.withColumn("_n", counted(F.col(text))).select(*kept, "_n.n_pretokens", "_n.n_tokens")
