"""Token ids of whole texts by a public tokenizer, encoding each distinct word once."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

#: Lower-case Latin letters in composed form: a word of these is one pre-token.
LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Closing punctuation: a run of these after letters is one pre-token more.
CLOSING = ".,!?;:|"
#: Beyond these characters lower-casing need not be one to one.
WIDE = re.compile("[^\x00-\xff]")
#: Separators for Python's split() that are not white space to the tokenizer.
CONTROL = re.compile("[\x1c-\x1f]")
#: The mark of a word's last piece in the vocabulary.
LAST = "</w>"
#: Distinct words kept at most, per worker.
MEMO = 600_000
#: Characters split into words at a time.
PART = 1_000_000


class WordEncoder:
    """Ids as packed little-endian unsigned 32-bit integers.

    For lower-casing tokenizers whose pre-tokenizer drops white space and never
    crosses it: a text's ids are then those of its words in a row.  New words of
    letters are encoded together, for their last pieces show where each one ends;
    all others go through the tokenizer one by one."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith(LAST)]] = True
        self.memo: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def _pack(self, ids: list[int]) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    def _one_by_one(self, words: list[str]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            yield self._pack(e.ids)

    def _learn(self, words: list[str]) -> None:
        split = [(w, w.rstrip(CLOSING)) for w in words]
        plain = [c for c in {c for _, c in split} if c not in self.cores and LETTERS.fullmatch(c)]
        if plain:
            ids = np.asarray(self.tokenizer.encode(" ".join(plain), add_special_tokens=False).ids, "<u4")
            packed, ends = ids.tobytes(), (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            self.cores.update(zip(plain, [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        rest = []
        for w, core in split:
            if (head := self.cores.get(core)) is None:
                rest.append(w)
                continue
            tail = w[len(core) :]
            if tail not in self.tails:
                (self.tails[tail],) = self._one_by_one([tail])
            self.memo[w] = head + self.tails[tail]
        self.memo.update(zip(rest, self._one_by_one(rest), strict=True))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The packed ids of each text; null is empty."""
        part: list[list[str] | bytes] = []
        size = 0
        for text in texts:
            text = text or ""
            if CONTROL.search(text):
                part.append(self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                part.append((text if WIDE.search(text) else text.lower()).split())
            size += len(text)
            if size >= PART:
                yield from self._join(part)
                part, size = [], 0
        yield from self._join(part)

    def _join(self, part: list[list[str] | bytes]) -> Iterator[bytes]:
        if len(self.memo) > MEMO:
            self.memo, self.cores, self.tails = {}, {}, {"": b""}
        # asked word by word: a difference of sets would walk the whole memo
        self._learn([w for w in set().union(*[x for x in part if isinstance(x, list)]) if w not in self.memo])
        get = self.memo.__getitem__
        for x in part:
            yield x if isinstance(x, bytes) else b"".join(map(get, x))
