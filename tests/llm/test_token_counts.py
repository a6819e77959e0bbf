import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterforge.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


SIZE = tc.processor(PATH).get_piece_size()


@pytest.fixture(scope="module")
def counts():
    return np.random.default_rng(4).zipf(1.3, SIZE).clip(0, 10**9)


@pytest.fixture(scope="module")
def counter(counts):
    return tc.UnigramCounter(PATH, counts)


def plain(counter, word):
    """The best segmentation of one word, by itself."""
    text = tc.MARK + word
    longest = max(map(len, counter.scores))
    best = [(0.0, 0)] + [None] * len(text)
    for i in range(1, len(text) + 1):
        size = len(text[i - 1].encode("utf-8", "surrogatepass"))
        options = [(best[i - 1][0] + size * counter.byte, best[i - 1][1] + size)]
        options += [(best[j][0] + counter.scores[text[j:i]], best[j][1] + 1) for j in range(max(0, i - longest), i) if text[j:i] in counter.scores]
        best[i] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1]


@settings(max_examples=60, deadline=None)
@given(words=st.sets(st.text(alphabet="aehintorsTé😀", min_size=1, max_size=14), max_size=12))
def test_shared_prefixes_change_nothing(counter, words):
    assert dict(counter.count_distinct(words)) == {w: plain(counter, w) for w in words}


def test_odd_rows(spark, make, odd):
    words = [w for _, t, *_ in odd for w in (t or "").split()]
    counts = np.bincount([i for w in words for i in tc.processor(PATH).encode(w)], minlength=SIZE)
    assert tc.piece_counts(make(odd), PATH).tolist() == counts.tolist()
    counter = tc.UnigramCounter(PATH, counts)
    rows = tc.token_counts(make(odd), PATH).collect()
    assert len(rows) == len(odd)
    for r in rows:
        words = (r.text or "").split()
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(plain(counter, w) * n for w, n in {w: words.count(w) for w in set(words)}.items()))
    assert tc.token_counts(make([]), PATH).count() == 0


def test_columns_of_the_results_names_are_replaced(spark):
    rows = tc.token_counts(spark.createDataFrame([(1, "a b", 7, 8)], "id long, text string, n_tokens long, n_pretokens long"), PATH).collect()
    assert [(r.id, r.n_pretokens, r.n_tokens) for r in rows] == [(1, 2, 2)]


def test_memo_is_bounded(monkeypatch, counter, counts):
    monkeypatch.setattr(tc, "MEMO", 5)
    monkeypatch.setattr(tc, "PART", 20)
    texts = ["the other one", "another day of the other", None, "of a day"] * 5
    small = tc.UnigramCounter(PATH, counts)
    assert list(small.count(texts)) == list(counter.count(texts)) and len(small.memo) < 20
