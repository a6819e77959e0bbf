import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterforge.llm import packing
from rosterforge.llm.encoding import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=40), st.text(alphabet="aAbÉéßÿ×ªº ,.'s!?;:|1<|>́ \x1c\x85　", max_size=40)))
def test_ids_are_the_tokenizers(tokenizer, encoder, text):
    (got,) = encoder.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings(tokenizer, encoder):
    text = "a <|endoftext|> b<|startoftext|>c It's we'll DON'T"
    assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def fill(bins):
    return {b: sum(x * k for x, k in b) for b in bins}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 50), max_size=25))
def test_plans_hold_every_piece(counts):
    for bins in (plan := packing.best_fit(counts, 100), packing.local_search(plan, 100)):
        held = defaultdict(int)
        for b, n in bins.items():
            for x, k in b:
                held[x] += k * n
        assert dict(held) == counts
        assert all(f <= 100 for f in fill(bins).values())
    assert sum(packing.local_search(plan, 100).values()) <= sum(plan.values())


def test_local_search_empties_bins_by_exchanges():
    # 10 fits only after 4 goes for 1: {6, 1} {5, 4} {4} -> {6, 4} {5, 4, 1}
    bins = {((6, 1), (1, 1)): 3, ((5, 1), (4, 1)): 3, ((4, 1),): 3}
    found = packing.local_search(bins, 10)
    assert sum(found.values()) == 6 and all(f == 10 for f in fill(found).values())


def steps_left(bins, capacity):
    """All moves and exchanges, by trying each pair of bins."""
    for a in bins:
        for b in bins:
            if a == b and bins[a] < 2 or fill(bins)[b] < fill(bins)[a]:
                continue
            space = capacity - fill(bins)[b]
            own = [x for x, k in a for _ in range(k)]
            ones, twos = own, [own[i] + own[j] for i in range(len(own)) for j in range(i)]
            backs = [y for y, _ in b]
            if any(0 < x - y <= space for x in ones for y in [0, *backs]) or any(0 < x - y <= space for x in twos for y in backs):
                return True
    return False


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(15, 60), min_size=5, max_size=60))
def test_the_search_ends_only_where_no_step_is_left(lengths):
    counts = {x: lengths.count(x) for x in lengths}
    found = packing.local_search(packing.best_fit(counts, 100), 100)
    assert sum(found.values()) == -(-sum(lengths) // 100) or not steps_left(found, 100)


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_odd_rows(spark, make, odd, tokenizer):
    docs = make(odd)
    rows = packing.pack(packing.pieces(docs, PATH, 2048), 2048, ["doc_id", "piece", "start", "ids_crc32"]).collect()
    want = []
    for i, text, *_ in odd:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(i, p // 2048, p, len(ids[p : p + 2048]), zlib.crc32(np.asarray(ids[p : p + 2048], "<u4").tobytes())) for p in range(0, len(ids), 2048)]
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    assert check(rows, 2048) <= -(-sum(x[3] for x in want) // 2048) + 1
    assert packing.pack(packing.pieces(make([]), PATH, 2048), 2048, ["doc_id"]).count() == 0


def test_hot_length_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 10)
    df = spark.range(500).selectExpr("id", "case when id < 300 then 7L else id % 13 + 1 end as length", "'x' as offset")
    rows = packing.pack(df, 20, ["id"]).collect()
    # no bin holds three pieces of 7 or more
    assert len(rows) == 500 and check(rows, 20) == -(-sum(r.length >= 7 for r in rows) // 2)
