import random
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterforge.llm import simhash
from rosterforge.llm.components import connected_components


def plain(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="abAB é\t\n.", max_size=60))
def test_fingerprint_is_the_contracts(text):
    assert simhash.text_fingerprint(text, 3) % (1 << 64) == plain(text)


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            flip = (1 << i) | (1 << j)
            assert any(not flip & m for m in masks)


def test_links_connect_what_all_pairs_connect(spark):
    r = random.Random(1)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 6)):
            fps.add(x)
            for _ in range(r.randint(1, 3)):
                x ^= 1 << r.randrange(64)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    near = lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 2
    assert all(near(e.u, e.v) for e in edges)
    want = components([(a, b) for a in fps for b in fps if a < b and near(a, b)], fps)
    assert components([(e.u, e.v) for e in edges], fps) == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {n: c for n, c in components(edges, {x for e in edges for x in e}).items() if n != c}
    assert found == want


def test_odd_rows(spark, make, odd):
    rows = simhash.near_duplicates(make(odd)).collect()
    assert len(rows) == len(odd)
    by = {(r._key, r._row): r for r in rows}
    fingerprint = {k: r.fingerprint for (k, _), r in by.items()}
    for i, text, *_ in odd:
        assert fingerprint[i] == f"{plain(text):016x}"
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {2}
    assert {r.component_id for r in rows if r._key in (1, 5)} == {1}
    kept = simhash.keep_one(make(odd)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "2", "None", "6", "7", "8"])
    assert simhash.near_duplicates(make([])).count() == 0


def test_near_copies_are_found(spark, make, prose):
    base = prose(3, 1, 400, 400)[0]
    words = base.split()
    copies = [" ".join([*words[:i], "edited", *words[i + 1 :]]) for i in range(0, 400, 40)]
    rows = [(i, t) for i, t in enumerate([base, *copies, *prose(4, 20)])]
    fps = {i: plain(t) for i, t in rows}
    want = components([(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2], fps)
    got = {r._key: r.component_id for r in simhash.near_duplicates(make(rows)).collect()}
    assert got == want
