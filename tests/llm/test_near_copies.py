import random
import tracemalloc

import corpus_pipeline as pipeline

from rosterforge.llm import jaccard_join as jj
from rosterforge.llm import near_copies as nc
from rosterforge.llm.simhash import shingles


def jaccard(a, b):
    x, y = ({" ".join(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(x & y) / len(x | y)


def edited(words, at, mark):
    return " ".join(f"{mark}{i}" if i in at else w for i, w in enumerate(words))


def test_the_pipeline_finds_edited_copies(spark, make, prose):
    r = random.Random(5)
    rows, want = [], set()
    for g, base in enumerate(prose(6, 12, 150, 300)):
        words = base.split()
        close, far = ({r.randrange(len(words)) for _ in range(len(words) // n)} for n in (60, 15))
        rows += [(3 * g, base), (3 * g + 1, edited(words, close, "new")), (3 * g + 2, edited(words, far, "other"))]
        want.add(3 * g)
        assert jaccard(base, rows[-2][1]) >= 0.8 > jaccard(base, rows[-1][1])
        want.add(3 * g + 2)
    got = {x.doc_id for x in pipeline.near_duplicates(spark, make(rows), "").collect()}
    assert got == want


def test_large_buckets_are_linked_in_rounds(spark, make, prose):
    base = prose(7, 1, 200, 200)[0].split()
    rows = [(i, edited(base, {i} if i else (), "new")) for i in range(100)]
    rows += [(1000 + i, t) for i, t in enumerate(prose(8, 20, 30, 60))]
    found = nc.groups(make(rows)).collect()
    assert {x.component_id for x in found if x._key < 100} == {0}
    assert len({x.component_id for x in found}) == 21


def test_odd_rows(make, odd):
    kept = nc.keep_one(make(odd)).collect()
    assert sorted(str(x.doc_id) for x in kept) == sorted(["1", "2", "None", "6", "7", "8"])
    assert nc.keep_one(make([])).count() == 0


def test_simhash_proposes_and_the_join_completes(spark, make, prose, monkeypatch):
    r = random.Random(9)
    bases = prose(9, 8, 300, 400)
    rows = [(10 * g + i, edited(b.split(), {r.randrange(300)} if i else (), "new")) for g, b in enumerate(bases) for i in range(3)]
    rows += [(10 * g + 5, edited(b.split(), set(range(0, 300, 75)), "far")) for g, b in enumerate(bases)]
    compared = []
    links = nc.links
    monkeypatch.setattr(nc, "links", lambda fps: compared.append(out := links(fps).persist()) or out)
    found = {x._key: x.component_id for x in nc.groups(make(rows)).collect()}
    assert found == {k: k // 10 * 10 for k, _ in rows}
    assert len(compared) == 1 and compared[0].count() > 0
    assert all(bin((x.u ^ x.v) & (1 << 64) - 1).count("1") <= 2 for x in compared[0].collect())
    # proposals are compared before they link: texts of one SimHash, but not alike, stay apart
    monkeypatch.setattr("rosterforge.llm.jaccard_join.set_fingerprint", lambda h: 1)
    assert {x._key: x.component_id for x in nc.groups(make(rows)).collect()} == found


def test_one_of_equal_rows_stays_and_no_single_text_is_shuffled(make, odd, prose, monkeypatch):
    texts = prose(10, 12, 60, 90)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 2 + [(50, texts[3]), (None, texts[4])]
    for most in (nc.BROADCAST_ROWS, 0):
        monkeypatch.setattr(nc, "BROADCAST_ROWS", most)
        assert sorted((x.doc_id, x.text) for x in nc.keep_one(make(rows)).collect()) == list(enumerate(texts))
        assert len(nc.keep_one(make(odd)).collect()) == 6
    assert "LeftAnti" in nc.keep_one(make(rows))._jdf.queryExecution().optimizedPlan().toString()


def test_a_long_text_takes_no_python_object_a_word():
    text = " ".join(f"w{i}" for i in range(100_000))

    def peak(f):
        tracemalloc.start()
        f()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert 1.5 * peak(lambda: [*jj.shingle_sets([text], nc.WORDS)]) < peak(lambda: shingles(text, nc.WORDS))
