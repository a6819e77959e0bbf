import random
import time

from rosterforge.llm import jaccard_join as jj
from rosterforge.llm.simhash import shingles


def shingle_sets(rows, words=4):
    out = []
    for _, t, *_ in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        out.append({" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    return out


def by_all_pairs(rows):
    """(key, size, component) of every row, from every pair."""
    sets = shingle_sets(rows)
    low = list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                low[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)] = min(ids.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(s), ids.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(docs, **how):
    out = jj.groups(docs, **how)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, out.collect()), key=str)


def edited(words, n, r, mark):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"{mark}{r.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    """Small and large texts, edits around the threshold, one large group and passages that many share."""
    r = random.Random(2)
    rows = []
    for size in (7, 9, 12, 16, 25, 40, 80, 200, 400):
        for base in prose(size, 4, size, size):
            words = base.split()
            rows += [base, *[edited(words, r.randint(0, 1 + size // 20), r, "x") for _ in range(4)], " ".join(words[: size - size // 9])]
    base = prose(50, 1, 150, 150)[0].split()
    rows += [edited(base, r.randint(1, 7), r, "y") for _ in range(90)]
    common = prose(51, 2, 60, 60)
    rows += [f"{common[i % 2]} {t}" for i, t in enumerate(prose(52, 60, 4, 40))]
    r.shuffle(rows)
    return [(r.randrange(10**6), t) for t in rows]


def test_equal_to_all_pairs(make, prose):
    rows = corpus(prose)
    want = by_all_pairs(rows)
    assert 150 < len({c for *_, c in want}) < 300
    assert got(make(rows).repartition(7)) == want


def test_every_boundary_and_unknown_common_shingles(make, prose, monkeypatch):
    rows = corpus(prose)
    want = by_all_pairs(rows)
    for most in (0, 30, 10**6):
        monkeypatch.setattr(jj, "boundary", lambda *_, most=most: most)
        assert got(make(rows)) == want
        monkeypatch.setattr(jj, "MOST", 20)
        monkeypatch.setattr(jj, "PER_MEMBER", 1)


def test_sets_are_those_of_plain_shingles(prose, odd, monkeypatch):
    texts = [t for _, t, *_ in odd] + ["a", "b a", "a b a", "b a a b", "a b b a", "eight888 eight8888 " * 3, "sixteen890123456 sixteen8901234567", "nul\0 nul nul\0\0 nul"]
    texts += prose(3, 40, 1, 60)
    for block in (jj.BLOCK, 50):
        monkeypatch.setattr(jj, "BLOCK", block)
        for words in (1, 2, 4, 5):
            got, named = [*jj.shingle_sets(texts, words)], {}
            want = shingle_sets([(0, t) for t in texts], words)
            assert [len(h) for h in got] == [len(x) for x in want]
            assert all((h[1:] > h[:-1]).all() for h in got)
            for h, x in zip(got, want, strict=True):  # equal shingles, equal hashes, in whatever text
                assert named.setdefault(frozenset(x), h.tobytes()) == h.tobytes()
            assert len({x for h in got for x in h.tolist()}) == len(set().union(*want))


def test_sets_take_no_python_step_a_shingle(prose):
    texts = prose(4, 400, 400, 600)

    def seconds(f):
        least = []
        for _ in range(3):
            t = time.thread_time()
            f()
            least.append(time.thread_time() - t)
        return min(least)

    assert 2 * seconds(lambda: [*jj.shingle_sets(texts, 4)]) < seconds(lambda: [shingles(t, 4) for t in texts])


def test_common_shingles_are_those_of_plain_counts(make, prose, monkeypatch):
    monkeypatch.setattr(jj, "GATHERED", 500)
    texts = prose(5, 60, 1, 40) * 3 + prose(6, 5, 20, 40) * 20 + [None, " "]
    parts, codes, levels, partly = jj.common_shingles(make([*enumerate(texts)]), "text", 2)
    counts = {}
    for h in jj.shingle_sets(texts, 2):
        for c in jj._codes(h, parts).tolist():
            counts[c] = counts.get(c, 0) + 1
    want = {c: n.bit_length() - 1 for c, n in counts.items() if n > jj.OFTEN}
    assert len(want) > 50 and not partly
    assert dict(zip(codes.tolist(), levels.tolist(), strict=True)) == want and (codes[1:] > codes[:-1]).all()


def test_odd_rows(make, odd):
    assert got(make(odd)) == by_all_pairs(odd)
    assert got(make([])) == [] and got(make([(1, None), (1, " ")])) == [(1, 0, 1), (1, 0, 1)]
