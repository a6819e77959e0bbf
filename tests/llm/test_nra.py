import math
import random

from rosterforge.llm import nra


def brute(rows, k=5):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            scaled = [math.floor(256 * x) for x in v]
            ok[i] = min(ok[i], scaled) if i in ok else scaled
    out = []
    for q in (i for i in ok if i % 50 == 0):
        held = lambda s: max(-(2**63), min(2**63 - 1, s))
        scores = [(-held(sum(a * b for a, b in zip(ok[q], v, strict=False))), i) for i, v in ok.items() if i != q]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def search(spark, rows, k=5):
    # floats, as the table stores them
    import numpy as np

    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = nra.top_k(vectors(spark, [(*r, 0) for r in rows]), "vec_id % 50 = 0", k).collect()
    return sorted(map(tuple, got)), brute(rows, k)


def test_best_of_many(spark, monkeypatch):
    monkeypatch.setattr(nra, "CANDIDATES", 150)
    monkeypatch.setattr(nra, "QUERIES", 4)
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(12)]) for i in range(600)]
    rows += [(i, rows[7][1]) for i in range(600, 900)]  # one very common vector
    got, want = search(spark, rows)
    assert got == want


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -0.25]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    rows += [(5, [1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0]), (8, [-1.0, 0.001])]
    got, want = search(spark, rows)
    assert got == want
    assert nra.top_k(vectors(spark, []), "vec_id % 50 = 0").count() == 0
    got, want = search(spark, [(0, [1.0]), (50, [2.0])])
    assert got == want and len(got) == 2


def test_large_components_are_exact(spark):
    for top in (1e6, 1e9):  # beyond what doubles hold, beyond what a long holds
        got, want = search(spark, [(i, [top + i * 64.0, -top]) for i in range(0, 120, 10)])
        assert got == want


def test_reading_stops_early():
    import numpy as np

    r = np.random.default_rng(1)
    x = r.normal(0, 5, (2000, 4)).astype(np.int64)
    x[:3] *= 100
    calls = []
    exact = nra._exact
    nra._exact, keep = lambda q, c: (calls.append(len(c)), exact(q, c))[1], nra._exact
    try:
        found = list(nra.block_top(np.arange(2000), x, np.array([0]), x[:1], 3))
    finally:
        nra._exact = keep
    order = sorted((-int(x[0] @ x[i]), i) for i in range(1, 2000))[:3]
    assert found == [(0, i, -s) for s, i in order] and max(calls) <= nra.LEFT


def test_most_queries_on_the_embeddings_stop_before_their_lists_end():
    import numpy as np
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    x = np.floor(256 * np.stack(table["embedding"].to_numpy()).astype(np.float64)).astype(np.int64)
    ids = table["vec_id"].to_numpy()
    asked, told = ids % 50 == 0, []
    found = sorted(nra.block_top(ids, x, ids[asked], x[asked], 5, told))
    scores = x[asked] @ x.T
    want = [(int(q), int(ids[j]), int(row[j])) for q, row in zip(ids[asked], scores, strict=True) for j in sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-row[j], ids[j]))[:5]]
    assert found == sorted(want) and len(told) == asked.sum()
    assert sum(share < 1 for share in told) >= 0.8 * len(told)


def met(q, ids, x, k, size, told=None, first=40):
    """What the blocks' best give, and what all scores give."""
    import numpy as np

    best = nra.Best(q, k, nra.first_bounds(q, ids[:first], x[:first], k), told)
    for at in range(0, len(ids), size):
        best.meet(ids[at : at + size], x[at : at + size])
    scores = nra._exact(q.astype(np.int64), x.astype(np.int64)).tolist()
    want = [sorted(zip((-s for s in row), ids.tolist(), strict=True))[:k] for row in scores]
    got = [[(-int(s), int(i)) for s, i in zip(*row, strict=True)][:n] for *row, n in zip(best.scores, best.ids, best.held, strict=True)]
    return got, want


def test_bounds_of_earlier_blocks_lose_nothing(monkeypatch):
    import numpy as np

    monkeypatch.setattr(nra, "ABREAST", 7)
    r = np.random.default_rng(5)
    # few different scores; singles, doubles and neither hold the sums
    for most in (2, 1 << 14, 1 << 22, 1 << 60):
        for first in (3, 40, 300):
            x = r.integers(-most, most, (300, 6), endpoint=True)
            ids = r.permutation(1000)[:300] - 500
            got, want = met(x[:30], ids, x, 4, 37, first=first)
            assert got == want
    x = np.zeros((90, 3), np.int16)  # all scores equal
    got, want = met(x[:5], np.arange(90)[::-1].copy(), x, 4, 20)
    assert got == want
    got, want = met(x[:5], np.arange(3), x[:3], 4, 20)
    assert got == want and all(len(row) == 3 for row in got)


def test_blocks_stop_before_the_lists_end():
    import numpy as np

    r = np.random.default_rng(6)
    x = np.rint(r.normal(0, 100, (20_000, 32)) * 0.6 ** np.arange(32)).astype(np.int16)
    told = []
    got, want = met(x[:50], np.arange(20_000), x, 5, 500, told, first=600)
    assert got == want and max(told[-5:]) < 0.5


def test_equal_vectors_and_groups_of_queries(spark, monkeypatch):
    for name, n in (("QUERIES", 3), ("CANDIDATES", 50), ("FIRST", 20), ("BLOCK", 30), ("ABREAST", 2)):
        monkeypatch.setattr(nra, name, n)
    r = random.Random(8)
    kinds = [[r.gauss(0, 0.3) for _ in range(5)] for _ in range(30)]
    rows = [(i, kinds[0] if i % 3 == 0 else r.choice(kinds)) for i in range(700)]
    rows += [(i, [r.gauss(0, 0.3) for _ in range(r.randint(0, 5))]) for i in range(700, 1000)]
    got, want = search(spark, rows)
    assert got == want


def test_few_pairs_come_up_to_the_bounds_of_earlier_blocks(monkeypatch):
    """Before, each block began without bounds and resolved up to 64 candidates a query."""
    import numpy as np

    taken, merge = [], nra.Best._merge
    monkeypatch.setattr(nra.Best, "_merge", lambda self, rows, *found: (taken.append(len(rows)), merge(self, rows, *found))[1])
    x = np.random.default_rng(9).integers(-130, 130, (40_000, 16)).astype(np.int16)
    got, want = met(x[:100], np.arange(len(x)), x, 6, nra.BLOCK, first=nra.FIRST)
    assert got == want and sum(taken) < 40 * 100
