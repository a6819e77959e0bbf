import numpy as np
import pytest

from rosterforge.llm import whitening as wh


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k") for i, v in rows], "vec_id long, embedding array<float>, n int, component string")


def run(spark, rows, **how):
    return wh.whiten(wh.quantised(table(spark, rows)), **how).collect()


def test_equal_to_numpy(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK", 7)  # several blocks in both directions
    r = np.random.default_rng(1)
    data = (r.normal(size=(300, 12)) @ r.normal(size=(12, 12))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(900, None), (901, [1.0, float("nan")] + [0.0] * 10), (902, [None] * 12), (903, [float("inf")] * 12), (904, [1.0]), (905, [])]
    got = run(spark, rows)
    x = np.floor(1024 * data.astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    z = c @ v[:, :8] / np.sqrt(e[:8])
    assert len(got) == n * 8
    out = np.zeros((n, 8))
    for g in got:
        out[g.vec_id, g.component - 1] = g.whitened
        assert g.n == n and g.deviation == int(((n * x[g.vec_id] - s) ** 2).sum())
        assert g.explained == pytest.approx(e[g.component - 1] / cov.trace(), rel=1e-9)
        assert g.identity_error < 1e-9
    for k in range(8):
        assert min(np.abs(out[:, k] - z[:, k]).max(), np.abs(out[:, k] + z[:, k]).max()) < 1e-9
    assert np.abs(out.T @ out / n - np.eye(8)).max() < 1e-9


def test_odd_rows(spark):
    assert run(spark, []) == [] == run(spark, [(1, None)]) == run(spark, [(1, [1.0, 2.0])]) == run(spark, [(1, [1.0]), (1, [1.0])])
    got = run(spark, [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (None, [2.0, 2.0])])  # one direction, a repeated row, a null id
    assert [(g.vec_id, g.component) for g in sorted(got, key=lambda g: g.vec_id or 9)] == [(1, 1), (1, 1), (None, 1)]
    assert all(abs(g.explained - 1) < 1e-12 for g in got) and max(g.identity_error for g in got) < 1e-9
    assert len(run(spark, [(i, [float(i), i * i / 7]) for i in range(20)], components=1)) == 20
