"""Whitening against numpy's eigenvectors of the whole covariance, and defined edge cases."""

import numpy as np
import pytest

from planmart.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, row string, component string, n string, v int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, None, "r", "c", "n", 1) for i, v in vectors], SCHEMA).repartition(5)


def brute(vectors, components=4, scale=256):
    good = [(i, [int(np.floor(scale * float(np.float32(c)))) for c in v]) for i, v in vectors
            if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in good])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return [i for i, _ in good], (x - s / n) @ u / np.sqrt(e), n, ((n * x - s) ** 2).sum(axis=1), e / np.trace(cov)


def check(got, vectors, tolerance=1e-9):
    ids, white, n, deviation, explained = brute(vectors)
    k = white.shape[1]
    want = sorted((i, j + 1) for i in ids for j in range(k))
    assert sorted((r.row.vec_id, r.component) for r in got) == want
    place = {i: p for p, i in enumerate(ids)}
    for r in got:
        p, j = place[r.row.vec_id], r.component - 1
        assert r.n == n and r.deviation == deviation[p]
        assert r.whitened == pytest.approx(white[p, j], abs=tolerance)
        assert r.explained == pytest.approx(explained[j], rel=1e-9) and 0 <= r.identity_error < 1e-9
        assert (r.row.row, r.row.label) == ("r", None)


def vectors(seed, n=400, d=24):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((d, d)) * (0.9 ** np.arange(d))
    rows = [(i, [float(c) for c in rng.standard_normal(d) @ mix + 0.3]) for i in range(n)]
    rows += [(n + i, rows[i % 7][1]) for i in range(300)]  # copies count once in the fit, hot ones too
    rows += [(n + 300 + i, rows[0][1]) for i in range(200)]
    return rows


def test_against_numpy(spark):
    rows = vectors(1)
    bad = [(9000, None), (9001, []), (9002, [None] * 24), (9003, [float("nan")] * 24), (9004, [float("inf")] + [0.0] * 23),
           (9005, [1.0, 2.0]), (9006, [1e30] * 24)]
    got = W.whiten(frame(spark, rows + bad)).collect()
    check(got, rows)


def test_query_on_the_given_table(spark, sf_small):
    import __spark_entry__ as E
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, white, n, deviation, explained = brute(rows)
    got = E.queries()["op12_whitening"](spark, sf_small).collect()
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, j) for i in ids for j in range(1, 5))
    place = {i: p for p, i in enumerate(ids)}
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[place[r.vec_id]])
        assert r.whitened == pytest.approx(white[place[r.vec_id], r.component - 1], abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9


def test_filter_finds_pairs_that_lie_close_together():
    rng = np.random.default_rng(2)
    u, _ = np.linalg.qr(rng.standard_normal((300, 300)))
    e = np.concatenate([[5.0, 4.9, 4.9, 4.8], np.linspace(4.5, 0.0, 296)])
    cov, passes = (u * e) @ u.T, []
    values, found = W.principal(lambda q: passes.append(q.shape) or cov @ q, 300)
    assert np.allclose(values, e[:4], rtol=1e-12) and np.allclose(found.T @ found, np.eye(4), atol=1e-12)
    assert np.abs(cov @ found - found * values).max() < 1e-11 and set(passes) == {(300, 24)} and len(passes) < 150


def test_edge_cases(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [None])])).count() == 0
    one = W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted((str(r.row.vec_id), r.component, r.n, r.deviation, r.whitened, r.explained) for r in one) == sorted(
        (i, c, 1, 0, None, 0.0) for i in ("1", "2", "None") for c in (1, 2))
    line = W.whiten(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0])])).collect()
    assert sorted((r.row.vec_id, r.component, None if r.whitened is None else round(r.whitened, 9)) for r in line) == [
        (1, 1, -1.0), (1, 2, None), (2, 1, 1.0), (2, 2, None)]
    assert W.whiten(frame(spark, [(1, [0.5]), (2, [0.25])])).count() == 2


def test_deviation_that_needs_more_than_64_bits_is_an_error():
    with pytest.raises(OverflowError):
        W._deviations(np.array([[1 << 40, 0]]), 1 << 20, np.array([0, 0]))
    assert list(W._deviations(np.array([[1 << 20, 0]]), 1 << 11, np.array([0, 3]))) == [(1 << 62) + 9]
