import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import whitening as W
from shelfmatch.llm.common import table

ROWS = "vec_id long, embedding array<float>, label int"


def vectors(n=300, d=6, seed=1):
    r = np.random.default_rng(seed)
    m = r.standard_normal((n, d)) @ r.standard_normal((d, d)) + 3 * r.standard_normal(d)
    return [(k, [float(np.float32(x)) for x in row], 0) for k, row in enumerate(m)]


def brute(rows, most=4):
    """Rows, n, deviations, whitened (up to the sign) and explained of the rows that remain."""
    sound = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = {k: np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64) for k, (_, v) in enumerate(sound)}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    y = fit - total / n
    values, parts = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:most]
    return n, [(sound[k][0], int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, total))), (v - total / n) @ parts[:, order] / np.sqrt(values[order])) for k, v in x.items()], values[order] / values.sum()


def check(got, rows, most=4):
    n, want, explained = brute(rows, most)
    order = lambda t: (str(t[0]), t[1], np.abs(t[2]).round(6).tolist())
    have = sorted(((r.vec_id, r.deviation, np.array(r.whitened)) for r in got.transform().collect()), key=order)
    want = sorted(want, key=order)
    assert got.n == n and [h[:2] for h in have] == [w[:2] for w in want]
    a, b = np.array([h[2] for h in have]), np.array([w[2] for w in want])
    signs = np.sign((a * b).sum(axis=0))
    assert np.abs(a * signs - b).max() < 1e-9 and np.allclose(got.explained, explained, rtol=1e-9) and got.identity_error < 1e-9


def test_equals_numpy_with_odd_rows(spark, frame):
    rows = vectors()
    odd = [(900, None, 1), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (902, [float("nan")] * 6, 1), (903, [float("inf")] + [0.0] * 5, 1), (904, [-0.0] * 6, 1), (905, [1e-9, -1e-9, 0.0, 0.5, -0.5, 1.0], 1),
           (None, rows[3][1], 1), (None, rows[3][1], 1), (rows[5][0], rows[5][1], 1)]
    odd += [(2000 + k, rows[7][1], 1) for k in range(150)]  # one vector with a third of the rows
    check(W.Whitening(frame(rows + odd, ROWS).withColumns({"x": F.lit("c"), "copies": F.lit(1)})), rows + odd)


def test_rows_of_another_length_are_dropped(spark, frame):
    rows = vectors()
    mixed = rows + [(3000 + k, [1.0, 2.0], 1) for k in range(40)] + [(4000, [], 1), (4001, [1e30] * 6, 1)]
    check(W.Whitening(frame(mixed, ROWS)), rows)


def test_blocks_bands_and_splits(spark, frame, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ENTRIES", 16 * 6)
    monkeypatch.setattr(W, "BAND", 4)
    monkeypatch.setattr(W, "TASK_BYTES", 1 << 11)
    rows = vectors(500)
    for coalesce in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        fit = W.Whitening(frame(rows, ROWS, 5))
        assert fit.height == 16 and len(fit._bands()) > 5 and (len(fit.first) == 1) == (coalesce == "true")
        check(fit, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_deviation_is_exact_or_null(spark, frame):
    rows = [(k, [float(2 ** 20 + k), float(-k * k)], 0) for k in range(50)]
    check(W.Whitening(frame(rows, "vec_id long, embedding array<double>, label int")), rows, 2)
    far = [(0, [2.0 ** 50, 1.0], 0), (1, [-(2.0 ** 50), 0.0], 0), (2, [0.0, 5.0], 0)]
    assert {r.deviation for r in W.Whitening(frame(far, "vec_id long, embedding array<double>, label int")).transform().collect()} == {None, 2 * 0 + (3 * 5 * 256 - 6 * 256) ** 2 + 0}


def test_no_variance_and_empty_tables(spark, frame):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)] * 3, [(1, [], 0)]):
        fit = W.Whitening(spark.createDataFrame(rows, ROWS))
        assert fit.transform().count() == 0 and len(fit.explained) == 0
    flat = W.Whitening(frame([(k, [float(k), 1.0, 2.0 * k], 0) for k in range(9)], ROWS))
    assert len(flat.explained) == 1 and flat.explained[0] == pytest.approx(1.0)


def test_query(spark):
    got = W.op12_whitening(spark, "/root/testdata/sf0.001")
    n = table(spark, "/root/testdata/sf0.001", "embeddings").count()
    assert got.count() == 4 * n and {r.component for r in got.select("component").distinct().collect()} == {1, 2, 3, 4}
    assert got.agg(F.max("identity_error")).first()[0] < 1e-4
