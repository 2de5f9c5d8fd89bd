import math
from fractions import Fraction

import numpy as np
import pytest

from questlog.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component double"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, None, "clash", 0.5) for i, v in vectors], SCHEMA)


def exact(vectors):
    """n, S, covariances and deviations in fractions."""
    x = [[math.floor(64 * Fraction(float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    v = [[sum((r[i] - Fraction(s[i], n)) * (r[j] - Fraction(s[j], n)) for r in x) / n for j in range(d)] for i in range(d)]
    return x, s, np.array([[float(c) for c in r] for r in v]), [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]


def test_against_fractions(spark):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(120, 6)) @ rng.normal(size=(6, 6))
    good = [(i, [float(np.float32(c)) for c in r]) for i, r in enumerate(mixed)] + [(2**53 + 1, [0.5] * 6), (2**53 + 1, [0.5] * 6), (None, [-3.0] * 6)]
    bad = [(900, None), (901, [1.0, None, 0, 0, 0, 0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (905, [1.0])]
    bad = [(i, v if v is None else [None if c is None else float(c) for c in v]) for i, v in bad]
    rows = whitening.whiten(frame(spark, good + bad).repartition(5)).collect()
    x, s, v, deviation = exact([g for _, g in good])
    n = len(good)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    assert len(rows) == n * 6 and {r["n"] for r in rows} == {n}
    assert sorted({r["vec_id"] for r in rows} - {None}) == sorted({i for i, _ in good} - {None})
    centred = np.array(x, float) - np.array([float(Fraction(t, n)) for t in s])
    for r in rows:
        k = r["component"] - 1
        assert r["explained"] == pytest.approx(e[k] / np.trace(v), rel=1e-9) and r["identity_error"] < 1e-9
        if r["vec_id"] is not None and r["vec_id"] < 900:
            assert int(r["deviation"]) == deviation[r["vec_id"]]
            assert abs(r["whitened"]) == pytest.approx(abs(centred[r["vec_id"]] @ u[:, k]) / math.sqrt(e[k]), abs=1e-8)
    y = np.zeros((120, 6))
    for r in rows:
        if r["vec_id"] is not None and r["vec_id"] < 900:
            y[r["vec_id"], r["component"] - 1] = r["whitened"]
    signs = np.sign((y * ((centred[:120] @ u) / np.sqrt(e))).sum(0))
    assert np.allclose(y * signs, (centred[:120] @ u) / np.sqrt(e), atol=1e-7)  # one sign for all rows


def test_covariances_come_from_squares_alone():
    rng = np.random.default_rng(0)
    z = rng.integers(-1000, 1000, (50, 5))
    squares = {(i, -1): int((z[:, i] ** 2).sum()) for i in range(5)} | {(i, j): int(((z[:, i] + z[:, j]) ** 2).sum()) for i in range(5) for j in range(i + 1, 5)}
    assert np.allclose(whitening.covariance(50, [int(t) for t in z.sum(0)], squares), np.cov(z.T, bias=True), rtol=1e-12)


def test_large_numbers_stay_exact(spark):
    """Entries beyond longs, and sums of several parts."""
    vectors = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [3e15, 3.0])]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(frame(spark, vectors).coalesce(1)).collect()}
    *_, deviation = exact([v for _, v in vectors])
    assert len(got) == 6 and got[0, 1]["deviation"] is None and deviation[0] >= 10**38
    assert got[0, 1]["explained"] == pytest.approx(1.0)
    wide = [(i, [float(2**40 * i), float(i % 3)]) for i in range(9)]
    *_, deviation = exact([v for _, v in wide])
    assert {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(frame(spark, wide)).collect()} == dict(enumerate(deviation))
    assert whitening._parts([0], [-1], [-(1 << 130) + 5]).num_rows == 3


def test_degenerate_tables(spark, tmp_path):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, []), (3, [float("nan")])])).count() == 0
    rows = whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows] == [(1, 0, None, None, 0.0)] * 2
    rows = whitening.whiten(frame(spark, [(i, [float(i), 1.0]) for i in range(4)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["explained"] == (1.0 if r["component"] == 1 else 0.0) for r in rows)
    frame(spark, []).drop("n").write.parquet(f"{tmp_path}/embeddings.parquet")
    empty = queries.QUERIES["op11_embedding_whitening"](spark, str(tmp_path))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(empty.dtypes)["deviation"] == dict(empty.dtypes)["n"] == "bigint"
