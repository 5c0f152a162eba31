import math

import numpy as np
import pytest

from orderflow.llm import whitening as m
from orderflow.llm.queries import op12_chebyshev_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string"


def expected(rows, components=32):
    """numpy's own eigenvectors: (whole numbers, deviations, whitened up to sign, explained)."""
    c = np.array([r for r in rows], np.float64)
    x = np.floor(64 * c) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = values[:components] > 1e-12 * values.sum()
    values, axes = values[:components][kept], axes[:, :components][:, kept]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    total = np.trace(centred.T @ centred / n)
    return deviations, centred @ axes / np.sqrt(values), values / total


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = op12_chebyshev_whitening(spark, sf).toPandas()
    deviations, whitened, explained = expected(table.embedding)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    assert wide.shape == whitened.shape == (len(table), 32)
    signs = np.sign((wide * whitened).sum(axis=0))
    assert np.abs(wide - whitened * signs).max() < 1e-8
    assert got.groupby("vec_id").deviation.first().loc[table.vec_id].tolist() == deviations
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert set(got.n) == {len(table)} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((40, 6)).round(2).tolist()
    rows = [(k, v, 1, "x", "y") for k, v in enumerate(good)] + [(0, good[0], 1, "x", "y"), (None, good[1], 1, "x", "y")]
    bad = [None, [1.0] * 5 + [None], [math.nan] * 6, [math.inf] + [1.0] * 5, [1e30] * 6, [1.0, 2.0], []]
    rows += [(100 + k, v, 1, "x", "y") for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = m.whiten(df, 4).toPandas()
    deviations, whitened, explained = expected([*good, good[0], good[1]], 4)
    assert len(got) == 42 * 4 and set(got.n) == {42} and sorted(got.deviation) == sorted(deviations * 4)
    assert got.vec_id.isna().sum() == 4 and set(got.vec_id.dropna()) == set(range(40))
    for k in range(4):
        mine = np.sort(got[got.component == k + 1].whitened)
        assert min(np.abs(mine - np.sort(s * whitened[:, k])).max() for s in (1, -1)) < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), explained[:4])


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1, "", "")], [(k, [3.0, 4.0], 1, "", "") for k in range(5)],
                                  [(1, [], 1, "", ""), (2, [], 1, "", "")], [(1, None, 1, "", "")]],
                         ids=["none", "one", "equal", "empty vectors", "null"])
def test_no_variance(spark, rows):
    assert m.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_rank(spark):
    rows = [(k, [float(k), 2.0 * k, 7.0, float(k % 3)], 1, "", "") for k in range(30)]
    got = m.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert set(got.component) == {1, 2} and got.identity_error.iloc[0] < 1e-8


def symmetric(values, seed=3):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q * values @ q.T, q


@pytest.mark.parametrize("values", [
    np.linspace(2.0, 1.0, 200), np.geomspace(1.0, 1e-9, 120), np.r_[np.full(40, 3.0), np.full(60, 1.0)],
    np.r_[10.0, 9.0, np.zeros(80)], np.arange(20.0, 0.0, -1.0)], ids=["flat", "steep", "ties", "rank two", "small"])
def test_certified(values):
    matrix, q = symmetric(values)
    passes = []
    got, axes = m.eigenpairs(lambda b: passes.append(1) or matrix @ b, len(values), min(32, len(values)))
    wanted = len(got)
    assert np.allclose(got, values[:wanted], atol=1e-10 * values[0])
    assert np.abs(axes.T @ axes - np.eye(wanted)).max() < 1e-12
    assert np.linalg.norm(matrix @ axes - axes * got, axis=0).max() <= m.FLOOR * values[0]
    if wanted == len(values):
        assert len(passes) <= 3


def test_not_certified():
    matrix, _ = symmetric(np.linspace(2.0, 1.9999, 300))
    with pytest.raises(RuntimeError, match="not certified"):
        m.eigenpairs(lambda b: matrix @ b, 300, 32, rounds=1)


def test_exact_deviations():
    centre = m.Centre(7, np.array([7 * 10 ** 6 + 3, 5]))
    x = np.array([[1 << 40, 0], [10 ** 6, 1]])
    want = [sum((7 * int(a) - int(s)) ** 2 for a, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x) == [v if v < 1 << 63 else None for v in want] and want[0] >= 1 << 63
    assert np.allclose(centre.centred(x), x - centre.sums / 7)
