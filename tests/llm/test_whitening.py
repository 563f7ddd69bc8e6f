import math

import numpy as np
import pytest

from plumbline.llm.whitening import Inertia, leading, whiten


def matrices():
    r = np.random.default_rng(3)
    q, _ = np.linalg.qr(r.standard_normal((40, 40)))
    for name, values in {"spread": np.geomspace(1, 1e6, 40), "close": np.r_[np.ones(30), 1 + 1e-9, np.linspace(2, 3, 9)], "equal": np.ones(40), "flat": np.r_[np.zeros(35), 1, 2, 3, 4, 5]}.items():
        v = q @ np.diag(values) @ q.T
        yield name, (v + v.T) / 2
    yield "one", np.array([[3.0]])
    yield "zero", np.zeros((4, 4))


@pytest.mark.parametrize(("name", "v"), list(matrices()))
def test_leading_pairs_equal_a_dense_solver(name, v):
    values, vectors = leading(v, 32)
    want = np.linalg.eigvalsh(v)[::-1][:32]
    size = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-12 * size


def test_inertia_counts_eigenvalues():
    v = np.diag([1.0, 2.0, 2.0, 5.0]) + 0.1
    at = np.linalg.eigvalsh(v)
    assert Inertia(v).below([at[0] - 1e-9, at[0] + 1e-9, at[2] + 1e-9, at[3] + 1]).tolist() == [0, 1, 3, 4]


def brute(vectors, components=32):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    rest = (n * x - s).astype(float) / n
    values, axes = np.linalg.eigh(rest.T @ rest / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, [sum(int(d) ** 2 for d in n * row - s) for row in x], rest @ axes / np.sqrt(values), values / (rest**2).sum() * n


def test_equals_brute_force(spark):
    r = np.random.default_rng(0)
    vectors = (r.standard_normal((700, 40)) * np.linspace(1, 3, 40)).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(900, None), (901, [1.0] * 39 + [float("nan")]), (902, [1.0] * 39 + [None]), (903, [float("inf")] * 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    n, deviation, whitened, explained = brute(vectors)
    got = whiten(df).collect()
    assert len(got) == 700 * 32 and {x.n for x in got} == {n}
    mine = np.full((700, 32), np.nan)
    for x in got:
        mine[x.vec_id, x.component - 1] = x.whitened
        assert x.deviation == deviation[x.vec_id] and abs(x.explained - explained[x.component - 1]) < 1e-12
    sign = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine - whitened * sign).max() < 1e-9
    error = {x.identity_error for x in got}
    assert len(error) == 1 and abs(error.pop() - np.abs(np.cov(mine.T, ddof=0) - np.eye(32)).max()) < 1e-12


def test_odd_tables(spark):
    make = lambda rows, kind="array<float>": spark.createDataFrame(rows, f"vec_id long, n long, whitened string, embedding {kind}")
    assert whiten(make([])).count() == 0 and whiten(make([(1, 1, "a", None), (2, 2, "b", [])])).count() == 0
    # Equal rows, or one row, have no direction to whiten.
    for rows in ([(1, 1, "a", [1.0, 2.0])], [(1, 1, "a", [1.0, 2.0]), (1, 5, "b", [1.0, 2.0])]):
        got = whiten(make(rows)).collect()
        assert len(got) == 2 * len(rows) and all((x.whitened, x.explained, x.deviation, x.identity_error) == (None, 0.0, 0, 0.0) for x in got)
    # Two lengths are apart; null and repeated ids stay; the second direction of the first length is flat.
    rows = [(None, 0, "", [0.0, 1.0]), (7, 0, "", [2.0, 1.0]), (7, 0, "", [4.0, 1.0]), (8, 0, "", [1.0]), (9, 0, "", [-3.0])]
    got = sorted((str(x.vec_id), x.component, x.n, x.deviation, None if x.whitened is None else round(abs(x.whitened), 9)) for x in whiten(make(rows)).collect())
    far = round(1.5**0.5, 9)
    assert got == sorted([("None", 1, 3, 384**2, far), ("None", 2, 3, 384**2, None), ("7", 1, 3, 0, 0.0), ("7", 2, 3, 0, None), ("7", 1, 3, 384**2, far), ("7", 2, 3, 384**2, None), ("8", 1, 2, 256**2, 1.0), ("9", 1, 2, 256**2, 1.0)])


def test_large_values_do_not_wrap(spark):
    big = 2.0**46
    rows = [(i, [big * (i % 2), float(i)]) for i in range(6)] + [(9, [2.0**60, 0.0])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {x.vec_id for x in got} == set(range(6)) and all(x.deviation is None for x in got)
    assert {round(abs(x.whitened), 6) for x in got if x.component == 1} == {1.0}
