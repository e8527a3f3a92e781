"""Whitening against numpy's own eigenvectors, on the test table and on hard small ones."""

import math

import numpy as np
import pytest

from tests.llm.conftest import SF
from varve.llm import whitening
from varve.llm.common import table
from varve.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n string, id int, code int"


def by_hand(rows, most):
    """(id, deviation, whitened up to sign, explained) of every usable row."""
    sizes = [len(v) for _, v in rows if v]
    size = max(sizes, key=lambda s: (sizes.count(s), s), default=0)
    usable = [
        (i, [math.floor(64 * c) + 1_000_000 for c in v])
        for i, v in rows
        if v and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]
    if not usable:
        return 0, []
    fit = sorted({tuple(v) for _, v in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in fit], float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    keep = np.flatnonzero(values > 1e-9 * max(values.max(), 1e-30))[::-1][:most]
    out = []
    for i, v in usable:
        apart = [n * c - s for c, s in zip(v, sums, strict=True)]
        made = (np.array(apart, float) / n) @ vectors[:, keep] / np.sqrt(values[keep])
        out.append((i, sum(a * a for a in apart), made, values[keep] / values.sum()))
    return n, out


def compare(df, rows, most):
    got = sorted(df.collect(), key=lambda r: (repr(r["vec_id"]), r["deviation"]))
    n, wanted = by_hand(rows, most)
    wanted.sort(key=lambda w: (repr(w[0]), w[1]))
    assert [(r["vec_id"], r["deviation"]) for r in got] == [w[:2] for w in wanted]
    signs = np.sign(np.array([r["whitened"] for r in got]) * np.array([w[2] for w in wanted]))
    for r, w in zip(got, wanted, strict=True):
        assert r["n"] == n
        assert np.allclose(np.abs(r["whitened"]), np.abs(w[2]), atol=1e-7)
        assert np.allclose(r["explained"], w[3], rtol=1e-9)
        assert r["identity_error"] < 1e-9
    for column in signs.T:  # one sign for all rows
        assert len(set(column[column != 0])) <= 1


def random_rows(n, size, seed):
    rng = np.random.default_rng(seed)
    spread = 0.2 + np.arange(size) / 3
    return [(i, [float(c) for c in rng.normal(1, 1, size) * spread]) for i in range(n)]


ROWS = random_rows(200, 5, 1)
HARD = [
    *ROWS,
    (900, None),
    (901, []),
    (902, [1.0, None, 1.0, 1.0, 1.0]),
    (903, [1.0, float("nan"), 1.0, 1.0, 1.0]),
    (904, [1.0, float("inf"), 1.0, 1.0, 1.0]),
    (905, [1.0, 2.0]),
    (None, ROWS[3][1]),
    ROWS[4],
    ROWS[4],
    (3, ROWS[9][1]),
    (906, [-300.0, 70000.0, -1.0, 0.0, 1.0]),  # a code of 4 bytes, then one of 2
    (907, [-300.0, 7.0, -1.0, 0.0, 1.0]),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(3)


def test_hard_rows(spark):
    compare(whitening.whiten(frame(spark, HARD), most=4), HARD, 4)


def test_fewer_dimensions_than_entries(spark):
    flat = [(i, [v[0], 2.0, v[0], v[1], 64 * v[1]]) for i, v in ROWS]
    flat = [(i, [c / 64 for c in map(round, v)]) for i, v in flat]
    got = whitening.whiten(frame(spark, flat), most=16)
    assert len(got.first()["whitened"]) == len(by_hand(flat, 16)[1][0][2]) <= 4
    compare(got, flat, 16)


def test_equal_vectors_have_no_component(spark):
    df = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    rows = df.collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in rows] == [(1, 0, []), (1, 0, [])]
    assert whitening.by_component(df).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None), (2, []), (3, [float("nan")])]])
def test_no_vector(spark, rows):
    got = whitening.whiten(frame(spark, rows))
    assert got.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [1e9 * i, float(i % 3)]) for i in range(40)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()}
    wanted = {i: d if d < 2**63 else None for i, d, *_ in by_hand(rows, 2)[1]}
    assert got == wanted and None in got.values()


def test_codes_are_unique_and_come_back():
    numbers = np.array([[0, 127], [-128, 5], [128, 0], [-129, 0], [1 << 40, -1], [40_000, 3], [-(1 << 31), 0]])
    codes = whitening._code(numbers)
    assert [c[0] for c in codes] == [1, 1, 2, 2, 8, 4, 4]
    assert (whitening._numbers(codes, 2) == numbers).all()


def test_factors_of_a_near_singular_matrix():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 12)) * 10.0 ** -np.arange(12)
    matrix = base @ base.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape[1] <= 12 and np.allclose(factor @ factor.T, matrix, atol=1e-13 * matrix.max())
    values, components = whitening.one_sided_jacobi(factor)
    assert np.allclose(components.T @ components, np.eye(len(values)), atol=1e-12)
    assert np.allclose(values[:7], np.linalg.eigvalsh(matrix)[::-1][:7], rtol=1e-10, atol=1e-14 * values[0])


def test_a_hot_vector_meets_in_each_task(spark):
    from tests.conftest import physical_plan

    codes = whitening.fit_list(frame(spark, ROWS), 5)
    plan = physical_plan(codes)
    assert plan.index("HashAggregate", plan.index("HashAggregate") + 1) < plan.index("MapInArrow")


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    df = QUERIES["op11_whitening"](spark, SF)
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, wanted = by_hand(rows, 16)
    got = {(r["vec_id"], r["component"]): r for r in df.collect()}
    assert len(got) == sum(len(w[2]) for w in wanted)
    for i, deviation, made, explained in wanted:
        for k, (value, share) in enumerate(zip(made, explained, strict=True), 1):
            r = got[i, k]
            assert (r["n"], r["deviation"]) == (n, deviation) and r["identity_error"] <= 1e-4
            assert abs(abs(r["whitened"]) - abs(value)) < 1e-6 and abs(r["explained"] - share) <= 1e-6 * share
