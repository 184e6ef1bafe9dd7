"""Whitening against numpy on the whole covariance, and its defined results for odd rows."""

from collections import defaultdict
from math import floor, inf, nan

import numpy as np
import pytest

from quillmill.llm import whitening


def frame(spark, rows):
    """With columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, x double, component string")


def check(spark, rows, block=None, k=16):
    got = defaultdict(list)
    df = whitening.whiten(frame(spark, rows), k, block)
    for r in df.collect():
        got[r["vec_id"]].append(r)
    kept = [(i, [floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * x - s) / n for x, s in zip(v, sums, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(k, int((values > 1e-12 * values[0]).sum()))
    assert {i for i, _ in kept} == set(got) and sum(map(len, got.values())) == count * len(kept)
    out = np.zeros((len(kept), count))
    for at, (i, x) in enumerate(kept):
        for r in got[i]:
            out[at, r["component"] - 1] = r["whitened"]
            assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            assert abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-8
    want = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in kept]) @ vectors[:, :count] / np.sqrt(values[:count])
    signs = np.sign((out * want).sum(0))
    assert np.abs(out - want * signs).max() < 1e-7
    return df


@pytest.mark.parametrize(("d", "block"), [(24, None), (40, 20), (3, None)])
def test_whitening_is_brute_force(spark, d, block):
    rng = np.random.default_rng(d)
    x = (rng.standard_normal((300, d)) @ np.diag(np.linspace(3, 0.5, d) ** 2)).tolist()
    rows = list(enumerate(x)) + [(1000 + i, x[5]) for i in range(150)] + [(2000, None), (2001, [nan] + [0.0] * (d - 1)), (2002, [None] + [0.0] * (d - 1)), (2003, [inf] + [0.0] * (d - 1))]
    check(spark, rows, block, min(16, 6 if block else 16))


def test_low_rank_and_large(spark):
    """Fewer components than asked for where the rank is lower; entries far from the others."""
    rng = np.random.default_rng(1)
    flat = rng.integers(-40, 40, (60, 2))
    check(spark, [(i, [a / 64, b / 64, a / 64, (a + b) / 64]) for i, (a, b) in enumerate(flat.tolist())])
    check(spark, [(i, [float(v) for v in r]) for i, r in enumerate(rng.standard_normal((50, 5)) * 1e4)])


def test_exact_beyond_a_long():
    x = np.array([[1 << 50, 1_000_000], [-5, 7]], np.int64)
    assert whitening.deviations(x, 3, [10, 11]) == [None, (3 * -5 - 10) ** 2 + (21 - 11) ** 2]


def test_odd_tables(spark):
    none = lambda rows: whitening.whiten(frame(spark, rows)).count()
    assert none([]) == 0 and none([(1, None)]) == 0 and none([(1, [])]) == 0
    assert none([(1, [0.5, 0.25])]) == 0 and none([(i, [0.5, 0.25]) for i in range(9)]) == 0
    rows = [(None, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.75]), (4, [1.0])]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == [(0, 1), (0, 2), (2, 1), (2, 1), (2, 2), (2, 2), (3, 1), (3, 2)]
    assert {r["n"] for r in out} == {3} and whitening.whiten(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 1.0])])).count() > 0
