"""Whitening against numpy over all rows."""

import math

import numpy as np
import pytest

from rxsieve.llm import whitening
from rxsieve.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Kept ids, deviations, whitened rows, shares."""
    kept = [(i, x) for i, x in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    longest = max((len(x) for _, x in kept), default=0)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (longest - len(v)) for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(32, int((values > 1e-10 * values[0]).sum()))
    return [i for i, _ in kept], deviation, centred @ vectors[:, :count] / np.sqrt(values[:count]), values[:count] / values.sum()


def check(spark, rows):
    ids, deviation, expected, shares = brute(rows)
    found = whitened(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)).collect()
    assert len(found) == expected.size
    place = {i: k for k, i in enumerate(ids)}
    got = np.zeros_like(expected)
    for r in found:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(ids) and r.deviation == deviation[place[r.vec_id]]
        assert abs(r.explained - shares[r.component - 1]) <= 1e-6 * shares[r.component - 1]
        assert r.identity_error < 1e-6
    signs = np.sign((got * expected).sum(0))
    assert np.allclose(got, expected * signs, atol=1e-7)


def test_equals_numpy(spark):
    draw = np.random.default_rng(0)
    rows = [(i, (x * np.linspace(1, 4, 40)).tolist()) for i, x in enumerate(draw.normal(size=(300, 40)))]
    check(spark, [*rows, (1000, None), (1001, [1.0, None]), (1002, [math.nan] * 40), (1003, [math.inf])])


def test_many_blocks(spark, monkeypatch):
    """Blocks of two rows, three of which are multiplied in a task."""
    monkeypatch.setattr(whitening, "NUMBERS", 12)
    monkeypatch.setattr(whitening, "TOGETHER", 3)
    draw = np.random.default_rng(1)
    check(spark, [(i, x.tolist()) for i, x in enumerate(draw.normal(size=(60, 6)) * [1, 2, 3, 4, 5, 6])])


def test_shorter_and_large(spark):
    draw = np.random.default_rng(2)
    rows = [(i, x.tolist()) for i, x in enumerate(draw.normal(size=(30, 4)) * [1, 2, 3, 4])]
    check(spark, [*rows, (100, [1.0]), (101, [5.0, 5.0]), (102, [])])
    check(spark, [*rows, (103, [3e5, 0.0, 1.0, 2.0])])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]])
def test_nothing_to_project(spark, rows):
    frame = whitened(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA))
    assert frame.collect() == [] and frame.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_extremes_and_repeats(spark):
    """Beyond what a long holds the deviation is NULL; rows alike and without an id are rows of their own; names clash."""
    rows = [(None, [1e30, -1.0], 1, 2.0), (None, [-1e30, 1.0], 1, 2.0), (3, [0.0, 5.0], 1, 2.0), (3, [0.0, 5.0], 1, 2.0)]
    frame = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>, index int, x double")).collect()
    assert len(frame) == 4 * len({r.component for r in frame}) and {r.n for r in frame} == {4}
    assert {r.deviation is None for r in frame if r.vec_id is None} == {True}
