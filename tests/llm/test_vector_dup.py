"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from rxsieve.llm import vector_dup as v
from rxsieve.llm.vector_dup import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """{row: (n_links, component)} by all pairs; rows are (vec_id, vector)."""
    good = [k for k, (_, x) in enumerate(rows) if x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links = {k: set() for k in range(len(rows))}
    for i in good:
        for j in good:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                    links[i].add(j)
                    links[j].add(i)
    out = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        out[k] = (len(links[k]), min((rows[x][0] for x in seen if rows[x][0] is not None), default=None))
    return out


def got(spark, rows, **how):
    frame = near_vectors(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA), **how)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect()), key=repr)


def expected(rows):
    return sorted(((rows[k][0], n, c, c is None or rows[k][0] == c) for k, (n, c) in brute(rows).items()), key=repr)


def clusters(seed, groups, size, noise, length=64):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, length))
    rows = np.repeat(centres, size, 0) + noise * draw.normal(size=(groups * size, length))
    return [(i, x.tolist()) for i, x in zip(draw.permutation(len(rows)).tolist(), rows, strict=True)]


@pytest.mark.parametrize("noise", [0.05, 0.15])
def test_equals_all_pairs(spark, noise):
    rows = clusters(1, 12, 9, noise) + [(200 + k, x) for k, (_, x) in enumerate(clusters(2, 40, 1, 1))]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [2 * c for c in rows[0][1]])]
    assert got(spark, rows) == expected(rows)


def test_blocks(spark):
    """Buckets far larger than a task takes."""
    rows = clusters(3, 2, 60, 0.1)
    assert got(spark, rows, bucket=10) == expected(rows)


def test_recall_at_the_threshold(spark):
    """Pairs of a cosine just above 0.9, among vectors that fill the space."""
    draw = np.random.default_rng(4)
    one = draw.normal(size=(1500, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = draw.normal(size=one.shape)
    side -= (side * one).sum(1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    other = 0.9001 * one + np.sqrt(1 - 0.9001**2) * side
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate([one, other]))]
    found = {r[0]: r[2] for r in got(spark, rows)}
    assert np.mean([found[i + 1500] == i for i in range(1500)]) > 0.99


@pytest.mark.parametrize("count", [100, 50_000, 10**8])
def test_tables_follow_the_size(count):
    width, probes, tables = v.layout(count, 64)
    draw = np.random.default_rng(9)
    one = draw.normal(size=(800, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = draw.normal(size=one.shape)
    side -= (side * one).sum(1, keepdims=True) * one
    other = 0.9 * one + np.sqrt(0.19) * side / np.linalg.norm(side, axis=1, keepdims=True)
    met = np.any([v._meet(v.table_keys(one, t, width, probes), v.table_keys(other, t, width, probes)) for t in range(tables)], 0)
    assert met.mean() > 0.985
    near = np.bitwise_count(v.sketches(one) ^ v.sketches(other)) <= v.MOST_BITS
    assert near.mean() > 0.99


def test_rotation_keeps_angles():
    rows = np.random.default_rng(0).normal(size=(20, 32))
    assert np.allclose(v.rotated(rows, 3) @ v.rotated(rows, 3).T, rows @ rows.T)


def test_odd_rows(spark):
    assert got(spark, []) == []
    same = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, same), (7, same), (8, [-1.0, -2.0, -3.0]),
        (None, same), (None, [5.0]), (None, None), (9, [1e30, 2e30, 3e30]), (10, [1e-30, 2e-30, 3e-30]), (11, [3.0]), (12, [-0.0, 1.0]), (13, [0.0, 1.0]), (14, [1.0, 1.0]),
    ]
    wanted = [(i, x) for i, x in rows]
    assert got(spark, rows) == expected(wanted)


def test_clashing_columns(spark):
    rows = clusters(6, 3, 4, 0.1, 16)
    frame = spark.createDataFrame([(i, x, 1, "x", 2.0) for i, x in rows], "vec_id long, embedding array<double>, key int, id string, vector double")
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(frame).collect()), key=repr) == expected(rows)
