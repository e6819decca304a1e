"""Operator 3 against brute force."""

import numpy as np
import pytest

import brute
from hirelake.llm import neighbours


def _exact(ids, x, k=20):
    """{query: [(vec_id, score)]}"""
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), score[i]) for i in order]
    return out


def _grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("block", [neighbours.BLOCK, 120])
def test_recall_on_given_vectors(spark, block):
    table = spark.read.parquet(f"{brute.SMALL}/embeddings.parquet")
    rows = table.collect()
    ids = np.array([r.vec_id for r in rows])
    want = _exact(ids, np.array([r.embedding for r in rows], dtype=float))
    got = _grouped(neighbours.nearest(table, block=block).collect())
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, near in got.items():
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)


def _table(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                 "vec_id long, embedding array<double>")


def _recall(got, x, asked):
    ids = np.arange(len(x))
    score = x @ x[asked].T
    score[asked, np.arange(len(asked))] = -np.inf
    best = np.argsort(-score, axis=0)[:20]
    return np.mean([len({i for i, _ in got[q]} & set(ids[best[:, j]].tolist())) / 20
                    for j, q in enumerate(asked)])


def _unit(n, dim=64):
    x = np.random.default_rng(7).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_recall_on_more_than_one_full_block(spark):
    x = _unit(2 * neighbours.BLOCK + 500)
    asked = np.arange(0, len(x), 400)
    got = _grouped(neighbours.nearest(_table(spark, x), every=400).collect())
    assert sorted(got) == asked.tolist()
    assert _recall(got, x, asked) >= 0.9


@pytest.mark.parametrize("n", [500, 9000, 16000])
def test_recall_on_vectors_of_unequal_norms(spark, n):
    """Long vectors are near to most queries, whatever their direction."""
    x = _unit(n) * np.exp(0.5 * np.random.default_rng(8).normal(size=n))[:, None]
    every = n // 50
    asked = np.arange(0, n, every)
    got = _grouped(neighbours.nearest(_table(spark, x), every=every).collect())
    assert _recall(got, x, asked) >= 0.95


@pytest.mark.parametrize("n", [100, 500, 2000, 3840, neighbours.BLOCK])
def test_one_rule_for_all_sizes(n):
    """Recall holds without scoring all; the share that is wanted falls evenly with the size."""
    x = _unit(n)
    asked = np.arange(0, n, max(1, n // 40))
    rule = lambda m: neighbours._wanted(20, neighbours.TREES, neighbours.SHARE, m)
    near = list(neighbours.Forest(x).candidates(x[asked], rule(n)))
    score = x @ x[asked].T
    score[asked, np.arange(len(asked))] = -np.inf
    best = np.argsort(-score, axis=0)[:20]
    assert np.mean([np.isin(best[:, j], c).mean() for j, c in enumerate(near)]) >= 0.9
    assert n < 500 or np.mean([len(c) for c in near]) < 0.95 * n
    part = [rule(m) / m for m in range(n, 2 * n, n // 20)]
    assert all(a > b for a, b in zip(part, part[1:]))


def test_different_vectors_of_one_id_all_count(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (1, [0.5, 0.25]),
            (1, [0.25, 0.5]), (2, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = sorted({(i, tuple(v)) for i, v in rows})
    want = sorted((20, rank, i, score) for own in kept if own[0] == 20
                  for rank, (score, i) in enumerate(
                      sorted(((np.dot(own[1], v), i) for i, v in kept if (i, v) != own),
                             key=lambda x: (-x[0], x[1])), 1))
    assert sorted(map(tuple, neighbours.nearest(table).collect())) == want


def test_odd_vectors(spark):
    """Nulls, zeros, infinities, copies, ties, repeated rows, other lengths."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 0.5]), (3, [0.5, 0.5]),
            (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (None, [1.0, 0.0]), (20, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (40, [0.0, -1.0]),
            (10, [2.0, 0.0])] + [(100 + i, [0.25, 0.0]) for i in range(1, 60) if i % 20]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                  "vec_id long, embedding array<float>, cid string, score int")
    sound = {i: np.array(v) for i, v in rows if i is not None and v and len(v) == 2
             and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = np.array(sorted(sound))
    want = _exact(ids, np.array([sound[i] for i in ids]))
    assert _grouped(neighbours.nearest(table).collect()) == want
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_forest_descends_to_the_longest_prefix():
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 16))
    forest = neighbours.Forest(x, trees=4)
    (near,) = forest.candidates(x[7:8], 1)
    assert 7 in near and len(near) < 40           # itself, and few others
    sizes = [len(next(forest.candidates(x[7:8], n))) for n in (1, 50, 200, 1600)]
    assert sizes == sorted(sizes) and sizes[-1] == 400
