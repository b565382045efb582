"""Approximate search: exact distances, recall against brute force, hot vectors, odd rows."""

import math

import numpy as np
import pytest

from layerforge.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, dim int, slot int, q long"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + k, v, 1, 2, 3) for k, v in enumerate(vectors)], SCHEMA)


def exact(rows, queries, k):
    """By id: the k nearest of the other ids, as (rank, id, distance)."""
    out = {}
    for i, v in queries:
        best = out.setdefault(i, {})
        for j, u in rows:
            if j != i and len(u) == len(v):
                d = float(np.sqrt(((np.asarray(u, np.float64) - np.asarray(v, np.float64)) ** 2).sum()))
                best[j] = min(best.get(j, math.inf), d)
    return {i: [(r, j, d) for r, (j, d) in enumerate(sorted(b.items(), key=lambda x: (x[1], x[0]))[:k], 1)] for i, b in out.items() if b}


def results(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


def sound(df):
    return [(r["id"], r["vector"]) for r in neighbours.usable(df).collect()]


def search(df, every=3, **options):
    v = neighbours.usable(df)
    return results(neighbours.search(v, v.where(f"id % {every} = 0"), **options))


def test_whole_polytope_is_exact(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [*rng.normal(size=(60, 6)).tolist(), [1.0] * 6, [1.0] * 6, [2.0] * 6])
    rows = sound(df)
    # 3 tables of 16 axes: every bucket is probed.
    got = search(df, probes=48, tables=3, k=4)
    assert got == exact(rows, [r for r in rows if r[0] % 3 == 0], 4)


def test_two_axes_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(2)
    df = frame(spark, rng.normal(size=(80, 3)).tolist())
    rows = sound(df)
    got = search(df, axes=2, tables=2, probes=2 * 64, k=5)
    assert got == exact(rows, [r for r in rows if r[0] % 3 == 0], 5)


def test_recall_and_true_distances(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = sound(df)
    want = exact(rows, [r for r in rows if r[0] % 10 == 0], 10)
    got = search(df, every=10)
    true = {(i, j): d for i, v in rows if i % 10 == 0 for j, d in ((j, float(np.sqrt(((np.asarray(u) - np.asarray(v)) ** 2).sum()))) for j, u in rows)}
    assert all(d == true[i, j] for i, near in got.items() for _, j, d in near)
    hits = sum(len({j for _, j, _ in want[i]} & {j for _, j, _ in got[i]}) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all([r for r, _, _ in near] == list(range(1, 11)) for near in got.values())


def test_a_third_of_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    df = frame(spark, [v if k % 3 else [1.0, 2.0, 3.0, 4.0] for k, v in enumerate(rng.normal(size=(150, 4)).tolist())])
    rows = sound(df)
    got = search(df, every=6, k=10)
    want = exact(rows, [r for r in rows if r[0] % 6 == 0], 10)
    assert {i: got[i] for i in want if i % 3 == 0} == {i: want[i] for i in want if i % 3 == 0}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0], 1, 1, 1),
        (0, [1.0, 0.0, 0.0], 1, 1, 1),
        (3, [0.0, 1.0, 0.0], 1, 1, 1),
        (3, [0.9, 0.1, 0.0], 1, 1, 1),
        (4, [1.0, 0.0], 1, 1, 1),
        (5, None, 1, 1, 1),
        (6, [0.0, 0.0, 0.0], None, 1, 1),
        (9, [nan, 1.0, 0.0], 1, 1, 1),
        (12, [inf, 1.0, 0.0], 1, 1, 1),
        (15, [None, 1.0, 0.0], 1, 1, 1),
        (18, [], 1, 1, 1),
        (None, [1.0, 0.0, 0.0], 1, 1, 1),
        (21, [3e38, 1e-30, 0.0], 1, None, None),
        (24, [7.0], 1, 1, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    usable = sound(df)
    assert sorted({i for i, _ in usable}) == [0, 3, 4, 21, 24]
    got = search(df, probes=1000)
    assert got == exact(usable, [r for r in usable if r[0] % 3 == 0], 10)
    assert 24 not in got
    assert search(df.where("vec_id = 5")) == {} and search(df.limit(0)) == {}


def test_recall_counts_pairs(spark):
    a = spark.createDataFrame([(0, 1), (0, 2)], "query_id long, vec_id long")
    assert neighbours.recall(a.where("vec_id = 1"), a) == 0.5
    assert neighbours.recall(a, a.limit(0)) == 1.0


@pytest.mark.parametrize("width", [1, 2, 8, 64])
def test_rotation_keeps_lengths(width):
    x = np.random.default_rng(4).normal(size=(5, width))
    assert np.allclose(np.linalg.norm(neighbours._rotated(x, 0, 0), axis=1), 1)
    assert not width > 2 or not np.allclose(neighbours._rotated(x, 0, 0), neighbours._rotated(x, 1, 0))
