"""Centroid clustering against a plain recomputation."""

import hashlib
import math
import random

import pytest

from logharrow.llm.clusters import LARGEST, kmeans

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance long, x int"


def plain(rows, clusters, rounds, seed, components, scale):
    kept = [(i, [math.floor(scale * float(v)) for v in e]) for i, e in rows if e is not None and len(e) == components and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[:clusters]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    near = lambda x: min((far(x, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        for k, xs in groups.items():
            centroids[k] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [(i, near(x)[1], near(x)[0]) for i, x in kept]
    inertia = [sum(d for _, k, d in found if k == c) for c in range(len(centroids))]
    return sorted(found, key=str), centroids, inertia


def table(spark, rows):
    return spark.createDataFrame([(i, e, "c", 1, 2) for i, e in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain(spark, rows, seed):
    r = random.Random(seed)
    data = [(i, [r.choice([-0.5, -0.001, 0.0, 0.25]) + r.random() * (seed - 1) for _ in range(4)]) for i in range(60)]
    data += [(7, data[7][1]), (7, [0.5, 0.5, 0.5, 0.5]), (None, [0.1, -0.1, 0.2, 0.3]), (90, None), (91, []), (92, [0.1] * 5), (93, [0.1, None, 0.2, 0.3]), (94, [float("nan")] * 4), (95, [0.0, 0.0, 0.0, float("inf")])]
    data = [(i, e and [None if v is None else float(v) for v in spark.createDataFrame([(e,)], "e array<float>").first()[0]]) if i in (7, 1) else (i, e) for i, e in data]
    stored = [(x.vec_id, x.embedding) for x in table(spark, data).collect()]  # as single floats
    got = kmeans(table(spark, data), clusters=3, rounds=4, seed=seed, components=4, scale=100)
    found, centroids, inertia = plain(stored, 3, 4, seed, 4, 100)
    assert rows(got.assigned) == found and got.centroids == centroids and got.inertia == inertia


def test_few_and_no_vectors(spark, rows):
    assert rows(kmeans(table(spark, []), components=4).assigned) == []
    got = kmeans(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), components=2)
    assert rows(got.assigned) == [(1, 0, 0), (2, 0, 0)] and len(got.centroids) == 2  # ties: the smaller number; empty ones stay


def test_too_large(spark):
    with pytest.raises(ValueError, match="64 bits"):
        kmeans(table(spark, [(1, [float(LARGEST), 0.0])]), components=2, scale=2)
