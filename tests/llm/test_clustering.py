"""Bounds against a plain loop over every distance, in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from assay.llm import clustering
from assay.llm.common import Scratch

SCHEMA = "vec_id long, v array<float>, cluster int, distance int, units int, _id int, stood int, seen int, measured int"


def plain_lloyd(rows, dims, k, rounds, scale, seed):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centers = [u for _, u in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(u):
        return min((sum((a - b) ** 2 for a, b in zip(u, c, strict=True)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        own = [nearest(u)[1] for _, u in kept]
        for j in set(own):
            members = [u for (_, u), o in zip(kept, own, strict=True) if o == j]
            centers[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    last = [(i, *reversed(nearest(u))) for i, u in kept]
    inertia = [sum(d for _, j, d in last if j == c) for c in range(len(centers))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, d, inertia[j], sum(inertia), sha[j]) for i, j, d in last), key=str)


def run(spark, rows, dims, k, rounds, scale=8, seed=3):
    df = spark.createDataFrame([(i, v, *[1] * 7) for i, v in rows], SCHEMA).repartition(4)
    scratch = Scratch(spark, "test-clustering")
    found = clustering.cluster(df, "vec_id", "v", dims, k, rounds, scale, seed, scratch)
    table = clustering.report(found, "vec_id")
    return sorted((tuple(r) for r in table.collect()), key=str), found


def blobs(source, n, dims, spread):
    centers = [[source.uniform(-9, 9) for _ in range(dims)] for _ in range(5)]
    return [(i, [x + source.gauss(0, spread) for x in source.choice(centers)]) for i in range(n)]


@pytest.mark.parametrize("k, rounds, spread", [(1, 2, 1.0), (4, 3, 0.2), (9, 6, 2.0), (6, 0, 1.0)])
def test_against_plain_lloyd(spark, k, rounds, spread):
    rows = blobs(random.Random(k), 300, 3, spread)
    got, _ = run(spark, rows, 3, k, rounds)
    assert got == plain_lloyd(rows, 3, k, rounds, 8, 3)


def test_ties_repeats_and_odd_vectors(spark):
    grid = [(i, [float(i % 3), float(i % 2)]) for i in range(40)]
    odd = [(100, None), (101, [1.0]), (102, [1.0, None]), (103, [1.0, math.nan]), (104, [math.inf, 1.0]), (105, [])]
    rows = grid + odd + [(7, [-0.4, -0.001])] * 3 + [(None, [2.0, 2.0]), (None, [1.0, 1.0])]
    for k in (2, 7, 60):
        got, _ = run(spark, rows, 2, k, 4, scale=2)
        assert got == plain_lloyd(rows, 2, k, 4, 2, 3)
    got, found = run(spark, [(1, [1e30, -1e30])], 2, 3, 1)
    assert len(got) == 1 and found.centroids.tolist() == [[clustering.LARGEST, -clustering.LARGEST]]


def test_no_vector(spark):
    got, found = run(spark, [(1, None)], 2, 3, 2)
    assert got == [] and len(found.centroids) == 0


def test_bounds_spare_distances(spark):
    rows = blobs(random.Random(2), 600, 4, 0.3)
    got, found = run(spark, rows, 4, 8, 5, scale=64)
    assert got == plain_lloyd(rows, 4, 8, 5, 64, 3)
    assert found.measured[0] == 600 * 8
    assert sum(found.measured[2:5]) < 600 * 8  # three later rounds together


def test_total_displacement_is_what_loosens():
    there_and_back = [np.array([[0, 0]]), np.array([[30, 40]]), np.array([[0, 0]])]
    assert clustering.drifts(there_and_back).tolist() == [[0.0], [50.0], [0.0]]
