"""Spanning forests against union-find, and groups at several thresholds against one run per threshold."""

import random

import numpy as np
import pytest

from assay.functions import forest as kernel
from assay.operators import evaluate
from assay.operators.forest import spanning_forest
from assay.operators.matching import MEMBER, match_records
from tests_shared import components_of
from workloads import parts


def best_forest(edges):
    """Kruskal, heaviest first, ties by the ends."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    taken = []
    for a, b, w in sorted(((min(a, b), max(a, b), w) for a, b, w in edges if a != b), key=lambda e: (-e[2], e[0], e[1])):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            taken.append((a, b, w))
    return sorted(taken)


def graph(seed, nodes, edges, weights):
    rng = random.Random(seed)
    return [(f"{rng.randrange(nodes):03d}", f"{rng.randrange(nodes):03d}", rng.randrange(weights) / weights) for _ in range(edges)]


@pytest.mark.parametrize("held", [500_000, 7])
@pytest.mark.parametrize("nodes, edges, weights", [(60, 200, 4), (200, 150, 1000), (5, 60, 2)])
def test_against_kruskal(spark, monkeypatch, nodes, edges, weights, held):
    monkeypatch.setattr(kernel, "HELD_ROWS", held)
    rows = graph(nodes, nodes, edges, weights)
    df = spark.createDataFrame(rows, "x string, y string, w double").repartition(5)
    got = sorted((r.a, r.b, r.weight) for r in spanning_forest(df, "x", "y", "w").collect())
    assert got == best_forest(rows)


def test_a_chain_and_no_edges(spark):
    chain = [(f"{i:03d}", f"{i + 1:03d}", (i * 37 % 100) / 100) for i in range(150)]
    df = spark.createDataFrame(chain, "x string, y string, w double").repartition(4)
    assert sorted(map(tuple, spanning_forest(df, "x", "y", "w").collect())) == best_forest(chain)
    assert spanning_forest(df.limit(0), "x", "y", "w").collect() == []


def test_a_task_drops_only_the_lightest_of_a_cycle():
    u, v = np.array([0, 1, 2, 3]), np.array([1, 2, 0, 4])
    assert kernel.heaviest(u, v, np.array([2, 0, 1, 3]), 5).tolist() == [False, True, True, True]


def test_components_at_every_limit(spark):
    rows = graph(9, 80, 160, 10)
    df = spark.createDataFrame(rows, "x string, y string, w double")
    forest = [tuple(r) for r in spanning_forest(df, "x", "y", "w").collect()]
    for limit in (0.0, 0.3, 0.75):
        assert components_of([(a, b) for a, b, w in forest if w >= limit]) == components_of([(a, b) for a, b, w in rows if w >= limit and a != b])


def test_groups_at_several_thresholds(spark):
    df = parts.parts(spark, "/root/testdata/sf0.001")
    matched = match_records(df, parts.SPEC)
    held = {}
    for r in matched.groups_at(list(parts.SWEEP)).collect():
        held.setdefault(r.threshold, {})[r[MEMBER]] = (r.golden_id, round(r.match_confidence, 9))
    for threshold in parts.SWEEP:
        alone = {r[MEMBER]: (r.golden_id, round(r.match_confidence, 9)) for r in matched.at(threshold).groups().collect()}
        assert held[threshold] == alone
    with pytest.raises(ValueError, match="not kept"):
        matched.groups_at([0.1, 0.7])


def test_one_search_however_many_thresholds(spark, monkeypatch):
    from assay.operators import matching

    calls = []
    plain = matching.connected_components
    monkeypatch.setattr(matching, "connected_components", lambda *a: calls.append(1) or plain(*a))
    df = parts.parts(spark, "/root/testdata/sf0.001")
    evaluate.threshold_sweep(match_records(df, parts.SPEC), (0.7, 0.75, 0.8, 0.85, 0.9), parts._truth(df)).collect()
    assert len(calls) == 1
