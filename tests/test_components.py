import random

import pyarrow as pa

from assay.functions import contraction, forest
from assay.operators import components, skew
from assay.operators.components import connected_components, label_nodes


def run(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    return {r.id: r.component for r in connected_components(df, "a", "b").collect()}


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def n(i):
    return f"{i:05d}"


def test_chain_of_200_in_shuffled_order(spark):
    edges = [(n(i), n(i + 1)) for i in range(200)]
    random.Random(3).shuffle(edges)
    got = run(spark, edges)
    assert len(got) == 201 and set(got.values()) == {n(0)}


def test_star_cliques_duplicates_and_self_loops(spark):
    star = [(n(500), n(i)) for i in range(20)]
    left = [(n(i), n(j)) for i in range(100, 106) for j in range(100, 106)]
    right = [(n(i), n(j)) for i in range(110, 116) for j in range(i + 1, 116)]
    edges = star + left + right + [(n(105), n(110))] + star[:5] + [(n(900), n(901)), (n(901), n(900))]
    got = run(spark, edges)
    assert got == brute([(a, b) for a, b in edges if a != b])


def test_no_edges(spark):
    assert run(spark, []) == {}
    assert run(spark, [("a", "a")]) == {}


def test_random_graphs_match_union_find_in_any_order(spark):
    rng = random.Random(11)
    edges = [(n(rng.randrange(400)), n(rng.randrange(400))) for _ in range(330)]
    edges = [(a, b) for a, b in edges if a != b]
    want = brute(edges)
    assert run(spark, edges) == want
    rng.shuffle(edges)
    assert run(spark, [(b, a) for a, b in edges]) == want


def test_hot_nodes_take_the_broadcast_branch(spark, monkeypatch):
    monkeypatch.setattr(components, "hot_limit", lambda total: 10)
    rng = random.Random(5)
    edges = [(n(0), n(i)) for i in range(1, 80)] + [(n(999), n(i)) for i in range(70, 150)]
    edges += [(n(rng.randrange(200, 300)), n(rng.randrange(200, 300))) for _ in range(90)]
    edges = [(a, b) for a, b in edges if a != b]
    assert run(spark, edges) == brute(edges)


def test_isolated_nodes_keep_their_own_label(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    labels = connected_components(spark.createDataFrame([("b", "a")], "x string, y string"), "x", "y")
    assert {r.id: r.component for r in label_nodes(nodes, labels).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_join_unique_gives_the_same_rows_with_and_without_hot_keys(spark):
    left = spark.createDataFrame([("h", i) for i in range(50)] + [("c", 1), ("x", 2)], "k string, v int")
    right = spark.createDataFrame([("h", 10), ("c", 20)], "k string, w int")
    hot = spark.createDataFrame([("h",)], "k string")
    for how in ("inner", "left"):
        plain = sorted(map(str, skew.join_unique(left, right, "k", None, how).collect()))
        split = sorted(map(str, skew.join_unique(left, right, "k", hot, how).collect()))
        assert plain == split


def test_a_task_keeps_edges_as_numbers(monkeypatch):
    """Texts of edges never become objects of Python, which took several times their bytes."""
    made = []
    unique = contraction.np.unique
    monkeypatch.setattr(contraction.np, "unique", lambda x, **options: made.append(x.dtype) or unique(x, **options))
    rng = random.Random(7)
    edges = [(n(rng.randrange(300)), n(rng.randrange(300, 400))) for _ in range(250)]
    batch = pa.RecordBatch.from_pydict({"hi": [b for _, b in edges], "lo": [a for a, _ in edges]})
    for rows in (7, 10_000):
        monkeypatch.setattr(contraction, "HELD_ROWS", rows)
        parts = [batch.slice(i, 5) for i in range(0, 250, 5)]
        out = [(r["hi"], r["lo"]) for part in contraction.contract(iter(parts)) for r in part.to_pylist()]
        assert brute(out) == brute(edges)
    assert not any(kind == object for kind in made)


def test_forest_reads_equal_texts_of_many_chunks(monkeypatch):
    monkeypatch.setattr(forest, "HELD_ROWS", 10)
    rows = {"u": list("abcab"), "v": list("bcdca"), "a": list("abcab"), "b": list("bcdcc"), "weight": [0.9, 0.8, 0.7, 0.6, 0.5]}
    batch = pa.RecordBatch.from_pydict(rows)
    taken = [r["weight"] for part in forest.forest_of(iter([batch.slice(0, 2), batch.slice(2, 3)])) for r in part.to_pylist()]
    assert taken == [0.9, 0.8, 0.7]
