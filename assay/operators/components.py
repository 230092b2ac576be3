"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.contraction import contract
from assay.operators.skew import hot_limit, join_unique
from assay.session import cut
from assay.sources.bucketed import BucketedTable


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every node that has an edge; component is the smallest id in it.

    Alternates two star contractions (each node links its larger neighbours to its smallest one,
    then its smaller neighbours and itself likewise), which ends in about log(diameter) rounds.
    Every round is joins and aggregates over the edge list, cut in the shared checkpoint folder;
    no node or edge list ever reaches the driver. Before every shuffle each task replaces the
    edges it holds by stars, which alone settles every component that lies within one task.
    """
    oriented = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter(F.col("hi") != F.col("lo"))
    e = cut(oriented.mapInArrow(contract, oriented.schema))
    for _ in range(max_rounds):
        both_ways = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        nodes = cut(both_ways.groupBy("u").agg(F.min("v").alias("mn"), F.max("v").alias("mx"), F.count("*").alias("deg")))
        # a forest of finished stars: nobody has both a smaller neighbour and a second one
        open_node = (F.col("mn") < F.col("u")) & (F.col("mn") != F.col("mx"))
        state = nodes.agg(
            F.count(F.when(open_node, 1)).alias("open"),
            F.sum("deg").alias("total"),
            F.max("deg").alias("widest"),
        ).first()
        if not state["open"]:
            roots = nodes.filter(F.col("u") < F.col("mn")).select(F.col("u").alias("id"), F.col("u").alias("component"))
            leaves = nodes.filter(F.col("mn") < F.col("u")).select(F.col("u").alias("id"), F.col("mn").alias("component"))
            return roots.unionAll(leaves)
        limit = hot_limit(state["total"])
        hot = nodes.filter(F.col("deg") > limit).select("u") if state["widest"] > limit else None

        down = nodes.filter(F.col("mn") < F.col("u")).select(F.col("u").alias("lo"), "mn")
        large = join_unique(e, down, "lo", _renamed(hot, "lo"), how="left").select(
            "hi", F.coalesce("mn", "lo").alias("lo")
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        relinked = (
            join_unique(large, lowest, "hi", _renamed(hot, "hi"))
            .filter(F.col("lo") != F.col("m"))
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        linked = relinked.unionAll(lowest.select("hi", F.col("m").alias("lo"))).distinct()
        e = cut(linked.mapInArrow(contract, linked.schema))
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _renamed(hot: DataFrame | None, key: str) -> DataFrame | None:
    return None if hot is None else hot.select(F.col("u").alias(key))


def label_nodes(nodes: DataFrame, components: DataFrame, key: str = "id") -> DataFrame:
    """Component of every node; a node without an edge is its own component."""
    labels = components.select(F.col("id").alias(key), "component")
    return nodes.join(labels, on=key, how="left").withColumn("component", F.coalesce("component", key))


def extend_components(labels: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, old, component) of every node whose component changes by further edges; old is null for a new node.

    ``labels`` has (id, component), one row per node. Only the components that the edges touch are searched:
    each takes part as one node, its smallest id, so that of the merged ones is the smallest again.
    """
    known = labels.select("id", "component")
    real = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")

    def placed(rows: DataFrame, end: str) -> DataFrame:
        at = known.select(F.col("id").alias(end), F.col("component").alias(f"{end}_known"))
        return rows.join(at, on=end, how="left")

    ends = cut(placed(placed(real, "a"), "b"))
    between = ends.select(F.coalesce("a_known", "a").alias("a"), F.coalesce("b_known", "b").alias("b"))
    merged = cut(connected_components(between, "a", "b"))
    moved = merged.filter("id <> component").select(F.col("id").alias("old"), F.col("component").alias("new"))
    changed = known.withColumnRenamed("component", "old").join(moved, on="old").select("id", "old", F.col("new").alias("component"))
    new_ids = [ends.filter(F.col(f"{x}_known").isNull()).select(F.col(x).alias("id")) for x in "ab"]
    fresh = new_ids[0].unionAll(new_ids[1]).distinct().join(merged, on="id")
    return changed.unionByName(fresh.select("id", F.lit(None).cast(changed.schema["old"].dataType).alias("old"), "component"))


class ComponentTable:
    """Components kept as a table in buckets by component; new edges rewrite the buckets they change, no others."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.table = BucketedTable(spark, root, ["component"], buckets)

    def read(self) -> DataFrame:
        return self.table.read("id string, component string")

    def add(self, edges: DataFrame, a: str, b: str) -> int:
        """Take in further edges; returns how many nodes changed their component or are new."""
        labels = self.read()
        changed = cut(extend_components(labels, edges.select(F.col(a).cast("string"), F.col(b).cast("string")), a, b))
        both = changed.select(F.col("old").alias("component")).unionAll(changed.select("component")).dropna()
        touched = self.table.touched(both)
        if touched:
            kept = self.table.read("id string, component string", only=touched)
            rest = kept.join(changed.select("id"), on="id", how="left_anti")
            self.table.replace(rest.unionByName(changed.select("id", "component")), touched)
        return changed.count()
