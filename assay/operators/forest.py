"""Maximum spanning forest of a distributed edge list: components at every threshold from one search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.forest import forest_of
from assay.operators.components import connected_components
from assay.operators.skew import hot_limit, join_unique
from assay.session import cut


def spanning_forest(edges: DataFrame, a: str, b: str, weight: str, max_rounds: int = 40) -> DataFrame:
    """(a, b, weight): fewer edges than nodes, with the same components at every lower limit of the weight.

    Boruvka rounds: every component takes its heaviest edge outwards (ties by the ends, so an order without
    ties), what is joined becomes one component, and of parallel edges the heaviest stays. The number of
    components halves each round at least. Before every shuffle a task drops the edges that lie on a
    cycle of heavier ones it holds. No edge list reaches the driver.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    kind = edges.select(lo.alias("a"), hi.alias("b"), F.col(weight).cast("double").alias("weight"))
    single = kind.filter("a < b").groupBy("a", "b").agg(F.max("weight").alias("weight"))
    e = single.select(F.col("a").alias("u"), F.col("b").alias("v"), "a", "b", "weight")
    e = cut(e.mapInArrow(forest_of, e.schema))
    found = []
    for _ in range(max_rounds):
        choice = F.struct((-F.col("weight")).alias("w"), "a", "b", "u", "v")
        ends = e.select(F.col("u").alias("c"), choice.alias("o")).unionAll(e.select(F.col("v").alias("c"), choice.alias("o")))
        best = cut(ends.groupBy("c").agg(F.min("o").alias("o"), F.count("*").alias("n")))
        state = best.agg(F.sum("n").alias("total"), F.max("n").alias("widest")).first()
        if not state["total"]:
            none = e.select("a", "b", "weight").limit(0)
            return reduce(DataFrame.unionAll, found) if found else none
        limit = hot_limit(state["total"])
        hot = best.filter(F.col("n") > limit).select("c") if state["widest"] > limit else None
        chosen = cut(best.select("o.*").distinct())
        found.append(chosen.select("a", "b", (-F.col("w")).alias("weight")))
        labels = cut(connected_components(chosen, "u", "v"))

        def relabelled(rows: DataFrame, column: str) -> DataFrame:
            new = labels.select(F.col("id").alias(column), F.col("component").alias(f"{column}_new"))
            crowded = None if hot is None else hot.select(F.col("c").alias(column))
            return join_unique(rows, new, column, crowded).drop(column).withColumnRenamed(f"{column}_new", column)

        moved = relabelled(relabelled(e, "u"), "v").filter("u <> v")
        between = moved.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(
            F.min(F.struct((-F.col("weight")).alias("w"), "a", "b")).alias("o")
        )
        rest = between.select("u", "v", "o.a", "o.b", (-F.col("o.w")).alias("weight"))
        e = cut(rest.mapInArrow(forest_of, rest.schema))
    raise RuntimeError(f"the forest did not close within {max_rounds} rounds")
