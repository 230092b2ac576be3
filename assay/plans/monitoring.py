"""Profile and drift metrics of a table, by slice and day; sketches that merge to other grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assay.session import cut

# Rank error of a sketched quantile is at most rows / QUANTILE_ACCURACY.
QUANTILE_ACCURACY = 10_000
QUANTILES = (0.25, 0.5, 0.75)


def profile(
    df: DataFrame, slices: list[str], ts: str, numeric: list[str], categorical: list[str], figures: str = "exact"
) -> DataFrame:
    """One row per slice, day and column: counts, nulls, distinct values, moments, range, quartiles.

    ``figures`` says how distinct values and quartiles are found, at every size alike: 'exact' counts each
    value (one more shuffle of the distinct values), 'approx' takes sketches within one aggregate.
    """
    if figures not in ("exact", "approx"):
        raise ValueError(f"figures must be exact or approx, not {figures}")
    exact = figures == "exact"
    counter = F.count_distinct if exact else F.approx_count_distinct
    names = [f"p{int(q * 100)}" for q in QUANTILES]

    def metrics(name: str, is_number: bool) -> Column:
        c = F.col(name)
        none = F.lit(None).cast("double")
        sketch = F.percentile_approx(c.cast("double"), list(QUANTILES), QUANTILE_ACCURACY)
        quartiles = [] if exact else [F.element_at(sketch, i + 1) if is_number else none for i in range(len(names))]
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count("*").alias("rows"),
            F.count(F.when(c.isNull(), 1)).alias("nulls"),
            counter(c).alias("distinct_values"),
            (F.avg(c.cast("double")) if is_number else none).alias("mean"),
            (F.stddev_samp(c.cast("double")) if is_number else none).alias("std"),
            (F.min(c.cast("double")) if is_number else none).alias("min"),
            (F.max(c.cast("double")) if is_number else none).alias("max"),
            *[q.alias(n) for q, n in zip(quartiles, names)],
        )

    wide = [metrics(c, True) for c in numeric] + [metrics(c, False) for c in categorical]
    keyed = df.withColumn("day", F.to_date(ts))
    found = keyed.groupBy(*slices, "day").agg(F.array(*wide).alias("_m")).select(*slices, "day", F.inline("_m"))
    if not exact:
        return found
    quartiles = _quartiles(keyed, [*slices, "day"], numeric, names) if numeric else None
    if quartiles is None:
        return found.select("*", *[F.lit(None).cast("double").alias(n) for n in names])
    same = [found[c].eqNullSafe(quartiles[c]) for c in (*slices, "day", "column_name")]
    return found.join(quartiles, same, "left").select(found["*"], *names)


def _quartiles(df: DataFrame, group: list[str], numeric: list[str], names: list[str]) -> DataFrame:
    """Smallest value of each numeric column with at least the asked share of the values at or below it.

    Selection over range partitions: distinct values are dealt out by slice, column and value, so a slice
    that holds all rows spreads over all tasks. Sums per partition say in which one each quantile lies;
    only the rows of those are counted up one by one.
    """
    key = [*group, "column_name"]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_value")) for c in numeric]
    values = df.select(*group, F.inline(F.array(*pairs))).filter(F.col("_value").isNotNull())
    counts = values.groupBy(*key, "_value").agg(F.count("*").alias("_n"))
    dealt = cut(counts.repartitionByRange(*key, "_value").withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy(*key, "_part").agg(F.sum("_n").alias("_held"))
    slice_ = W.partitionBy(*key)  # one row per partition
    placed = sums.withColumn("_upto", F.sum("_held").over(slice_.orderBy("_part"))).withColumn("_all", F.sum("_held").over(slice_))
    start = F.col("_upto") - F.col("_held")
    met = F.filter(
        F.array(*[F.lit(q) for q in QUANTILES]),
        lambda q: (start < F.col("_all") * q) & (F.col("_upto") >= F.col("_all") * q),
    )
    wanted = placed.select(*key, "_part", start.alias("_start"), "_all", met.alias("_met")).filter(F.size("_met") > 0)
    inside = dealt.alias("d").join(
        wanted.alias("w"), [F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*key, "_part")]
    ).select("d.*", "_start", "_all", "_met")
    upto = F.col("_start") + F.sum("_n").over(W.partitionBy(*key, "_part").orderBy("_value"))
    counted = inside.withColumn("_upto", upto)
    at = [
        F.min(F.when(F.array_contains("_met", F.lit(q)) & (F.col("_upto") >= F.col("_all") * F.lit(q)), F.col("_value")))
        for q in QUANTILES
    ]
    return counted.groupBy(*key).agg(*[a.alias(n) for a, n in zip(at, names)])


# Entries of a quantile sketch; its rank error is some half a percent of the rows, at any number of merges.
KLL_ENTRIES = 1_000
# Base-2 logarithm of the counters of a distinct-value sketch; its relative error is some 1 / 2 ** (HLL_BITS / 2).
HLL_BITS = 14


def sketch_profile(df: DataFrame, slices: list[str], ts: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    """One row per slice, day and column with counts, moments and two sketches, to be stored and merged later.

    ``moments`` has the number, mean and sum of squared deviations of the values, ``quantiles`` a KLL and
    ``distinct`` an HLL sketch. One aggregate with map-side combine; nothing is kept per value.
    """

    def metrics(name: str, is_number: bool) -> Column:
        c = F.col(name)
        number = c.cast("double") if is_number else F.lit(None).cast("double")
        mean = F.avg(number)
        n = F.count(number)
        moments = F.struct(n.alias("n"), F.coalesce(mean, F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(number) * n, F.lit(0.0)).alias("m2"))
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count("*").alias("rows"),
            F.count(F.when(c.isNull(), 1)).alias("nulls"),
            moments.alias("moments"),
            F.min(number).alias("min"),
            F.max(number).alias("max"),
            (F.kll_sketch_agg_double(number, KLL_ENTRIES) if is_number else F.lit(None).cast("binary")).alias("quantiles"),
            F.hll_sketch_agg(c.cast("string"), HLL_BITS).alias("distinct"),
        )

    wide = [metrics(c, True) for c in numeric] + [metrics(c, False) for c in categorical]
    keyed = df.withColumn("day", F.to_date(ts))
    return keyed.groupBy(*slices, "day").agg(F.array(*wide).alias("_m")).select(*slices, "day", F.inline("_m"))


def merge_sketches(daily: DataFrame, slices: list[str], grain: str = "week") -> DataFrame:
    """Stored daily sketches merged to another grain (any unit of date_trunc) or to fewer slices; no data are read.

    The column ``day`` becomes the first day of each period.
    """
    period = F.trunc("day", grain).alias("day")
    merged = daily.groupBy(*slices, period, "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.collect_list("moments").alias("_moments"),  # one small struct per day and slice merged
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )

    def add(s: Column, m: Column) -> Column:
        n = s["n"] + m["n"]
        apart = m["mean"] - s["mean"]
        share = F.when(n > 0, m["n"] / n).otherwise(F.lit(0.0))
        return F.struct(
            n.alias("n"),
            (s["mean"] + apart * share).alias("mean"),
            (s["m2"] + m["m2"] + apart * apart * s["n"] * share).alias("m2"),
        )

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    # in one order, so that sums of fractions come out alike every time
    moments = F.aggregate(F.array_sort("_moments"), none, add)
    columns = ("column_name", "rows", "nulls", "moments", "min", "max", "quantiles", "distinct")
    return merged.withColumn("moments", moments).select(*slices, "day", *columns)


def sketched_figures(sketches: DataFrame, slices: list[str]) -> DataFrame:
    """The columns of ``profile(..., figures='approx')`` from sketches of any grain."""
    m, n = F.col("moments"), F.col("moments.n")
    quartiles = [
        F.when(n > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(f"p{int(q * 100)}") for q in QUANTILES
    ]
    return sketches.select(
        *slices,
        "day",
        "column_name",
        "rows",
        "nulls",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(n > 0, m["mean"]).alias("mean"),
        F.when(n > 1, F.sqrt(m["m2"] / (n - 1))).alias("std"),
        "min",
        "max",
        *quartiles,
    )


def drift(profiled: DataFrame, slices: list[str]) -> DataFrame:
    """Change of every profile row against the previous day of the same slice and column.

    Runs over profile rows (one per slice, day and column), not over the data.
    """
    earlier = W.partitionBy(*slices, "column_name").orderBy("day")
    previous = {c: F.lag(c).over(earlier) for c in ("day", "rows", "nulls", "mean")}
    p = profiled.withColumns({f"_{c}": v for c, v in previous.items()}).filter(F.col("_day").isNotNull())
    return p.select(
        *slices,
        "day",
        F.col("_day").alias("previous_day"),
        "column_name",
        (F.col("rows") - F.col("_rows")).alias("rows_delta"),
        (F.col("nulls") / F.col("rows") - F.col("_nulls") / F.col("_rows")).alias("null_rate_delta"),
        (F.col("mean") - F.col("_mean")).alias("mean_delta"),
    )


def distribution_drift(df: DataFrame, column: str, ts: str, smoothing: float = 1e-6) -> DataFrame:
    """Total variation and population stability index of a column, day against previous day.

    Values are counted per day first. Each count then speaks for its own day and as the previous
    of the next day, so both shares meet in one aggregate without a join on the values.
    """
    counts = df.groupBy(F.to_date(ts).alias("day"), F.col(column).alias("value")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("day").agg(F.sum("n").alias("total"))
    by_day = W.orderBy("day")  # one row per day
    days = totals.select(
        "day", "total", F.lag("day").over(by_day).alias("previous_day"), F.lead("day").over(by_day).alias("next_day")
    )
    share = counts.join(days, on="day").withColumn("share", F.col("n") / F.col("total"))
    own = share.filter(F.col("previous_day").isNotNull()).select(
        "day", "value", F.col("share").alias("p"), F.lit(0.0).alias("q")
    )
    old = share.filter(F.col("next_day").isNotNull()).select(
        F.col("next_day").alias("day"), "value", F.lit(0.0).alias("p"), F.col("share").alias("q")
    )
    both = own.unionAll(old).groupBy("day", "value").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    p, q = F.col("p") + F.lit(smoothing), F.col("q") + F.lit(smoothing)
    return both.groupBy("day").agg(
        F.count("*").alias("values"),
        (F.sum(F.abs(F.col("p") - F.col("q"))) / 2).alias("total_variation"),
        F.sum((p - q) * F.log(p / q)).alias("psi"),
    )
