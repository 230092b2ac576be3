"""Centroid clustering: exact Lloyd rounds over integer vectors with bounds by the norm of the sum (ns-bounds).

Every vector keeps, for each centroid, the distance at which it last stood and the round in which that
was measured. The history of all centroids is retained, so a stored distance is loosened by how far
the centroid is now from where it was then, the norm of its total displacement, and not by the sum of
what it moved per round, which is never smaller. A centroid whose lower bound stays above the upper
bound of the assigned one cannot be nearer; all others are measured again, exactly, in integers.

A round is one pass without a shuffle that carries vectors and bounds along in a table, and one
aggregate with map-side combine of the component sums, of which the driver gets one row per centroid.
Centroids and their history (rounds x centroids x components) are what tasks are sent.

Edge cases: vectors that are null, of another length, or hold a null, NaN or infinite component are
left out; components beyond +-2**27 units count as that, as squared distances are 64-bit numbers;
repeated rows are vectors of their own, also as first centroids; without an id a vector's hash is that
of an empty id; fewer vectors than centroids give as many centroids as there are vectors; no vector
gives no row.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Components that squared distances of 64 of them still fit 64 bits with.
LARGEST = 1 << 27
# What rounding may add to a bound, relative to it.
SLACK = 1e-9
# Vectors handled at a time by a task.
BLOCK = 4_096


@dataclass
class Clustering:
    # (id, cluster, distance) of every vector kept.
    assigned: DataFrame
    # Centroids that the vectors were assigned to, one row each.
    centroids: np.ndarray
    # Vectors and sum of squared distances of every cluster.
    sizes: list[int]
    inertia: list[int]
    # Distances measured in every pass, of vectors x centroids that could be.
    measured: list[int]


def grid(vector: str, dims: int, scale: int) -> Column:
    """floor(scale * x) of every component as long, null if the vector does not have ``dims`` finite components."""
    v = F.col(vector)
    fits = F.size(v) == dims
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    units = F.transform(
        v, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST))))
    )
    return F.when(v.isNotNull() & fits & usable, units.cast("array<bigint>"))


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """Vectors with the smallest sha256 of seed:id, in that order; only these k reach the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    taken = points.select(digest.alias("digest"), "units").orderBy("digest", "units").limit(k).collect()
    return np.array([r["units"] for r in taken], np.int64)


def drifts(history: list[np.ndarray]) -> np.ndarray:
    """[t, j]: distance between where centroid j is now and where it was in round t."""
    moved = np.stack(history).astype(float) - history[-1]
    return np.sqrt((moved * moved).sum(axis=2))


def reassign(
    x: np.ndarray, cluster: np.ndarray, stood: np.ndarray, seen: np.ndarray, now: np.ndarray, drift: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the smaller number on ties) of every row of ``x``, exactly.

    ``stood`` holds the distances last measured and ``seen`` the rounds they are of, -1 for never; both
    are brought up to date. Returns the clusters, squared distances (-1 where bounds were enough to
    keep the cluster) and how many distances were measured.
    """
    rows, t = np.arange(len(x)), len(drift) - 1
    squared = np.full(stood.shape, np.iinfo(np.int64).max)

    def measure(which: np.ndarray) -> int:
        for j in np.nonzero(which.any(axis=0))[0]:
            at = np.nonzero(which[:, j])[0]
            apart = x[at] - now[j]
            squared[at, j] = (apart * apart).sum(axis=1)
            stood[at, j], seen[at, j] = np.sqrt(squared[at, j].astype(float)), t
        return int(which.sum())

    own = np.zeros(stood.shape, bool)
    own[rows, np.maximum(cluster, 0)] = True
    loosened = drift[np.maximum(seen, 0), np.arange(len(now))] * (1 + SLACK)
    lower = np.where(seen < 0, 0.0, stood * (1 - SLACK) - loosened)
    upper = np.where(cluster < 0, np.inf, (stood * (1 + SLACK) + loosened)[own])
    doubtful = (cluster < 0) | ((lower <= upper[:, None]) & ~own).any(axis=1)
    # The distance to the assigned centroid tightens the upper bound; what still fails is measured too.
    measured = measure(own & doubtful[:, None])
    upper = stood[own] * (1 + SLACK)
    measured += measure((lower <= upper[:, None]) & ~own & doubtful[:, None])
    cluster = np.where(doubtful, squared.argmin(axis=1), cluster)
    return cluster, np.where(doubtful, squared[rows, cluster], -1), measured


def _pass_kernel(now: np.ndarray, drift: np.ndarray, last: bool):
    """One pass over (id, units, cluster, stood, seen); the last one also measures every assigned distance."""
    k, dims = now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                n = batch.num_rows
                x = batch.column("units").flatten().to_numpy().reshape(n, dims)
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                stood = batch.column("stood").flatten().to_numpy().reshape(-1, k).copy()
                seen = batch.column("seen").flatten().to_numpy().reshape(-1, k).astype(np.int64)
                cluster, distance, measured = reassign(x, cluster, stood, seen, now, drift)
                if last:
                    at = np.nonzero(distance < 0)[0]
                    apart = x[at] - now[cluster[at]]
                    distance[at] = (apart * apart).sum(axis=1)
                    measured += len(at)
                work = np.zeros(n, np.int64)
                work[0] = measured
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        batch.column("units"),
                        pa.array(cluster, pa.int32()),
                        pa.array(distance),
                        pa.ListArray.from_arrays(ends, pa.array(stood.ravel())),
                        pa.ListArray.from_arrays(ends, pa.array(seen.ravel(), pa.int32())),
                        pa.array(work),
                    ],
                    ["_id", "units", "cluster", "distance", "stood", "seen", "measured"],
                )

    return run


def cluster(
    vectors: DataFrame, vec_id: str, vector: str, dims: int, k: int, rounds: int, scale: int, seed: int, scratch: Scratch
) -> Clustering:
    """``rounds`` Lloyd rounds from k hashed first centroids over floor(scale * component), then a last assignment.

    Tables go through ``scratch``; the one of a round is discarded when the next is written.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    points = vectors.select(F.col(vec_id).alias("_id"), grid(vector, dims, scale).alias("units"))
    points = scratch.keep(points.filter(F.col("units").isNotNull()), "vectors")
    now = first_centroids(points, k, seed)
    if not len(now):
        return Clustering(points.selectExpr("_id", "0 cluster", "0L distance"), now, [], [], [])
    k = len(now)
    schema = (
        f"_id {kind}, units array<bigint>, cluster int, distance bigint, "
        "stood array<double>, seen array<int>, measured bigint"
    )
    state = points.select(
        "_id",
        "units",
        F.lit(-1).alias("cluster"),
        F.array_repeat(F.lit(0.0), k).alias("stood"),
        F.array_repeat(F.lit(-1), k).alias("seen"),
    )
    history, held, measured = [now], points, []
    for t in range(rounds + 1):
        columns = state.select("_id", "units", "cluster", "stood", "seen")
        table = scratch.keep(columns.mapInArrow(_pass_kernel(now, drifts(history), t == rounds), schema), f"round-{t}")
        scratch.discard(held)
        sums = [F.sum(F.col("units")[i]).alias(f"s{i}") for i in range(dims)] if t < rounds else []
        found = {
            r["cluster"]: r
            for r in table.groupBy("cluster")
            .agg(
                F.count("*").alias("n"),
                F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"),
                F.sum("measured").alias("measured"),
                *sums,
            )
            .collect()
        }
        measured.append(sum(r["measured"] for r in found.values()))
        if t < rounds:
            now = now.copy()
            for j, r in found.items():
                now[j] = [r[f"s{i}"] // r["n"] for i in range(dims)]
            history.append(now)
        state = held = table
    sizes = [found[j]["n"] if j in found else 0 for j in range(k)]
    inertia = [int(found[j]["inertia"]) if j in found else 0 for j in range(k)]
    return Clustering(held.select("_id", "cluster", "distance"), now, sizes, inertia, measured)


def report(found: Clustering, vec_id: str) -> DataFrame:
    """Assignment of every vector with the inertia of its cluster and of all, and a digest of its centroid."""
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    spark = found.assigned.sparkSession
    known = spark.createDataFrame(
        [(j, s, h) for j, (s, h) in enumerate(zip(found.inertia, digests, strict=True))],
        "cluster int, cluster_inertia bigint, centroid_sha256 string",
    )
    joined = found.assigned.join(F.broadcast(known), "cluster")  # one row per centroid
    return joined.select(
        F.col("_id").alias(vec_id),
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(sum(found.inertia)).cast("long").alias("inertia"),
        "centroid_sha256",
    )
