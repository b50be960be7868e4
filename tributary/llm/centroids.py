"""Clusters of vectors around centroids, in exact integers.

Each round is one pass of all tasks over the vectors: a task finds the nearest
centroid of its rows by blocked matrix products (``vectors.nearest``), adds up the rows
of each, and hands on one record with these sums. A tree of tasks merges the
records, so that the driver gets a few of them, each no larger than the
centroids. Nothing else is shuffled, and a large cluster is many tasks' work.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, materialise, returning_memory
from .vectors import finite, moved, nearest, real, scaled, sums_by


@dataclass(frozen=True)
class Clusters:
    """``rows``: (id, cluster, distance) of each vector that was kept; ``centroids``: the final ones, in order."""

    rows: DataFrame
    centroids: list[list[int]]


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return scaled(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions))


def _merged(a: dict, b: dict) -> dict:
    out = dict(a)
    for k, (n, sums) in b.items():
        m, before = out.get(k, (0, [0] * len(sums)))
        out[k] = (m + n, [x + y for x, y in zip(before, sums)])
    return out


def _round(table: DataFrame, centroids: list[list[int]], dimensions: int) -> dict[int, tuple[int, list[int]]]:
    """The rows and sums of each centroid's cluster."""

    def partial(batches):
        total: dict = {}
        for batch in batches:
            values = _matrix(batch, dimensions)
            total = _merged(total, sums_by(nearest(values, centroids)[0], values))
        yield pa.record_batch([pa.array([json.dumps(list(total.items()))])], names=["sums"])

    parts = table.mapInArrow(returning_memory(partial), "sums string").rdd
    return parts.treeAggregate({}, lambda total, row: _merged(total, {k: tuple(v) for k, v in json.loads(row.sums)}), _merged, depth=2)


def cluster_vectors(table: DataFrame, clusters: int = 40, rounds: int = 5, dimensions: int = 64, seed: int = 2, id_column: str = "vec_id", vector_column: str = "embedding") -> Clusters:
    """Clusters the vectors of ``dimensions`` components, none null or not finite; other rows are dropped.

    The first centroids are the kept vectors of the smallest SHA-256 of
    ``seed:id``, in that order; rows that share an id are told apart by their
    vectors, and a row without an id comes after the others. With fewer
    vectors than ``clusters`` there are as many centroids as vectors, without
    any there are none, and no rows. Each round assigns every vector to its
    nearest centroid, of equally near ones the one of the smaller number, then
    moves every centroid that has vectors to the floor of their mean. Rows that
    repeat are vectors of their own. Other columns are ignored. Distances
    beyond a long count as the largest one.
    """
    spark = table.sparkSession
    vector = real(table, vector_column)
    kept = table.where(finite(vector) & (F.size(vector) == dimensions)).select(F.col(id_column).alias("id"), vector.alias("v"))
    kept = by_small_batches(materialise(kept, "vectors"))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.select(draw.alias("draw"), "v").orderBy(F.col("draw").asc_nulls_last(), "v").limit(clusters).collect()
    centroids = [[int(x) for x in scaled(np.array(r["v"], np.float64)).tolist()] for r in first]
    kind = kept.schema["id"].dataType.simpleString()
    schema = f"id {kind}, cluster int, distance long"
    if not centroids:
        return Clusters(spark.createDataFrame([], schema).withColumnRenamed("id", id_column), [])
    for _ in range(rounds):
        centroids = moved(centroids, _round(kept, centroids, dimensions))

    def assigned(batches):
        for batch in batches:
            numbers, distances = nearest(_matrix(batch, dimensions), centroids)
            yield pa.record_batch([batch.column(0), pa.array(numbers, pa.int32()), pa.array(distances, pa.int64())], names=["id", "cluster", "distance"])

    return Clusters(kept.mapInArrow(returning_memory(assigned), schema).withColumnRenamed("id", id_column), centroids)
