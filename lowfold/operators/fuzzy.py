"""Local scaling and the weighted neighbour graph."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bracket of the search for sigma, and its number of halvings.
SIGMA_LOW, SIGMA_HIGH, HALVINGS = 1e-5, 1e5, 60


def solve_sigma(gaps: np.ndarray, starts: np.ndarray, target: float) -> np.ndarray:
    """Root of sum(exp(-gap / sigma)) = target for each run of ``gaps``, by halving.

    Run r is ``gaps[starts[r]:starts[r + 1]]`` and is not empty. The sum grows
    with sigma, so one probe per step tells which half holds the root. Without
    a root in the bracket the search ends at the nearer end.
    """
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    low = np.full(len(starts) - 1, SIGMA_LOW)
    width = SIGMA_HIGH - SIGMA_LOW
    for _ in range(HALVINGS):
        width /= 2
        middle = low + width
        total = np.add.reduceat(np.exp(-gaps / middle[row]), starts[:-1])
        low = np.where(total > target, low, middle)
    return low + width / 2


def _lists(knn: DataFrame, positive_rho: bool) -> DataFrame:
    """One row per id: its (at most k) neighbours and rho."""
    smallest = F.min(F.when(F.col("dist") > 0, F.col("dist"))) if positive_rho else F.min("dist")
    return knn.groupBy("id").agg(
        F.coalesce(smallest, F.lit(0.0)).alias("rho"), F.collect_list(F.struct("nbr", "dist")).alias("list")
    )


def scaled(knn: DataFrame, n_neighbors: int, positive_rho: bool = False) -> DataFrame:
    """(id, rho, sigma, list). Rows are solved a batch at a time; only positive
    distances enter the sum, and a row without any gets the smallest sigma."""
    target = math.log2(n_neighbors)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            neighbours = batch.column("list")
            dist = neighbours.flatten().field("dist").to_numpy(zero_copy_only=False)
            offsets = neighbours.offsets.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            rho = batch.column("rho").to_numpy()
            counts = np.bincount(row[dist > 0], minlength=batch.num_rows)
            starts = np.concatenate([[0], np.cumsum(counts[counts > 0])])
            sigma = np.full(batch.num_rows, SIGMA_LOW)
            gaps = np.maximum(0.0, dist - rho[row])[dist > 0]
            if len(gaps):
                sigma[counts > 0] = solve_sigma(gaps, starts, target)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigma)], names=[*batch.schema.names, "sigma"])

    schema = "id BIGINT, rho DOUBLE, list ARRAY<STRUCT<nbr: BIGINT, dist: DOUBLE>>, sigma DOUBLE"
    return _lists(knn, positive_rho).mapInArrow(solve, schema)


def rho(knn: DataFrame) -> DataFrame:
    """Smallest distance of each row, zero when it has a copy."""
    return knn.groupBy("id").agg(F.min("dist").alias("rho"))


def local_scales(knn: DataFrame, n_neighbors: int, positive_rho: bool = False) -> DataFrame:
    """``scales(id, rho, sigma)``; projection takes rho over positive distances only."""
    return scaled(knn, n_neighbors, positive_rho).select("id", "rho", "sigma")


def clamped_rows(scales: DataFrame) -> DataFrame:
    """Number of rows whose search for sigma ended at an end of the bracket."""
    edge = (F.col("sigma") <= SIGMA_LOW * (1 + 1e-6)) | (F.col("sigma") >= SIGMA_HIGH * (1 - 1e-6))
    return scales.agg(F.count_if(edge).alias("clamped_rows"))


def membership_weight(dist: Column, rho: Column, sigma: Column) -> Column:
    return F.exp(-F.greatest(F.lit(0.0), dist - rho) / sigma)


def membership(knn: DataFrame, n_neighbors: int, positive_rho: bool = False) -> DataFrame:
    """Directed weights ``(i, j, w)``; scales and weights come from one grouping."""
    return weights(scaled(knn, n_neighbors, positive_rho))


def weights(scaled: DataFrame) -> DataFrame:
    """Directed weights from rows of ``scaled``."""
    rows = scaled.select("id", "rho", "sigma", F.explode("list").alias("e"))
    w = membership_weight(F.col("e.dist"), F.col("rho"), F.col("sigma"))
    return rows.select(F.col("id").alias("i"), F.col("e.nbr").alias("j"), w.alias("w"))


def weigh(knn: DataFrame, scales: DataFrame) -> DataFrame:
    """Directed weights from given scales."""
    w = membership_weight(F.col("dist"), F.col("rho"), F.col("sigma"))
    return knn.join(scales, "id").select(F.col("id").alias("i"), F.col("nbr").alias("j"), w.alias("w"))


def fuzzy_union(directed: DataFrame) -> DataFrame:
    """Symmetric weights a + b - a*b; both directions of an edge are stored."""
    out = F.struct("i", "j", F.col("w").alias("a"), F.lit(0.0).alias("b"))
    back = F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.lit(0.0).alias("a"), F.col("w").alias("b"))
    sums = directed.select(F.inline(F.array(out, back))).groupBy("i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select("i", "j", (F.col("a") + F.col("b") - F.col("a") * F.col("b")).alias("w"))


def degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("i").agg(F.sum("w").alias("deg"))


def cross_membership(knn: DataFrame, n_neighbors: int) -> DataFrame:
    """``cross_edges(id, train_id, w)`` from new rows to training rows, one direction."""
    rows = membership(knn, n_neighbors, positive_rho=True)
    return rows.select(F.col("i").alias("id"), F.col("j").alias("train_id"), "w")


def barycentre(cross_edges: DataFrame, train: DataFrame, new_ids: DataFrame, components: int) -> DataFrame:
    """Weighted mean of the neighbours' training coordinates, per new row.

    A row whose weights sum to zero starts at the mean of the training
    embedding ``train(id, y)``.
    """
    y = train.select(F.col("id").alias("train_id"), "y")
    sums = cross_edges.join(y, "train_id").groupBy("id").agg(
        F.sum("w").alias("total"),
        *[F.sum(F.col("w") * F.col("y")[c]).alias(f"s{c}") for c in range(components)],
    )
    middle = train.agg(F.array(*[F.avg(F.col("y")[c]) for c in range(components)]).alias("middle"))
    mean = F.array(*[F.col(f"s{c}") / F.col("total") for c in range(components)])
    start = F.when(F.col("total") > 0, mean).otherwise(F.col("middle"))
    joined = new_ids.select("id").join(sums, "id", "left").join(F.broadcast(middle))
    return joined.select("id", start.alias("y"))
