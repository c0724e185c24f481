"""Scores of an embedding: trustworthiness and silhouette, both exact."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowfold.functions import tiles
from lowfold.functions.draws import draw
from lowfold.operators import cells as C
from lowfold.operators.descent import pair_distances
from lowfold.operators.knn import knn_self
from lowfold.operators.prepare import clean_points, dense_index, row_numbers, unique_keys
from lowfold.operators.sweep import dealt_groups, group_rows, near_groups, reached_by_groups, streamed, sweep
from lowfold.session import StepStore


def input_ranks(
    points: DataFrame, pairs: DataFrame, steps: StepStore, metric: str = "euclidean", p: float = 2.0,
    block_rows: int = C.BLOCK_ROWS,
) -> DataFrame:
    """``(id, nbr, rank)``: 1 + the number of other rows strictly closer to id than nbr is.

    Each row meets only cells within the distance of its farthest pair, in a
    group of near rows that the cells stream past. Equal vectors are counted
    together, so copies cost nothing.
    """
    space, name = C.search_space(points.select("id", "features"), metric, p)
    space = steps.save(space, "space")
    reach = pair_distances(pairs, space, name, p)
    lists = reach.groupBy("id").agg(
        F.max("dist").alias("bound"), F.array_sort(F.collect_list(F.struct("dist", "nbr"))).alias("pairs")
    )
    lists = lists.select("id", "bound", F.col("pairs.nbr").alias("nbr"), F.col("pairs.dist").alias("dist"))
    vectors = space.groupBy("features").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    vectors = steps.save(vectors.select("id", "features", "copies"), "vectors")
    cells, data = C.build_cells(vectors, name, p, steps, block_rows)
    placed = C.place_queries(space.join(lists, "id"), cells, steps).drop("qsub")
    most = group_rows(placed, cells.total, cells.centres.shape[1], block_rows)
    grouped, groups = dealt_groups(placed, cells, most)
    grouped = grouped.drop("qcell")

    def hits(part: pa.RecordBatch) -> np.ndarray:
        return cells.hits(tiles.matrix(part.column("features")), part.column("bound").to_numpy(), 1)[0]

    pairs = steps.save(reached_by_groups(grouped.select("group", "features", "bound"), hits, len(cells.centres)), "reached")
    order = np.concatenate(near_groups(cells.centres, cells.rows, 0))

    class Counts:
        def __init__(self, q: pa.Table):
            self.ids, self.rows = q.column("id").to_numpy(), tiles.matrix(q.column("features"))
            self.bound = q.column("bound").to_numpy()
            self.nbr, self.dist = tiles.matrix(q.column("nbr"), np.int64), tiles.matrix(q.column("dist"))
            self.closer = np.zeros(self.dist.shape, np.int64)

        def fold(self, x: pa.Table) -> None:
            some = cells.part(order[np.unique(x.column("place").to_numpy())])
            step = max(1, tiles.TILE_CELLS // len(some.rows))
            parts = (slice(s, s + step) for s in range(0, len(self.ids), step))
            reached = np.flatnonzero(np.concatenate([some.hits(self.rows[part], self.bound[part], 1)[0].any(axis=1) for part in parts]))
            others, weight = tiles.matrix(x.column("features")), x.column("copies").to_numpy()
            if len(reached):
                self.closer[reached] += tiles.closer_rows(self.rows[reached], others, weight, self.dist[reached], name, p)

        def finish(self) -> Iterator[pa.RecordBatch]:
            spread = np.repeat(self.ids, self.dist.shape[1])
            columns = [pa.array(c) for c in (spread, self.nbr.ravel(), self.closer.ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "nbr", "closer"])

    counts = sweep(grouped, streamed(data, pairs, cells), groups, Counts, "id BIGINT, nbr BIGINT, closer BIGINT")
    # The row itself was counted whenever the pair's distance is above zero.
    own = F.when(F.col("dist") > 0, 1).otherwise(0)
    return counts.join(reach, ["id", "nbr"]).select("id", "nbr", (F.col("closer") - own + 1).alias("rank"))


def trustworthiness(
    points: DataFrame,
    embedding: DataFrame,
    k: int = 15,
    metric: str = "euclidean",
    p: float = 2.0,
    block_rows: int = C.BLOCK_ROWS,
) -> DataFrame:
    """One row ``trustworthiness``: 1 less the scaled excess input ranks of the
    k nearest rows in ``embedding(id, y)``."""
    steps = StepStore(points.sparkSession, "trust")
    points = clean_points(points.select("id", "features"))
    embedding = clean_points(embedding.select("id", F.col("y").alias("features"))).withColumnRenamed("features", "y")
    keys = steps.save(dense_index(points.select("id"), "id", steps), "keys")
    points = points.join(keys, "id").select(F.col("idx").alias("id"), "features")
    embedding = embedding.join(keys, "id").select(F.col("idx").alias("id"), "y")
    n = points.count()
    if k >= n / 2:
        raise ValueError(f"k must be below half the rows, {n / 2}")
    low = embedding.select("id", F.col("y").alias("features"))
    pairs = steps.save(knn_self(low, k, block_rows=block_rows, checked=True), "low").select("id", "nbr")
    ranks = input_ranks(points, pairs, steps, metric, p, block_rows)
    excess = F.sum(F.greatest(F.lit(0), F.col("rank") - F.lit(k)))
    scale = 2.0 / (n * k * (2 * n - 3 * k - 1))
    return ranks.agg((1.0 - F.lit(scale) * excess).alias("trustworthiness"))


#: Centroids that the driver and a task hold at once, about; more are looked at in slices.
MOST_CENTROIDS = 8192


def silhouette_rows(
    embedding: DataFrame, clusters: DataFrame, steps: StepStore, block_rows: int = C.BLOCK_ROWS, share: float | None = None
) -> DataFrame:
    """``(cluster, y, copies, s)`` for each distinct position of each cluster.

    A mean distance to a cluster is at least the distance to its centroid. So a
    position is first summed against its own cluster and the other one with the
    nearest centroid, which gives a first ``b``, and then only against clusters
    whose centroid is nearer than that. Positions that need a cluster stay in
    groups past which it streams, and what leaves a task is one sum per position
    and cluster. ``steps`` holds the blocks of positions and the clusters that
    they need as ``pairs``. With ``share`` only a drawn part of the positions is scored, each
    still against all rows.
    """
    rows = embedding.join(clusters.select("id", "cluster"), "id")
    spots = rows.groupBy("cluster", "y").agg(F.count("*").alias("copies"))
    spots = steps.save(row_numbers(spots, steps), "spots")
    width = spots.select(F.size("y")).first()[0]
    sums = [(F.sum(F.col("y")[i] * F.col("copies")) / F.sum("copies")).alias(f"c{i}") for i in range(width)]
    sizes = spots.groupBy("cluster").agg(F.sum("copies").alias("size"), F.count("*").alias("n"), *sums)
    sizes = sizes.withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    sizes = steps.save(sizes, "sizes")
    slices = math.ceil(sizes.count() / MOST_CENTROIDS)
    part = (draw("pivot", 5, 0, F.col("id"), F.col("cluster")) % F.col("blocks")).cast("int").alias("part")
    placed = spots.join(sizes.select("cluster", "blocks"), "cluster").select("id", "cluster", part, "blocks", "y", "copies")
    placed = steps.save(placed, "placed")
    scored = placed if share is None else placed.filter(draw("pivot", 6, 0, F.col("id"), F.col("cluster")) % 1_000_000 < int(share * 1_000_000))

    def bounds(rows: DataFrame) -> DataFrame:
        parts = [sizes.filter(F.pmod("cluster", F.lit(slices)) == k).orderBy("cluster").collect() for k in range(slices)]
        return reduce(DataFrame.unionByName, [_bounds(rows, centres, width) for centres in parts if centres])

    mine = scored.select("id", "cluster", "part", "y", F.col("cluster").alias("to"), F.col("blocks").alias("to_blocks"))
    nearest = bounds(scored.select("id", "cluster", "part", "y", F.lit(None).cast("double").alias("best"), F.lit(None).cast("int").alias("known")))
    if slices > 1:
        least = F.min(F.struct("bound", "to", "to_blocks")).alias("m")
        nearest = nearest.groupBy("id", "cluster", "part", "y").agg(least).select("id", "cluster", "part", "y", "m.to", "m.to_blocks", "m.bound")
    found = _sums(mine.unionByName(nearest.drop("bound")), placed, width, block_rows, steps)
    mean = F.col("total") / F.col("size")
    best = found.filter("cluster <> to").join(sizes.select(F.col("cluster").alias("to"), "size"), "to")
    best = best.select("id", "cluster", mean.alias("best"), F.col("to").alias("known"))
    later = bounds(scored.select("id", "cluster", "part", "y").join(best, ["id", "cluster"]))
    found = found.unionByName(_sums(later.drop("bound"), placed, width, block_rows, steps))
    totals = found.join(sizes.select(F.col("cluster").alias("to"), "size"), "to")
    own = F.col("to") == F.col("cluster")
    means = totals.groupBy("id", "cluster").agg(
        F.max(F.when(own, F.col("size"))).alias("size"),
        F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, mean)).alias("b"),
    )
    widest = F.greatest("a", "b")
    s = F.when((F.col("size") == 1) | (widest == 0), 0.0).otherwise((F.col("b") - F.col("a")) / widest)
    return spots.join(means.select("id", "cluster", s.alias("s")), ["id", "cluster"])


def _bounds(rows: DataFrame, centres: list, width: int) -> DataFrame:
    """``(id, cluster, part, y, to, to_blocks, bound)`` for ``rows(id, cluster, part, y, best, known)``.

    Of the clusters in ``centres`` these are, but for a row's own, the one with
    the nearest centroid where there is no ``best``, and otherwise all whose
    centroid is as near as that, but for ``known``.
    """
    names = np.array([c["cluster"] for c in centres], np.int32)
    blocks = np.array([c["blocks"] for c in centres], np.int32)
    middle = np.array([[c[f"c{i}"] for i in range(width)] for c in centres], float)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = tiles.matrix(batch.column("y"))
            own, known = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "known"))
            best = batch.column("best").to_numpy(zero_copy_only=False).astype(float)
            step = max(1, tiles.TILE_CELLS // len(names))
            for s in range(0, len(y), step):
                part = slice(s, s + step)
                bound = tiles.tile_distance(y[part], middle, "euclidean", 2.0)
                bound[(own[part, None] == names) | (known[part, None] == names)] = np.inf
                first = np.isnan(best[part])
                # A hair more than the bound, for what rounding may add to either.
                wanted = bound <= best[part, None] * (1 + 1e-9) + 1e-12
                wanted[np.arange(len(bound)), bound.argmin(1)] |= first
                i, j = np.nonzero(wanted & np.isfinite(bound))
                columns = [batch.column(c).take(pa.array(i + s)) for c in ("id", "cluster", "part", "y")]
                columns += [pa.array(names[j]), pa.array(blocks[j]), pa.array(bound[i, j])]
                yield pa.record_batch(columns, names=["id", "cluster", "part", "y", "to", "to_blocks", "bound"])

    return rows.mapInArrow(find, "id BIGINT, cluster INT, part INT, y ARRAY<DOUBLE>, `to` INT, to_blocks INT, bound DOUBLE")


def _sums(needs: DataFrame, placed: DataFrame, width: int, block_rows: int, steps: StepStore) -> DataFrame:
    """``(id, cluster, to, total)``: summed distances to the cluster ``to``, whose rows stream past those that need it."""
    needs = steps.save(needs.select("id", "cluster", "part", "to", "y"), "needs")
    pairs = steps.save(needs.groupBy("cluster", "part", "to").agg(F.count("*").alias("n")), "pairs")
    most = group_rows(needs, pairs.agg(F.sum("n")).first()[0] or 0, width, block_rows)
    wanted = pairs.groupBy("to").agg(F.ceil(F.sum("n") / F.lit(most)).cast("bigint").alias("pieces"))
    wanted = steps.save(row_numbers(wanted, steps, "first"), "wanted")
    clusters, pieces = wanted.agg(F.count("*"), F.max("pieces")).first()
    piece = draw("pivot", 7, 0, F.col("id"), F.lit(0)) % F.col("pieces")
    here = needs.join(wanted, "to").select((F.col("first") + piece * clusters).alias("group"), "id", "cluster", "to", "y")
    there = placed.select(F.col("cluster").alias("to"), F.col("id").alias("other"), F.col("y").alias("at"), "copies").join(wanted, "to")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece")
    there = there.select("other", "at", "copies", "first", each)
    there = there.select((F.col("first") + F.col("piece") * clusters).alias("group"), F.lit(0).alias("place"), "other", "at", "copies")

    class Totals:
        def __init__(self, left: pa.Table):
            self.left, self.y, ids = left, tiles.matrix(left.column("y")), left.column("id").to_numpy()
            self.by_id = np.argsort(ids)
            self.ids, self.total = ids[self.by_id], np.zeros(len(ids))

        def fold(self, right: pa.Table) -> None:
            at, copies, other = tiles.matrix(right.column("at")), right.column("copies").to_numpy(), right.column("other").to_numpy()
            centre = at.mean(axis=0)
            spot = np.minimum(np.searchsorted(self.ids, other), len(self.ids) - 1)
            own = np.full(len(self.ids), -1)  # the column in which a row meets itself
            own[self.by_id[spot[self.ids[spot] == other]]] = np.flatnonzero(self.ids[spot] == other)
            step = max(1, tiles.TILE_CELLS // 8 // len(at))
            for s in range(0, len(self.y), step):
                tile = tiles.tile_distance(self.y[s : s + step] - centre, at - centre, "euclidean", 2.0)
                mine = np.flatnonzero(own[s : s + step] >= 0)
                tile[mine, own[s + mine]] = 0.0
                self.total[s : s + step] += tile @ copies

        def finish(self) -> Iterator[pa.RecordBatch]:
            columns = [self.left.column(c).combine_chunks() for c in ("id", "cluster", "to")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(self.total)], names=["id", "cluster", "to", "total"])

    schema = "id BIGINT, cluster INT, `to` INT, total DOUBLE"
    return steps.save(sweep(here, there, max(1, clusters * (pieces or 0)), Totals, schema), "totals")


def silhouette(
    embedding: DataFrame, clusters: DataFrame, exclude_noise: bool = False, block_rows: int = C.BLOCK_ROWS, share: float | None = None
) -> DataFrame:
    """One row ``silhouette``, null with fewer than two clusters.

    Noise (-1) counts as a cluster unless ``exclude_noise``. ``share``, off by
    default, scores only so large a drawn part of the positions, each against
    all rows: an estimate for tables whose clusters are too large to sum whole;
    null where nothing is drawn.
    """
    spark = embedding.sparkSession
    steps = StepStore(spark, "silhouette")
    clusters = clusters.select("id", F.col("cluster").cast("int").alias("cluster"))
    if exclude_noise:
        clusters = clusters.filter("cluster >= 0")
    if not enough_clusters(clusters):
        return spark.createDataFrame([(None,)], "silhouette DOUBLE")
    clean_points(embedding.select("id", F.col("y").alias("features")))
    unique_keys(clusters, "id")
    rows = silhouette_rows(embedding.select("id", "y"), clusters, steps, block_rows, share)
    return rows.agg((F.sum(F.col("s") * F.col("copies")) / F.sum("copies")).alias("silhouette"))


def enough_clusters(clusters: DataFrame) -> bool:
    """Whether there are at least two labels."""
    return clusters.agg(F.count_distinct("cluster") >= 2).first()[0]
