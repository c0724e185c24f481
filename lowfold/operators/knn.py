"""Nearest-neighbour joins: exact self-join, exact query join, top-k merge."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lowfold.functions import tiles
from lowfold.operators import cells as C
from lowfold.operators.prepare import clean_points
from lowfold.operators.sweep import dealt_groups, group_rows, near_groups, reached_by_groups, streamed, sweep
from lowfold.session import StepStore

PAIR_SCHEMA = "id BIGINT, nbr BIGINT, dist DOUBLE"
LIST_SCHEMA = f"{PAIR_SCHEMA}, rank INT"


def top_k(pairs: DataFrame, k: int, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """The ``k`` nearest rows of each key by (dist, nbr), with their ``rank``.

    Catalyst limits each group before the shuffle, so a task ships at most k
    rows of a key.
    """
    order = Window.partitionBy(*keys).orderBy("dist", "nbr")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def merge_top_k(current: DataFrame, offered: DataFrame, k: int) -> DataFrame:
    """Merge neighbour lists; a pair offered more than once counts once."""
    both = current.select("id", "nbr", "dist").unionByName(offered.select("id", "nbr", "dist"))
    return top_k(both.groupBy("id", "nbr").agg(F.min("dist").alias("dist")), k)


def reverse_graph(knn: DataFrame) -> DataFrame:
    """For each row, the rows that list it as a neighbour."""
    return knn.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"), "dist")


def _most_copies(points: DataFrame) -> int:
    """Rows of the largest group of equal vectors (partial sums, no rows move)."""
    groups = points.groupBy(F.xxhash64("features").alias("h")).agg(F.count("*").alias("n"))
    return groups.agg(F.max("n")).first()[0] or 0


def _join_copies(
    queries: DataFrame, train: DataFrame, k: int, metric: str, p: float, skip_self: bool, block_rows: int
) -> DataFrame:
    """The same join where many rows are copies of each other.

    Under the order (distance, id) only the smallest ids of a group of copies
    can be neighbours, and all copies share one neighbour list but for
    themselves. So each vector is searched once, against the first ``need``
    copies of each vector, and the list is handed to all its copies.
    """
    steps = StepStore(queries.sparkSession, "knn-copies")
    need = k + 1 if skip_self else k
    by_vector = Window.partitionBy(F.xxhash64("features"), "features").orderBy("id")
    first = train.withColumn("n", F.row_number().over(by_vector)).filter(F.col("n") <= need).drop("n")
    first = steps.save(first, "first-copies")
    vectors = steps.save(queries.groupBy("features").agg(F.min("id").alias("id")), "vectors")
    found = _search(vectors.select("id", "features"), first, need, metric, p, False, block_rows)
    shared = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("dist", "nbr"))).alias("list"))
    shared = vectors.join(shared, "id").select("features", "list")
    mine = F.col("list")
    if skip_self:
        mine = F.filter(mine, lambda e: e["nbr"] != F.col("id"))
    rows = queries.join(shared, "features").select("id", F.posexplode(F.slice(mine, 1, k)).alias("pos", "e"))
    return rows.select("id", "e.nbr", "e.dist", (F.col("pos") + 1).alias("rank"))


def _join(
    queries: DataFrame, train: DataFrame, k: int, metric: str, p: float, skip_self: bool, block_rows: int
) -> DataFrame:
    queries, train = queries.select("id", "features"), train.select("id", "features")
    size = C.table_size(train)
    total = size[0]
    if skip_self and k >= total:
        raise ValueError(f"{k} neighbours asked for, but a row has only {total - 1} others")
    k = min(k, total)
    many = block_rows // 4
    crowded = total > block_rows and _most_copies(train) > many
    if not crowded and not skip_self:
        crowded = _most_copies(queries) > many
    if crowded:
        return _join_copies(queries, train, k, metric, p, skip_self, block_rows)
    return _search(queries, train, k, metric, p, skip_self, block_rows, size)


def _search(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    metric: str,
    p: float,
    skip_self: bool,
    block_rows: int,
    size: C.Size | None = None,
) -> DataFrame:
    steps = StepStore(queries.sparkSession, "knn")
    chord = C.metric_name(metric) == "cosine"
    train, name = C.search_space(train, metric, p)
    cells, data = C.build_cells(train, name, p, steps, block_rows, size)
    if skip_self:
        placed = data.withColumnRenamed("cell", "qcell").withColumnRenamed("sub", "qsub")
    else:
        placed = C.place_queries(C.search_space(queries, metric, p)[0], cells, steps)

    def search(q: pa.Table, x: pa.Table):
        return tiles.nearest(
            q.column("id").to_numpy(),
            tiles.matrix(q.column("features")),
            x.column("id").to_numpy(),
            tiles.matrix(x.column("features")),
            k,
            name,
            p,
            skip_self,
        )

    def look(q: pa.Table, x: pa.Table) -> pa.Table:
        found, nbr, dist = search(q, x)
        starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
        rank = np.arange(len(found)) - np.repeat(starts, np.diff([*starts, len(found)])) + 1
        return pa.table({"id": found, "nbr": nbr, "dist": dist, "rank": pa.array(rank.astype(np.int32))})

    def first_look(q: pa.Table, x: pa.Table) -> pa.Table:
        ids = q.column("id").to_numpy()
        found, _, dist = search(q, x)
        place = np.argsort(ids, kind="stable")
        row = place[np.searchsorted(ids[place], found)] if len(found) else np.empty(0, np.int64)
        bound = np.full(len(ids), -np.inf)
        np.maximum.at(bound, row, dist)
        bound[np.bincount(row, minlength=len(ids)) < k] = np.inf
        return q.select(["qcell", "id", "features"]).append_column("bound", pa.array(bound))

    if cells.blocks.sum() == 1:
        if skip_self:
            ranked = placed.groupBy("qcell", "qsub").applyInArrow(lambda q: look(q, q), LIST_SCHEMA)
        else:
            ranked = C.meet(C.home_visits(placed, cells), data, look, LIST_SCHEMA)
    else:
        state_schema = "qcell INT, id BIGINT, features ARRAY<DOUBLE>, bound DOUBLE"
        if skip_self:
            state = placed.groupBy("qcell", "qsub").applyInArrow(lambda q: first_look(q, q), state_schema)
        else:
            state = C.meet(C.home_visits(placed, cells), data, first_look, state_schema)
        state = steps.save(state, "first-look")
        ranked = _look_around(state, data, cells, k, skip_self, steps)
    if chord:
        ranked = ranked.withColumn("dist", F.col("dist") * F.col("dist") / 2)
    return ranked


def _look_around(state: DataFrame, data: DataFrame, cells: C.Cells, k: int, skip_self: bool, steps: StepStore) -> DataFrame:
    """Nearest rows of all cells within ``bound`` of the rows of ``state(qcell, id, features, bound)``."""
    need = k + 1 if skip_self else k
    most = group_rows(state, cells.total, cells.centres.shape[1], cells.block_rows)
    grouped, groups = dealt_groups(state, cells, most)

    def hits(part: pa.RecordBatch) -> np.ndarray:
        return cells.hits(tiles.matrix(part.column("features")), part.column("bound").to_numpy(), need)[0]

    pairs = steps.save(reached_by_groups(grouped.select("group", "features", "bound"), hits, len(cells.centres)), "reached")
    order = np.concatenate(near_groups(cells.centres, cells.rows, 0))

    class Lists:
        def __init__(self, q: pa.Table):
            ids, x = q.column("id").to_numpy(), tiles.matrix(q.column("features"))
            self.near = tiles.Nearest(ids, x, k, cells.metric, cells.p, skip_self, q.column("bound").to_numpy())

        def fold(self, x: pa.Table) -> None:
            some = cells.part(order[np.unique(x.column("place").to_numpy())])
            step = max(1, tiles.TILE_CELLS // len(some.rows))
            near = self.near
            parts = (slice(s, s + step) for s in range(0, len(near.ids), step))
            reached = np.concatenate([some.hits(near.x[part], near.bound[part], need)[0].any(axis=1) for part in parts])
            near.offer(np.flatnonzero(reached), x.column("id").to_numpy(), tiles.matrix(x.column("features")))

        def finish(self) -> Iterator[pa.RecordBatch]:
            near = self.near
            for s in range(0, len(near.ids), tiles.PAIR_SLICE):
                row, at = np.nonzero(np.isfinite(near.dist[s : s + tiles.PAIR_SLICE]))
                columns = [near.ids[s + row], near.nbr[s + row, at], near.dist[s + row, at], (at + 1).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "nbr", "dist", "rank"])

    return sweep(grouped.select("group", "id", "features", "bound"), streamed(data, pairs, cells), groups, Lists, LIST_SCHEMA)


def knn_self(
    points: DataFrame,
    k: int,
    metric: str = "euclidean",
    p: float = 2.0,
    block_rows: int = C.BLOCK_ROWS,
    checked: bool = False,
) -> DataFrame:
    """Exact k nearest other rows of each row of ``points(id, features)``.

    Ties go to the smaller id. Copies of a row are its neighbours at distance
    zero; the row itself never is. Missing and non-finite values are refused,
    unless the caller has ``checked`` the rows.
    """
    points = points if checked else clean_points(points)
    return _join(points, points, k, metric, p, True, block_rows)


def knn_query(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    metric: str = "euclidean",
    p: float = 2.0,
    block_rows: int = C.BLOCK_ROWS,
    checked: bool = False,
) -> DataFrame:
    """Exact k nearest rows of ``train`` for each query; k is cut to the train size."""
    if not checked:
        queries, train = clean_points(queries), clean_points(train)
    return _join(queries, train, k, metric, p, False, block_rows)


def knn_graph(
    points: DataFrame,
    k: int,
    metric: str = "euclidean",
    method: str = "exact",
    p: float = 2.0,
    seed: int = 42,
    block_rows: int = C.BLOCK_ROWS,
    checked: bool = False,
) -> DataFrame:
    """Neighbour graph (id, nbr, dist, rank) by the exact or approximate method."""
    if method == "exact":
        return knn_self(points, k, metric, p, block_rows, checked)
    if method == "approx":
        from lowfold.operators.descent import knn_descent

        return knn_descent(points, k, metric, p, seed=seed, block_rows=block_rows, checked=checked)
    raise ValueError("method should be 'exact' or 'approx'")
