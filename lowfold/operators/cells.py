"""Bounded blocks of points, and the joins that look only at blocks near a row.

Points are put into the cell of their nearest pivot. A cell keeps its centre,
its radius and its row count; by the triangle inequality a row whose search
radius does not reach a cell needs none of the cell's rows. Cells that hold
more rows than one block, such as many copies of one point, are split into
blocks by a repeatable draw, so no group is larger than a block.

The driver holds only the cell table, at most ``MAX_CELLS`` rows. Rows meet
rows inside NumPy tiles and only the rows of the result leave a task, so pairs
are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowfold.functions import tiles
from lowfold.functions.distances import metric_name
from lowfold.functions.draws import PRIME_B, draw
from lowfold.session import StepStore

BLOCK_ROWS = 8192
MAX_CELLS = 16_384
MAX_CELL_BYTES = 64 << 20
Size = tuple[int, int]
PAIR_KEYS = ["qcell", "qsub", "tcell", "tsub"]


@dataclass
class Cells:
    centres: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    metric: str
    p: float
    block_rows: int

    @property
    def total(self) -> int:
        return int(self.rows.sum())

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.rows // self.block_rows))

    def block_table(self, like: DataFrame) -> DataFrame:
        """(cell, blocks): one small row per cell."""
        data = [(c, int(b)) for c, b in enumerate(self.blocks)]
        return like.sparkSession.createDataFrame(data, "cell INT, blocks INT")

    def gaps(self, q: np.ndarray) -> np.ndarray:
        """Distances from rows to all centres, with rounding on the safe side."""
        return tiles.tile_distance(q, self.centres, self.metric, self.p)

    def reach_margin(self, q: np.ndarray) -> float:
        return 4.0 * tiles.slack(q, self.centres)

    def bound(self, gaps: np.ndarray, need: int) -> np.ndarray:
        """For each row a radius that surely holds ``need`` points."""
        far = gaps + self.radius[None, :]
        order = np.argsort(far, axis=1)
        reached = np.cumsum(self.rows[order], axis=1) >= need
        first = np.argmax(reached, axis=1)
        picked = np.take_along_axis(far, np.take_along_axis(order, first[:, None], axis=1), axis=1)[:, 0]
        return np.where(reached.any(axis=1), picked, np.inf)

    def hits(self, q: np.ndarray, bound: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Which cells the radius ``bound`` of each row reaches, and the radius itself.

        Where it is infinite it becomes one that surely holds ``need`` points.
        """
        gaps, margin, bound = self.gaps(q), self.reach_margin(q), bound.copy()
        open_rows = ~np.isfinite(bound)
        if open_rows.any():
            bound[open_rows] = self.bound(gaps[open_rows], need) + margin
        return (gaps - self.radius[None, :] <= bound[:, None] * (1 + 1e-9) + margin) & (self.rows > 0), bound

    def part(self, cells: np.ndarray) -> Cells:
        """Some of the cells only."""
        return Cells(self.centres[cells], self.radius[cells], self.rows[cells], self.metric, self.p, self.block_rows)


def table_size(points: DataFrame) -> Size:
    """Number of rows and width of the vectors."""
    total, width = points.agg(F.count("*"), F.max(F.size("features"))).first()
    if not total:
        raise ValueError("there are no rows")
    return total, width


def search_space(points: DataFrame, metric: str, p: float = 2.0) -> tuple[DataFrame, str]:
    """Rows and metric for a search; ``cosine`` becomes unit rows + euclidean."""
    name = metric_name(metric)
    if name == "minkowski" and p < 1:
        raise ValueError("minkowski needs p >= 1")
    if name == "minkowski" and p == 2.0:
        name = "euclidean"
    if name != "cosine":
        return points, name
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda acc, v: acc + v * v))
    scaled = F.transform("features", lambda v: F.when(F.col("_norm") == 0, v).otherwise(v / F.col("_norm")))
    return points.withColumn("_norm", norm).withColumn("features", scaled).drop("_norm"), "euclidean"


def nearest_cell(points: DataFrame, centres: np.ndarray, metric: str, p: float) -> DataFrame:
    """Add ``cell`` and ``gap`` (distance to the cell's centre) to each row."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, tiles.TILE_CELLS // len(centres))
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                x = tiles.matrix(part.column("features"))
                cell = np.argmin(tiles.tile_distance(x, centres, metric, p), axis=1)
                gap = tiles.pair_distance(x, centres[cell], metric, p)
                columns = list(part.columns) + [pa.array(cell.astype(np.int32)), pa.array(gap)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "cell", "gap"])

    return points.mapInArrow(assign, ", ".join([*fields, "cell INT", "gap DOUBLE"]))


def split_blocks(assigned: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """Number the blocks of each cell; ``counts`` has one row per cell."""
    sub = (draw("pivot", 1, 0, F.col("id"), F.lit(0)) % F.col("blocks")).cast("int")
    return assigned.join(F.broadcast(counts), "cell").withColumn(name, sub).drop("blocks")


def build_cells(
    points: DataFrame, metric: str, p: float, steps: StepStore, block_rows: int = BLOCK_ROWS, size: Size | None = None
) -> tuple[Cells, DataFrame]:
    """Cells of ``points(id, features)`` and its rows as (cell, sub, id, features)."""
    total, width = size or table_size(points)
    if total <= block_rows:
        cells = Cells(np.zeros((1, width)), np.array([np.inf]), np.array([total]), metric, p, block_rows)
        return cells, points.withColumn("cell", F.lit(0)).withColumn("sub", F.lit(0))
    pivots = min(MAX_CELLS, MAX_CELL_BYTES // (8 * max(1, width)), 4 * math.ceil(total / block_rows))
    place = draw("pivot", 0, 0, F.col("id"), F.lit(0))
    # Twice as many rows as pivots are expected below the bound; the rest need not be ordered.
    below = int(min(1.0, (2.0 * pivots + 64) / total) * PRIME_B)
    chosen = points.filter(place <= below).orderBy(place, "id").limit(pivots).select("features").collect()
    centres = np.unique(np.array([r.features for r in chosen], dtype=np.float64), axis=0)
    assigned = steps.save(nearest_cell(points, centres, metric, p), "cells")
    stats = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
    used = {r.cell: r for r in stats}
    rows = np.array([used[c].n if c in used else 0 for c in range(len(centres))])
    radius = np.array([used[c].radius if c in used else 0.0 for c in range(len(centres))])
    cells = Cells(centres, radius, rows, metric, p, block_rows)
    return cells, split_blocks(assigned, cells.block_table(points), "sub").drop("gap")


def place_queries(queries: DataFrame, cells: Cells, steps: StepStore) -> DataFrame:
    """Put query rows into bounded groups (qcell, qsub) by their nearest cell."""
    if len(cells.centres) == 1:
        assigned = queries.withColumn("cell", F.lit(0))
    else:
        assigned = steps.save(nearest_cell(queries, cells.centres, cells.metric, cells.p), "query-cells").drop("gap")
    counts = assigned.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(cells.block_rows)).cast("int").alias("blocks"))
    return split_blocks(assigned, counts, "qsub").withColumnRenamed("cell", "qcell")


def home_visits(queries: DataFrame, cells: Cells) -> DataFrame:
    """Each group of queries looks first at one block of its own cell."""
    table = F.broadcast(cells.block_table(queries).withColumnRenamed("cell", "qcell"))
    return (
        queries.join(table, "qcell")
        .withColumn("tcell", F.col("qcell"))
        .withColumn("tsub", F.col("qsub") % F.col("blocks"))
        .drop("blocks")
    )


def reached_cells(rows: DataFrame, cells: Cells, k: int) -> DataFrame:
    """Add ``targets``, the cells that a row's search radius ``bound`` reaches.

    Rows with an infinite bound first get the radius that surely holds ``k``
    points, read off the cell table.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, tiles.TILE_CELLS // len(cells.centres))
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                q = tiles.matrix(part.column("features"))
                hit, bound = cells.hits(q, part.column("bound").to_numpy(zero_copy_only=False), k)
                offsets = np.concatenate([[0], np.cumsum(hit.sum(axis=1))]).astype(np.int32)
                targets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(hit)[1].astype(np.int32)))
                columns = [pa.array(bound) if n == "bound" else part.column(n) for n in part.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, targets], names=[*part.schema.names, "targets"])

    return rows.mapInArrow(reach, ", ".join([*fields, "targets ARRAY<INT>"]))


def further_visits(reached: DataFrame, cells: Cells, seen: bool = True) -> DataFrame:
    """One row per (query, block to look at), without the block already seen."""
    table = F.broadcast(cells.block_table(reached).withColumnRenamed("cell", "tcell"))
    visits = (
        reached.withColumn("tcell", F.explode("targets"))
        .drop("targets")
        .join(table, "tcell")
        .withColumn("tsub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    if seen:
        own = table.withColumnRenamed("tcell", "qcell").withColumnRenamed("blocks", "qblocks")
        visits = visits.join(F.broadcast(own), "qcell").filter(
            (F.col("tcell") != F.col("qcell")) | (F.col("tsub") != F.col("qsub") % F.col("qblocks"))
        )
        visits = visits.drop("qblocks")
    return visits.drop("blocks")


def meet(
    visits: DataFrame,
    data: DataFrame,
    fn: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    keys: list[str] | None = None,
) -> DataFrame:
    """Bring each group of queries together with each block it looks at.

    ``data`` has (cell, sub, ...); both sides of a group hold at most a block.
    """
    keys = keys or []
    # Fresh aliases keep the two sides of the cogroup apart for the analyser.
    pairs = visits.select(*[F.col(c).alias(c) for c in [*keys, *PAIR_KEYS]]).distinct()
    blocks = data.withColumnRenamed("cell", "tcell").withColumnRenamed("sub", "tsub")
    blocks = blocks.join(pairs, [*keys, "tcell", "tsub"])
    blocks = blocks.select(*[F.col(c).alias(c) for c in blocks.columns])
    left = visits.groupBy(*keys, *PAIR_KEYS)
    return left.cogroup(blocks.groupBy(*keys, *PAIR_KEYS)).applyInArrow(fn, schema)
