"""Groups of rows that stay in a task while the rows they have to meet stream past.

A row that must look at many blocks is not copied for each of them. Rows of near
cells form a group; a group is sent once, and each cell that one of its rows
reaches is sent once to the group. A task holds one group and a few thousand of
the streamed rows, and what it found leaves it when the stream ends. So what is
shuffled is the rows times the number of groups, however small the blocks are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowfold.functions import tiles
from lowfold.functions.draws import draw
from lowfold.operators import cells as C

GROUP_BYTES = 32 << 20  # vectors of a group
FOLD_ROWS = 4096  # streamed rows that a group meets at once
MAX_TASKS = 4096


class Meeting(Protocol):
    """One group in a task."""

    def fold(self, table: pa.Table) -> None: ...

    def finish(self) -> Iterator[pa.RecordBatch]: ...


def group_rows(like: DataFrame, total: int, width: int, block_rows: int) -> int:
    """Most rows of a group: two groups a core where there are rows enough, but no more than fit a task."""
    share = math.ceil(total / (2 * like.sparkSession.sparkContext.defaultParallelism))
    return max(1, min(GROUP_BYTES // (8 * max(1, width)), max(block_rows // 2, share)))


def near_groups(centres: np.ndarray, rows: np.ndarray, most: int) -> list[np.ndarray]:
    """Cells in groups of near ones, each with about ``most`` rows, or one cell with more."""
    stack, groups = [np.arange(len(centres))], []
    while stack:
        cells = stack.pop()
        total = int(rows[cells].sum())
        parts = math.ceil(total / most) if most else len(cells)
        if len(cells) == 1 or parts <= 1:
            groups.append(cells)
            continue
        cells = cells[np.argsort(centres[cells, centres[cells].var(axis=0).argmax()], kind="stable")]
        held = np.cumsum(rows[cells]) if most else np.arange(1, len(cells) + 1)
        cut = int(np.searchsorted(held, held[-1] * (parts // 2) / parts))
        cut = min(max(cut, 1), len(cells) - 1)
        stack += [cells[cut:], cells[:cut]]
    return groups


def dealt_groups(rows: DataFrame, cells: C.Cells, most: int, column: str = "qcell") -> tuple[DataFrame, int]:
    """Add ``group`` to rows that lie in a cell; also the number of groups."""
    counts = np.zeros(len(cells.centres), np.int64)
    for cell, n in rows.groupBy(column).count().collect():
        counts[cell] = n
    table, first = [], 0
    for members in near_groups(cells.centres, counts, most):
        pieces = max(1, math.ceil(int(counts[members].sum()) / most))
        table += [(int(c), first, pieces) for c in members]
        first += pieces
    deal = rows.sparkSession.createDataFrame(table, f"{column} INT, _first INT, _pieces INT")
    piece = (draw("pivot", 7, 0, F.col("id"), F.lit(0)) % F.col("_pieces")).cast("int")
    return rows.join(F.broadcast(deal), column).withColumn("group", F.col("_first") + piece).drop("_first", "_pieces"), first


def reached_by_groups(rows: DataFrame, hits: Callable[[pa.RecordBatch], np.ndarray], size: int) -> DataFrame:
    """``(group, tcell)`` for the cells that some row of a group reaches.

    ``hits`` gives a matrix of rows and the ``size`` cells for a batch of ``rows``.
    """

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, tiles.TILE_CELLS // size)
        for batch in batches:
            found: dict[int, np.ndarray] = {}
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                group, hit = part.column("group").to_numpy(), hits(part)
                for g in np.unique(group):
                    found[g] = found.get(g, False) | hit[group == g].any(axis=0)
            for g, any_row in found.items():
                to = np.flatnonzero(any_row).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(to), g, np.int32)), pa.array(to)], names=["group", "tcell"])

    return rows.mapInArrow(reach, "group INT, tcell INT").distinct()


def streamed(data: DataFrame, pairs: DataFrame, cells: C.Cells) -> DataFrame:
    """Rows of ``data(cell, ...)`` once for each group that reaches their cell, with ``place``, the cell's place among near ones."""
    order = np.concatenate(near_groups(cells.centres, cells.rows, 0))
    places = [(int(c), k) for k, c in enumerate(order)]
    table = data.sparkSession.createDataFrame(places, "tcell INT, place INT")
    wanted = pairs.groupBy("tcell").agg(F.collect_list("group").alias("_groups")).join(F.broadcast(table), "tcell")
    met = data.withColumnRenamed("cell", "tcell").join(F.broadcast(wanted), "tcell")
    return met.withColumn("group", F.explode("_groups")).drop("_groups", "tcell", "sub")


def sweep(left: DataFrame, right: DataFrame, groups: int, begin: Callable[[pa.Table], Meeting], schema: str) -> DataFrame:
    """``begin`` takes the rows of ``left`` of one group and meets those of ``right``, in the order of ``place``."""
    both = left.withColumn("place", F.lit(-1)).unionByName(right, allowMissingColumns=True)
    tasks = min(groups, MAX_TASKS)
    dealt = both.repartitionById(tasks, (F.col("group") % tasks).cast("int")).sortWithinPartitions("group", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        mine: list[pa.RecordBatch] = []
        held: list[pa.RecordBatch] = []
        meeting: Meeting | None = None

        def meet() -> Meeting | None:
            nonlocal meeting
            if meeting is None and mine:
                meeting = begin(pa.Table.from_batches(mine))
                mine.clear()
            if meeting is not None and held:
                meeting.fold(pa.Table.from_batches(held))
            held.clear()
            return meeting

        for batch in batches:
            group, place = batch.column("group").to_numpy(), batch.column("place").to_numpy()
            edge = np.flatnonzero((np.diff(group) != 0) | (np.diff(place < 0))) + 1
            for s, e in zip([0, *edge], [*edge, len(group)]):
                if s == e:
                    continue
                if group[s] != now:
                    if meet() is not None:
                        yield from meeting.finish()
                    now, meeting = group[s], None
                if place[s] < 0:
                    mine.append(batch.slice(s, e - s))
                    continue
                for t in range(s, e, FOLD_ROWS):
                    held.append(batch.slice(t, min(FOLD_ROWS, e - t)))
                    if sum(b.num_rows for b in held) >= FOLD_ROWS:
                        meet()
        if meet() is not None:
            yield from meeting.finish()

    return dealt.mapInArrow(run, schema)
