"""Small NumPy helpers that compare two bounded blocks of rows inside a task.

``cosine`` never reaches these functions: callers scale rows to unit length and
use the euclidean distance, whose order is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

TILE_CELLS = 2_000_000  # distances held at once, 16 MB
FEW_COLUMNS = 8  # up to here differences are summed directly
PAIR_SLICE = 65_536  # pairs compared at once in direct form
CACHED_CELLS = 32_768  # differences held at once, which fit a core's cache
MOST_PRODUCTS = 16  # up to here a power is multiplied out


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type = np.float64) -> np.ndarray:
    """Rows of an Arrow list column as a 2-D array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(rows, -1) if rows else flat.reshape(0, 0), dtype=dtype)


def lists(values: np.ndarray) -> pa.ListArray:
    """A 2-D array as an Arrow list column."""
    rows, width = values.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32) if width else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def unit_rows(x: np.ndarray) -> np.ndarray:
    norms = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norms == 0, 1.0, norms)


def power(gap: np.ndarray, p: float) -> np.ndarray:
    """``gap ** p`` of numbers that are not negative; a small whole power is multiplied out, which is far quicker."""
    if p != int(p) or not 1 <= p <= MOST_PRODUCTS:
        return gap**p
    out = gap.copy()
    for bit in bin(int(p))[3:]:
        out *= out
        if bit == "1":
            out *= gap
    return out


def pair_distance(a: np.ndarray, b: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Distances of aligned rows, summed directly so that no digits cancel."""
    out = np.empty(len(a))
    for s in range(0, len(a), PAIR_SLICE):
        gap = np.abs(a[s : s + PAIR_SLICE] - b[s : s + PAIR_SLICE])
        if metric == "manhattan":
            out[s : s + PAIR_SLICE] = gap.sum(axis=1)
        elif metric == "chebyshev":
            out[s : s + PAIR_SLICE] = gap.max(axis=1)
        elif metric == "minkowski" and p != 2.0:
            out[s : s + PAIR_SLICE] = power(gap, p).sum(axis=1) ** (1.0 / p)
        else:
            out[s : s + PAIR_SLICE] = np.sqrt((gap * gap).sum(axis=1))
    return out


def tile_distance(q: np.ndarray, x: np.ndarray, metric: str, p: float) -> np.ndarray:
    """All distances between two blocks; euclidean may be off by :func:`slack`."""
    euclidean = metric == "euclidean" or (metric == "minkowski" and p == 2.0)
    if euclidean and q.shape[1] > FEW_COLUMNS:
        squares = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :]
        squares -= 2.0 * (q @ x.T)
        return np.sqrt(np.maximum(squares, 0.0, out=squares), out=squares)
    out = np.zeros((len(q), len(x)))
    columns = np.ascontiguousarray(x.T)
    step = max(1, CACHED_CELLS // max(1, len(x)))
    held = np.empty((min(step, len(q)), len(x)))
    for s in range(0, len(q), step):
        part, sums = q[s : s + step], out[s : s + step]
        gap = held[: len(part)]
        for d in range(q.shape[1]):
            np.subtract(part[:, d, None], columns[d], out=gap)
            if euclidean:
                gap *= gap
                sums += gap
                continue
            np.abs(gap, out=gap)
            if metric == "manhattan":
                sums += gap
            elif metric == "chebyshev":
                np.maximum(sums, gap, out=sums)
            else:
                sums += power(gap, p)
    if euclidean:
        return np.sqrt(out, out=out)
    return out ** (1.0 / p) if metric == "minkowski" else out


def slack(q: np.ndarray, x: np.ndarray) -> float:
    """Bound on the rounding error of :func:`tile_distance`.

    A squared distance carries an error of some ulps of the squared norms; its
    root, near zero, carries the root of that.
    """
    if not len(q) or not len(x):
        return 0.0
    scale = max(float((q * q).sum(axis=1).max()), float((x * x).sum(axis=1).max()))
    return float(np.sqrt(scale * q.shape[1] * 1e-15)) + 1e-300


def nearest(
    qid: np.ndarray,
    q: np.ndarray,
    xid: np.ndarray,
    x: np.ndarray,
    k: int,
    metric: str,
    p: float,
    skip_self: bool,
    below: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest rows of ``x`` for each row of ``q``, by (distance, id).

    ``below`` drops pairs farther than a bound known for each row of ``q``.
    Returns three aligned arrays: query id, neighbour id, distance.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(q) and len(x):
        centre = x.mean(axis=0)  # small numbers lose fewer digits in the tile
        near_q, near_x = q - centre, x - centre
        margin = slack(near_q, near_x)
        step = max(1, TILE_CELLS // len(x))
        for s in range(0, len(q), step):
            tile = tile_distance(near_q[s : s + step], near_x, metric, p)
            if skip_self:
                tile[qid[s : s + step, None] == xid[None, :]] = np.inf
            take = min(k, tile.shape[1])
            limit = np.partition(tile, take - 1, axis=1)[:, take - 1] + margin
            if below is not None:
                limit = np.minimum(limit, below[s : s + step] + margin)
            rows, cols = np.nonzero((tile <= limit[:, None]) & np.isfinite(tile))
            dist = np.empty(len(rows))
            for t in range(0, len(rows), PAIR_SLICE):
                part = slice(t, t + PAIR_SLICE)
                dist[part] = pair_distance(q[s + rows[part]], x[cols[part]], metric, p)
            ids = xid[cols]
            order = np.lexsort((ids, dist, rows))
            rows, ids, dist = rows[order], ids[order], dist[order]
            first = np.searchsorted(rows, rows, side="left")
            keep = np.arange(len(rows)) - first < k
            found.append((qid[s + rows[keep]], ids[keep], dist[keep]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(part) for part in zip(*found))  # type: ignore[return-value]


class Nearest:
    """The ``k`` nearest rows by (distance, id) of each row of a group, among rows offered a part at a time.

    ``bound`` is a distance within which ``k`` rows are known to lie, or infinity.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, metric: str, p: float, skip_self: bool, bound: np.ndarray):
        self.ids, self.x, self.k, self.metric, self.p, self.bound = ids, x, k, metric, p, bound.copy()
        self.dist = np.full((len(ids), k), np.inf)
        self.nbr = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.by_id = np.argsort(ids, kind="stable") if skip_self else None

    def _least(self, tile: np.ndarray) -> np.ndarray:
        """Of euclidean distances the least that a minkowski distance can be."""
        return tile * (self.x.shape[1] ** min(0.0, 1 / self.p - 0.5))

    def offer(self, rows: np.ndarray, xid: np.ndarray, x: np.ndarray) -> None:
        """Rows of ``x``, none of which was offered before, to the group's ``rows``."""
        if not len(rows) or not len(x):
            return
        centre = x.mean(axis=0)
        q, near_x = self.x[rows] - centre, x - centre
        margin = slack(q, near_x)
        mine = np.full(len(rows), -1)  # the column in which a row meets itself
        if self.by_id is not None:
            by_x = np.argsort(xid, kind="stable")
            at = np.minimum(np.searchsorted(xid[by_x], self.ids[rows]), len(xid) - 1)
            here = xid[by_x[at]] == self.ids[rows]
            mine[here] = by_x[at[here]]
        screened = self.metric == "minkowski" and self.p != 2.0 and q.shape[1] > FEW_COLUMNS
        step = max(1, TILE_CELLS // 4 // len(x))
        for s in range(0, len(rows), step):
            at = rows[s : s + step]
            bound, here = self.bound[at], np.flatnonzero(mine[s : s + step] >= 0)
            cheap = screened and np.isfinite(bound).all()
            tile = tile_distance(q[s : s + step], near_x, "euclidean" if cheap else self.metric, self.p)
            if cheap and np.count_nonzero(self._least(tile) <= (bound + margin)[:, None]) * 4 > tile.size:
                cheap, tile = False, tile_distance(q[s : s + step], near_x, self.metric, self.p)
            if cheap:
                tile = self._least(tile)
            tile[here, mine[s : s + step][here]] = np.inf
            unknown = np.flatnonzero(~np.isfinite(bound))
            if len(unknown) and len(x) >= self.k:
                bound[unknown] = np.partition(tile[unknown], self.k - 1, axis=1)[:, self.k - 1]
            r, c = np.nonzero((tile <= (bound + margin)[:, None]) & np.isfinite(tile))
            for t in range(0, len(r), 4 * PAIR_SLICE):
                self._merge(at[r[t : t + 4 * PAIR_SLICE]], x, xid, c[t : t + 4 * PAIR_SLICE])

    def _merge(self, row: np.ndarray, x: np.ndarray, xid: np.ndarray, c: np.ndarray) -> None:
        dist = np.empty(len(row))
        for t in range(0, len(row), PAIR_SLICE):
            part = slice(t, t + PAIR_SLICE)
            dist[part] = pair_distance(self.x[row[part]], x[c[part]], self.metric, self.p)
        nbr = xid[c]
        last, last_id = self.dist[row, -1], self.nbr[row, -1]
        better = (dist < last) | ((dist == last) & (nbr < last_id))
        row, dist, nbr = row[better], dist[better], nbr[better]
        if not len(row):
            return
        met = np.unique(row)
        rows = np.concatenate([np.repeat(met, self.k), row])
        dist = np.concatenate([self.dist[met].ravel(), dist])
        nbr = np.concatenate([self.nbr[met].ravel(), nbr])
        order = np.lexsort((nbr, dist, rows))
        rows = rows[order]
        order = order[np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < self.k]
        self.dist[met], self.nbr[met] = dist[order].reshape(-1, self.k), nbr[order].reshape(-1, self.k)
        self.bound[met] = np.minimum(self.bound[met], self.dist[met, -1])


def closer_rows(q: np.ndarray, x: np.ndarray, weight: np.ndarray, limits: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Weight of the rows of ``x`` strictly nearer to each row of ``q`` than each of its ``limits``, which ascend."""
    centre = x.mean(axis=0)
    near_q, near_x = q - centre, x - centre
    margin = slack(near_q, near_x)
    out = np.zeros(limits.shape, np.int64)
    alike = (weight == weight[0]).all()
    step = max(1, TILE_CELLS // 8 // len(x))
    for s in range(0, len(q), step):
        tile = tile_distance(near_q[s : s + step], near_x, metric, p)
        low, high = limits[s : s + step] - margin, limits[s : s + step] + margin
        sure, most = out[s : s + step], np.empty_like(out[s : s + step])
        if alike:
            for r, row in enumerate(np.sort(tile, axis=1)):
                sure[r], most[r] = np.searchsorted(row, low[r]), np.searchsorted(row, high[r], side="right")
            unsure = np.argwhere(most > sure)
            sure *= weight[0]
        else:
            for c in range(limits.shape[1]):
                sure[:, c], most[:, c] = (tile < low[:, c, None]) @ weight, (tile <= high[:, c, None]) @ weight
            unsure = np.argwhere(most > sure)
        for r, c in unsure:
            o = np.flatnonzero((tile[r] >= low[r, c]) & (tile[r] <= high[r, c]))
            near = pair_distance(np.broadcast_to(q[s + r], (len(o), q.shape[1])), x[o], metric, p) < limits[s + r, c]
            sure[r, c] += weight[o[near]].sum()
    return out
