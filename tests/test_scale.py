"""What is shuffled and computed grows with the rows, not with the number of blocks that rows look at."""

import time
from pathlib import Path

import numpy as np
import pytest
from helpers import as_lists, brute_knn, embedding, gaps, points
from pyspark.sql import functions as F

from lowfold import silhouette
from lowfold.functions import tiles
from lowfold.operators import density
from lowfold.operators.cells import Cells
from lowfold.operators.knn import knn_query, knn_self
from lowfold.operators.sweep import near_groups
from lowfold.session import FREE_SHUFFLES, StepStore

RNG = np.random.default_rng(31)


def shuffled(spark):
    """Bytes of shuffle files that this session has kept so far."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.stat().st_size for d in folders for f in Path(d.getPath()).rglob("shuffle_*") if f.is_file())


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_small_blocks_are_not_copied_for_each_row(spark, metric):
    x = RNG.normal(size=(1500, 24))
    before = shuffled(spark)
    nbr, dist = as_lists(knn_self(points(spark, x), 5, metric, block_rows=16), 1500, 5)
    assert shuffled(spark) - before < 40 * x.nbytes
    want, least = brute_knn(x, 5, metric)
    assert (nbr == want).all() and np.allclose(dist, least, rtol=1e-12)


def test_query_rows_meet_far_blocks_and_short_ones(spark):
    """A row whose own block holds fewer than k rows has no bound of its own and still finds the k nearest."""
    x, q = np.concatenate([RNG.normal(size=(400, 3)), RNG.normal(50, 1, (3, 3))]), RNG.normal(50, 1, (40, 3))
    nbr, dist = as_lists(knn_query(points(spark, q), points(spark, x), 9, block_rows=32), 40, 9)
    d = gaps(q, x)
    assert (nbr == np.argsort(d, axis=1, kind="stable")[:, :9]).all() and np.allclose(dist, np.sort(d, axis=1)[:, :9])


@pytest.mark.parametrize("metric,p", [("euclidean", 2.0), ("manhattan", 2.0), ("chebyshev", 2.0), ("minkowski", 3.0), ("minkowski", 1.5)])
@pytest.mark.parametrize("bounded", [False, True])
def test_lists_of_rows_offered_in_parts(metric, p, bounded):
    x = (10 * RNG.normal(size=(500, 12))).round()  # whole numbers, whose sums are exact
    x[100:120] = x[3]  # ties
    gap = np.abs(x[:, None] - x[None])
    d = {"euclidean": (gap**2).sum(-1) ** 0.5, "manhattan": gap.sum(-1), "chebyshev": gap.max(-1), "minkowski": (gap**p).sum(-1) ** (1 / p)}[metric]
    np.fill_diagonal(d, np.inf)
    d = d.round(9)
    bound = np.sort(d, axis=1)[:, 6] + 1e-6 if bounded else np.full(500, np.inf)
    near = tiles.Nearest(np.arange(500), x, 7, metric, p, True, bound)
    for part in np.array_split(RNG.permutation(500), 9):
        near.offer(np.arange(500), part, x[part])
    want = np.array([np.lexsort((np.arange(500), row))[:7] for row in d])
    assert np.allclose(near.dist, np.take_along_axis(d, want, 1), atol=1e-8)
    if metric != "minkowski":  # sums of powers may differ in the last digit, which parts ties
        assert (near.nbr == want).mean() > 0.99


def test_groups_hold_near_cells_once():
    centres, rows = RNG.normal(size=(97, 2)), RNG.integers(1, 40, 97)
    groups = near_groups(centres, rows, 200)
    assert sorted(np.concatenate(groups)) == list(range(97))
    assert max(rows[g].sum() for g in groups) <= 240 and len(groups) <= 2 * rows.sum() / 200
    assert sorted(np.concatenate(near_groups(np.zeros((5, 2)), rows[:5], 0))) == list(range(5))


def test_a_sure_radius_of_some_cells_is_still_sure():
    x = RNG.normal(size=(60, 2))
    cells = Cells(x[:6], np.full(6, 0.5), np.full(6, 10), "euclidean", 2.0, 16)
    whole, part = cells.hits(x, np.full(60, np.inf), 15)[1], cells.part(np.array([1, 4])).hits(x, np.full(60, np.inf), 15)[1]
    assert (part >= whole - 1e-9).all()


def test_a_whole_power_is_multiplied_out():
    gap = RNG.random((3, 400))
    for p in (1.0, 2.0, 3.0, 7.0, 16.0, 17.0, 2.5):
        assert np.allclose(tiles.power(gap, p), gap**p, rtol=1e-13)
    a, b = RNG.normal(size=(400, 64)), RNG.normal(size=(3000, 64))

    def seconds(p):
        start = time.perf_counter()
        tiles.tile_distance(a, b, "minkowski", p)
        return time.perf_counter() - start

    assert min(seconds(3.0) for _ in range(3)) * 2 < min(seconds(3.1) for _ in range(3))


@pytest.mark.parametrize("most", [1, 3])
def test_closer_rows_are_counted_by_weight(most):
    x, q = (4 * RNG.normal(size=(300, 12))).round(), (4 * RNG.normal(size=(40, 12))).round()
    weight = RNG.integers(1, most + 1, 300)
    d = gaps(q, x)
    limits = np.sort(d, axis=1)[:, [0, 4, 5, 90, 299]]
    want = ((d[:, :, None] < limits[:, None]) * weight[None, :, None]).sum(1)
    assert (tiles.closer_rows(q, x, weight, limits, "euclidean", 2.0) == want).all()


def test_silhouette_ships_a_cluster_once_to_a_group(spark):
    y, labels = RNG.normal(size=(1500, 24)), RNG.integers(0, 3, 1500)
    clusters = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "id BIGINT, cluster INT")
    before = shuffled(spark)
    got = silhouette(embedding(spark, y), clusters, block_rows=16).first()[0]
    assert shuffled(spark) - before < 15 * y.nbytes
    d, same = gaps(y, y), labels[:, None] == np.arange(3)
    means = d @ same / (same.sum(0) - np.eye(3)[labels])
    a = means[same]
    b = np.where(same, np.inf, means).min(1)
    assert got == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-9)


def test_shuffle_files_of_a_step_are_freed(spark):
    steps, before = StepStore(spark, "freed"), shuffled(spark)
    held = spark.conf.get(FREE_SHUFFLES)
    for k in range(4):
        rows = spark.range(300_000).repartition(4, F.col("id") + k)
        assert steps.save(rows, "rows").count() == 300_000
    for _ in range(50):  # they go in the background
        if shuffled(spark) - before < 1_000_000:
            break
        time.sleep(0.1)
    assert shuffled(spark) - before < 1_000_000
    assert spark.conf.get(FREE_SHUFFLES) == held
    with pytest.raises(Exception, match="exists"):
        steps._write(spark.range(1), f"{steps.root}/0000-rows")
    assert spark.conf.get(FREE_SHUFFLES) == held


def test_tree_search_does_not_copy_rows_for_each_cell(spark):
    x = RNG.normal(size=(700, 16))
    df, steps = points(spark, x), StepStore(spark, "tree")
    core = steps.save(density.core_distances(df, 5), "core")
    one = density.spanning_tree(df, core, steps).toPandas()
    many = density.spanning_tree(df, core, steps, list_rows=2, block_rows=8).toPandas()
    assert sorted(zip(one.lo, one.hi, one.w.round(9))) == sorted(zip(many.lo, many.hi, many.w.round(9)))
    left = max((sum(f.stat().st_size for f in d.rglob("*.parquet")) for d in Path(steps.root).glob("*-reached")), default=0)
    assert left < x.nbytes
