import numpy as np
import pytest
from helpers import as_lists, brute_knn, points
from pyspark.sql import functions as F

from lowfold.operators import descent, forest
from lowfold.operators.cells import build_cells
from lowfold.operators.descent import knn_descent
from lowfold.operators.knn import knn_graph, knn_query, knn_self, merge_top_k, reverse_graph
from lowfold.session import StepStore

RNG = np.random.default_rng(7)


def test_grid_with_ties(spark):
    nbr, dist = as_lists(knn_self(points(spark, [[0], [1], [2], [3], [4]]), 2), 5, 2)
    assert [set(row) for row in nbr.tolist()] == [{1, 2}, {0, 2}, {1, 3}, {2, 4}, {2, 3}]
    assert dist.tolist() == [[1, 2], [1, 1], [1, 1], [1, 1], [1, 2]]


def test_query_against_train(spark):
    train = points(spark, [[0, 0], [1, 0], [3, 3]])
    found = knn_query(points(spark, [[0.1, 0.1]]), train, 2).orderBy("rank").collect()
    assert [r.nbr for r in found] == [0, 1]
    assert np.allclose([r.dist for r in found], [np.hypot(0.1, 0.1), np.hypot(0.9, 0.1)])


def test_query_matches_its_equal_and_cuts_k(spark):
    train = points(spark, [[0, 0], [1, 0], [3, 3]])
    nbr, dist = as_lists(knn_query(train, train, 9), 3, 3)
    assert nbr[:, 0].tolist() == [0, 1, 2] and (dist[:, 0] == 0).all()


def test_no_self_and_positive(spark):
    nbr, dist = as_lists(knn_self(points(spark, RNG.random((15, 2))), 5), 15, 5)
    assert (nbr != np.arange(15)[:, None]).all() and (dist > 0).all()


def test_manhattan(spark):
    _, dist = as_lists(knn_self(points(spark, [[0, 0], [1, 0], [0, 2]]), 2, "manhattan"), 3, 2)
    assert dist[0].tolist() == [1, 2]


def test_too_many_neighbours(spark):
    with pytest.raises(ValueError):
        knn_self(points(spark, [[0], [1]]), 2)


def test_bad_names(spark):
    df = points(spark, [[0], [1], [2]])
    with pytest.raises(ValueError):
        knn_graph(df, 1, method="other")
    with pytest.raises(ValueError):
        knn_graph(df, 1, metric="other")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "cosine"])
def test_many_blocks_match_brute_force(spark, metric):
    x = np.concatenate([RNG.normal(0, 1, (150, 3)), RNG.normal(6, 0.1, (150, 3))])
    nbr, dist = as_lists(knn_self(points(spark, x), 7, metric, block_rows=40), 300, 7)
    want, gap = brute_knn(x, 7, metric)
    assert np.allclose(dist, gap, atol=1e-9)
    assert (nbr == want).mean() > 0.999


def test_hot_group_of_copies(spark):
    x = RNG.normal(size=(240, 2))
    x[:80] = x[0]
    nbr, _ = as_lists(knn_self(points(spark, x), 6, block_rows=50), 240, 6)
    assert (nbr == brute_knn(x, 6)[0]).all()
    assert nbr[3].tolist() == [0, 1, 2, 4, 5, 6]


def test_query_many_blocks(spark):
    x, q = RNG.normal(size=(300, 4)), RNG.normal(size=(120, 4))
    q[:50] = x[0]
    found = knn_query(points(spark, q), points(spark, x), 5, block_rows=30)
    nbr, _ = as_lists(found, 120, 5)
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(-1))
    assert (nbr == np.argsort(d, axis=1, kind="stable")[:, :5]).all()


def test_large_offset_keeps_digits(spark):
    x = RNG.normal(size=(60, 10)) + 1e6
    nbr, dist = as_lists(knn_self(points(spark, x), 4), 60, 4)
    want, gap = brute_knn(x, 4)
    assert (nbr == want).all() and np.allclose(dist, gap, rtol=1e-12)


def test_blocks_are_bounded(spark):
    x = RNG.normal(size=(300, 2))
    x[:120] = 0.5
    steps = StepStore(spark, "test")
    cells, placed = build_cells(points(spark, x), "euclidean", 2.0, steps, 40)
    counts = [r["count"] for r in placed.groupBy("cell", "sub").count().collect()]
    assert sum(counts) == 300 == cells.total
    assert max(counts) <= 80  # a draw spreads a split cell evenly but for chance


def test_reverse_and_merge(spark):
    near = spark.createDataFrame([(0, 1, 2.0, 1), (1, 2, 1.0, 1)], "id BIGINT, nbr BIGINT, dist DOUBLE, rank INT")
    back = {(r.id, r.nbr, r.dist) for r in reverse_graph(near).collect()}
    assert back == {(1, 0, 2.0), (2, 1, 1.0)}
    merged = merge_top_k(near, near.unionByName(near.selectExpr("id", "nbr + 5 AS nbr", "dist - 0.5 AS dist", "rank")), 2)
    assert sorted((r.id, r.nbr, r["rank"]) for r in merged.collect()) == [(0, 1, 2), (0, 6, 1), (1, 2, 2), (1, 7, 1)]


def test_descent_recall_and_hub_path(spark):
    x = RNG.normal(size=(300, 5))
    want = {(i, j) for i, row in enumerate(brute_knn(x, 8)[0]) for j in row}
    plain = knn_descent(points(spark, x), 8).toPandas()
    assert len(want & set(zip(plain.id, plain.nbr))) / len(want) > 0.97
    hubs = knn_descent(points(spark, x), 8, hub_rows=20, block_rows=100).toPandas()
    order = ["id", "rank"]
    assert plain.sort_values(order).nbr.tolist() == hubs.sort_values(order).nbr.tolist()


def test_descent_full_width(spark):
    nbr, dist = as_lists(knn_descent(points(spark, [[0], [1], [3], [7]]), 3, tol=0), 4, 3)
    assert np.isfinite(dist).all() and nbr[0].tolist() == [1, 2, 3]


def test_forest_leaves(spark):
    """Each row in one leaf of each tree; copies of one vector are spread, so no leaf is much over its size."""
    x = np.concatenate([RNG.normal(size=(1500, 6)), np.ones((700, 6)), np.zeros((300, 6))])
    got = forest.leaves(points(spark, x), len(x), 6, 3, 100, 5, StepStore(spark, "forest")).toPandas()
    assert len(got) == 3 * len(x) == len(got.drop_duplicates(["tree", "id"]))
    sizes = got.groupby(["tree", "leaf"]).size()
    assert sizes.max() <= 110 and sizes.min() >= 20
    assert forest.fans(100, 100) == [] and forest.fans(101, 100) == [2] and forest.fans(100 * 16, 100) == [4, 4]


def test_a_forest_saves_most_of_the_changes(spark):
    """Equal recall from fewer rounds that change a quarter of the entries at most."""
    x = RNG.normal(size=(2500, 12))
    want = {(i, j) for i, row in enumerate(brute_knn(x, 10)[0]) for j in row}
    recall, rounds = {}, {}
    for start in ("random", "forest"):
        rounds[start] = []
        got = knn_descent(points(spark, x), 10, start=start, changed=rounds[start]).toPandas()
        recall[start] = len(want & set(zip(got.id, got.nbr))) / len(want)
    assert recall["forest"] >= recall["random"] - 0.002 and recall["forest"] > 0.98
    assert len(rounds["forest"]) < len(rounds["random"]) and 4 * sum(rounds["forest"]) <= sum(rounds["random"])
    with pytest.raises(ValueError, match="start"):
        knn_descent(points(spark, x), 10, start="tree")


@pytest.mark.parametrize("hub_rows", [1024, 33])
def test_tightened_offers_leave_the_round_as_it_is(spark, hub_rows):
    """Most offers are left out before they are shuffled, none that stays on a list; copies, short lists and groups around hubs included."""
    x = np.random.default_rng(5).normal(size=(300, 12))
    x[40:60] = x[40]
    data, width = points(spark, x), 10
    pairs = descent.seed_pairs(data, 300, width, 1)
    pairs = pairs.filter("id <> 7 or nbr % 2 = 0").unionByName(spark.sql("SELECT id, 3L AS nbr FROM range(4, 60)")).distinct()
    lists = StepStore(spark, "test").save(descent.pair_distances(pairs, data, "euclidean", 2.0).withColumn("is_new", F.lit(1)), "lists")
    got = [
        sorted(map(tuple, descent.descent_round(data, lists, width, "euclidean", 2.0, StepStore(spark, "test"), {}, hub_rows, 64, tighten).collect()))
        for tighten in (True, False)
    ]
    assert got[0] == got[1] and len(got[0]) == 300 * width

    full = lists.groupBy("id").agg(F.max("dist").alias("bound"))
    members = descent.group_members(lists).join(data, "id").join(full, "id").select("c", "id", "features", "bound")
    offers = [descent._offers(members, 40, width, "euclidean", 2.0, *some).count() for some in ((lists,), ())]
    assert offers[0] * 3 < offers[1]
