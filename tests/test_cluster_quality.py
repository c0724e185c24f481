from pathlib import Path

import numpy as np
import pytest
from helpers import embedding, gaps, points
from pyspark.sql import functions as F

from lowfold.operators.clustering import cluster
from lowfold.operators.components import components
from lowfold.operators.density import core_distances, hdbscan, select_clusters, spanning_tree
from lowfold.operators import quality
from lowfold.operators.quality import silhouette, trustworthiness
from lowfold.session import StepStore
from lowfold.session import StepStore

RNG = np.random.default_rng(1)
SPOTS = np.concatenate(
    [RNG.normal(0, 0.3, (60, 2)), RNG.normal(3, 0.2, (40, 2)), RNG.uniform(-3, 6, (30, 2)), np.repeat([[1.0, 5.0]], 20, 0)]
)


def brute_tree(x, m):
    d = gaps(x, x)
    core = np.sort(d, axis=1)[:, m - 1]
    reach = np.maximum(np.maximum(d, core[:, None]), core[None])
    i, j = np.triu_indices(len(x), 1)
    root, tree = list(range(len(x))), []

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for t in np.lexsort((j, i, reach[i, j])):
        a, b = find(i[t]), find(j[t])
        if a != b:
            root[a] = b
            tree.append((int(i[t]), int(j[t]), float(reach[i[t], j[t]])))
    return tree


def brute_clusters(x, m):
    """Condense the hierarchy from the top and keep the most stable clusters."""
    n, tree = len(x), sorted(brute_tree(x, m), key=lambda e: e[2])
    members, kids, height = {i: [i] for i in range(n)}, {}, {}
    of = {i: i for i in range(n)}
    for name, (a, b, w) in enumerate(tree, start=n):
        left, right = of[a], of[b]
        members[name], kids[name], height[name] = members[left] + members[right], (left, right), w
        for v in members[name]:
            of[v] = name

    def lam(node):
        return 1 / height[node] if height[node] > 0 else float("inf")

    def solve(node, birth, is_root):
        top_node = node
        own = 0.0
        while True:
            left, right = kids[node]
            big = [k for k in (left, right) if len(members[k]) >= m]
            stay = birth < float("inf")
            if len(big) == 2:
                own += len(members[node]) * (lam(node) - birth) if stay else 0
                parts = [solve(k, lam(node), False) for k in big]
                break
            own += (len(members[node]) - sum(len(members[k]) for k in big)) * (lam(node) - birth) if stay else 0
            if not big:
                parts = []
                break
            node = big[0]
        below = sum(p[0] for p in parts)
        if not is_root and (not parts or own >= below):
            return own, [top_node]
        return below, [c for p in parts for c in p[1]]

    labels = -np.ones(n, int)
    for number, c in enumerate(solve(n + len(tree) - 1, 0.0, True)[1]):
        labels[members[c]] = number
    return labels


def same(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b)) and ((a == -1) == (b == -1)).all()


@pytest.mark.parametrize("block_rows", [8192, 25])
def test_spanning_tree_weight(spark, block_rows):
    df = points(spark, SPOTS)
    core = core_distances(df, 5, block_rows=block_rows)
    tree = spanning_tree(df, core, StepStore(spark, "test"), block_rows=block_rows, list_rows=6).toPandas()
    want = brute_tree(SPOTS, 5)
    assert len(tree) == len(SPOTS) - 1
    assert np.allclose(np.sort(tree.w), np.sort([w for *_, w in want]))


@pytest.mark.parametrize("settings", [{}, {"limit": 20}, {"block_rows": 25, "limit": 20}])
def test_hdbscan_matches_brute_force(spark, settings):
    got = hdbscan(embedding(spark, SPOTS), 5, **settings).toPandas().sort_values("id").cluster.to_numpy()
    want = brute_clusters(SPOTS, 5)
    assert len(set(want)) > 2 and same(got, want)


def test_every_cluster_is_large_enough(spark):
    got = hdbscan(embedding(spark, SPOTS), 8).filter("cluster >= 0").groupBy("cluster").count().collect()
    assert got and min(r["count"] for r in got) >= 8


def test_hdbscan_small_input(spark):
    got = hdbscan(embedding(spark, [[0, 0], [1, 1]]), 5).collect()
    assert [r.cluster for r in got] == [-1, -1]


def test_selection_by_joins_equals_one_group(spark):
    rows, rng = [(31, None, 0.0)], np.random.default_rng(9)
    for c in range(31):  # children have smaller numbers than their parent
        rows.append((c, (c + 32) // 2 if c < 30 else 31, float(rng.random())))
    stability = spark.createDataFrame(rows, "cluster BIGINT, parent BIGINT, stability DOUBLE")
    one = {r.cluster: r.label for r in select_clusters(stability, StepStore(spark, "t")).collect()}
    many = {r.cluster: r.label for r in select_clusters(stability, StepStore(spark, "t"), limit=3).collect()}
    assert one == many and any(v is not None for v in one.values())


def _chosen(spark, parents, stability, limit):
    rows = [(c, p, float(v)) for c, (p, v) in enumerate(zip(parents, stability, strict=True))]
    table = spark.createDataFrame(rows, "cluster BIGINT, parent BIGINT, stability DOUBLE")
    store = StepStore(spark, "t")
    got = {r.cluster: r.label for r in select_clusters(table, store, limit).collect()}
    assert len(got) == len(rows)
    return got, store._count


@pytest.mark.parametrize("shape", ["chain", "star", "random", "two_arms", "alone"])
def test_contraction_equals_one_group(spark, shape):
    rng, n = np.random.default_rng(3), 1 if shape == "alone" else 240
    parents = {
        "chain": [c + 1 for c in range(n - 1)],
        "star": [n - 1] * (n - 1),
        "random": [int(rng.integers(c + 1, min(n, c + 9))) for c in range(n - 1)],
        "two_arms": [min(c + 2, n - 1) for c in range(n - 1)],
        "alone": [],
    }[shape] + [None]
    stability = rng.integers(0, 40, n) * rng.integers(0, 40, n)  # whole numbers, so that ties are ties in any order of sums
    one, _ = _chosen(spark, parents, stability, n)
    many, _ = _chosen(spark, parents, stability, 0)
    assert one == many


def test_contraction_takes_endless_stability(spark):
    parents, stability = [4, 4, 5, 5, 6, 6, None], [float("inf"), 2, 3, 4, float("inf"), 8, 0]
    assert _chosen(spark, parents, stability, 7)[0] == _chosen(spark, parents, stability, 0)[0]


def test_a_long_chain_takes_few_rounds(spark):
    n, rng = 5000, np.random.default_rng(5)
    # Even clusters form the chain, each with a leaf of its own before it.
    parents = [c + 1 if c % 2 == 0 else c + 2 for c in range(2 * n - 1)]
    parents = [p if p < 2 * n - 1 else None for p in parents]
    stability = rng.integers(1, 50, 2 * n - 1) * np.where(np.arange(2 * n - 1) % 2, np.arange(1, 2 * n), 1)
    one, _ = _chosen(spark, parents, stability, 2 * n)
    many, written = _chosen(spark, parents, stability, 0)
    assert one == many and len(set(one.values())) > 20
    assert written < 40  # one a round of contraction and one a round of doubling


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(100, 5)]
    got = components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT"), StepStore(spark, "t")).toPandas()
    assert len(got) == 41 and got.node.is_unique
    want = {i: i // 10 * 10 for i in range(40)} | {100: 0}
    assert dict(zip(got.node, got.label)) == want


def test_kmeans_rows_at_nearest_centre(spark):
    got = cluster(embedding(spark, SPOTS), "KMeans", 4).toPandas().sort_values("id").cluster.to_numpy()
    centres = np.stack([SPOTS[got == c].mean(0) for c in range(4)])
    assert (np.argmin(gaps(SPOTS, centres), axis=1) == got).mean() > 0.95


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        cluster(embedding(spark, SPOTS), "other", 4)


def brute_trust(x, y, k):
    n, d, e = len(x), gaps(x, x), gaps(y, y)
    np.fill_diagonal(d, np.inf)
    np.fill_diagonal(e, np.inf)
    near = np.argsort(e, axis=1, kind="stable")[:, :k]
    rank = np.array([[1 + (d[i] < d[i, j]).sum() for j in near[i]] for i in range(n)])
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(0, rank - k).sum()


@pytest.mark.parametrize("block_rows", [8192, 30])
def test_trustworthiness(spark, block_rows):
    x = RNG.normal(size=(100, 4))
    x[:30] = x[0] + RNG.normal(size=(30, 4)) * 1e-3
    x[40:50] = x[40]
    y = x[:, :2] + RNG.normal(size=(100, 2)) * 0.3
    got = trustworthiness(points(spark, x), embedding(spark, y), 7, block_rows=block_rows).first()[0]
    assert got == pytest.approx(brute_trust(x, y, 7), abs=1e-12)
    with pytest.raises(ValueError):
        trustworthiness(points(spark, x), embedding(spark, y), 50)


def brute_silhouette(y, labels):
    d, out = gaps(y, y), []
    for i in range(len(y)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(out)


@pytest.mark.parametrize("block_rows", [8192, 30])
def test_silhouette(spark, block_rows):
    labels = np.concatenate([np.zeros(60), np.ones(40), np.full(30, -1), np.full(19, 2), [7]]).astype(int)
    clusters = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "id BIGINT, cluster INT")
    got = silhouette(embedding(spark, SPOTS), clusters, block_rows=block_rows).first()[0]
    assert got == pytest.approx(brute_silhouette(SPOTS, labels), abs=1e-10)
    keep = labels >= 0
    quiet = silhouette(embedding(spark, SPOTS), clusters, exclude_noise=True, block_rows=block_rows).first()[0]
    assert quiet == pytest.approx(brute_silhouette(SPOTS[keep], labels[keep]), abs=1e-10)


def test_silhouette_needs_two_clusters(spark):
    one = embedding(spark, SPOTS).select("id", F.lit(0).alias("cluster"))
    assert silhouette(embedding(spark, SPOTS), one).first()[0] is None


def _blobs(k, n, gap):
    """``k`` clusters of ``n`` rows along a line, farther apart the farther out."""
    rng = np.random.default_rng(8)
    middles = np.array([(i**1.5 * gap, 0.0) for i in range(k)])
    return (middles[:, None] + rng.normal(size=(k, n, 2))).reshape(-1, 2), np.repeat(np.arange(k), n)


@pytest.mark.parametrize("gap", [0.5, 3.0, 40.0])
@pytest.mark.parametrize("centroids", [4, 8192])
def test_silhouette_sums_only_clusters_within_reach(spark, monkeypatch, gap, centroids):
    monkeypatch.setattr(quality, "MOST_CENTROIDS", centroids)
    y, labels = _blobs(30, 20, gap)
    clusters = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "id BIGINT, cluster INT")
    steps = StepStore(spark, "blobs")
    rows = quality.silhouette_rows(embedding(spark, y), clusters, steps, block_rows=5)
    got = rows.toPandas()
    assert (got.s * got.copies).sum() / got.copies.sum() == pytest.approx(brute_silhouette(y, labels), abs=1e-9)
    built = sum(spark.read.parquet(str(p)).count() for p in Path(steps.root).glob("*-pairs"))
    if gap == 40.0:  # each of 120 blocks meets the 4 blocks of its own cluster and those of the nearest
        assert built < 0.1 * 120 * 120


def test_silhouette_of_a_drawn_share(spark):
    y, labels = _blobs(6, 200, 6.0)
    clusters = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "id BIGINT, cluster INT")
    got = silhouette(embedding(spark, y), clusters, share=0.3).first()[0]
    assert got == pytest.approx(brute_silhouette(y, labels), abs=0.03)
    assert silhouette(embedding(spark, y), clusters, share=0.0).first()[0] is None
