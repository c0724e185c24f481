"""One result whatever the block size, and no rows lost in silence."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from helpers import embedding, points, positions
from pyspark.sql import functions as F

from lowfold import Umap, silhouette, trustworthiness
from lowfold.operators import density, fuzzy, knn, prepare, requests
from lowfold.operators.descent import knn_descent
from lowfold.session import StepStore
from lowfold.sources.runs import RunLog, read_runs
from lowfold.streaming.requests import LOG_SCHEMA, stream_rollup

RNG = np.random.default_rng(21)
GRID = np.array([[i, j] for i in range(9) for j in range(9)], float)  # distances tie everywhere


@pytest.mark.parametrize("block_rows", [16, 40])
def test_one_tree_of_a_tied_grid(spark, block_rows):
    df = points(spark, GRID)
    trees, labels = [], []
    for rows in (8192, block_rows):
        steps = StepStore(spark, "test")
        core = steps.save(density.core_distances(df, 4, block_rows=rows), "core")
        tree = density.spanning_tree(df, core, steps, block_rows=rows, list_rows=5).toPandas()
        trees.append(sorted(zip(tree.lo, tree.hi, tree.w.round(9))))
        labels.append(density.hdbscan(embedding(spark, GRID), 4, block_rows=rows).toPandas().sort_values("id").cluster.tolist())
    assert trees[0] == trees[1] and labels[0] == labels[1]


def test_one_fit_of_many_epochs(spark):
    df = points(spark, RNG.normal(size=(80, 4)))
    one = Umap(n_neighbors=6).fit(df, "id", "features", n_epochs=20)
    many = Umap(n_neighbors=6, block_rows=45).fit(df, "id", "features", n_epochs=20)
    assert np.allclose(positions(one.embedding), positions(many.embedding), atol=1e-4)


@pytest.mark.parametrize("wrong", [float("nan"), float("inf"), 1e200])
def test_values_that_have_no_distance_are_refused(spark, wrong):
    x = RNG.normal(size=(30, 3))
    good = points(spark, x)
    x = x.copy()
    x[7, 1] = wrong
    bad = points(spark, x)
    marks = spark.range(30).select("id", (F.col("id") % 2).alias("cluster"))
    for call in (
        lambda: knn.knn_self(bad, 3),
        lambda: knn.knn_query(good, bad, 3),
        lambda: knn.knn_query(bad, good, 3),
        lambda: knn.knn_graph(bad, 3, method="approx"),
        lambda: density.hdbscan(bad.withColumnRenamed("features", "y"), 3),
        lambda: trustworthiness(bad, good.withColumnRenamed("features", "y"), 3),
        lambda: trustworthiness(good, bad.withColumnRenamed("features", "y"), 3),
        lambda: silhouette(bad.withColumnRenamed("features", "y"), marks),
    ):
        with pytest.raises(ValueError, match="non-finite"):
            call()


def test_repeated_and_missing_keys_are_refused(spark):
    steps = StepStore(spark, "test")
    for ids in ([0, 0, 2], [5, 5], [None, 1]):
        with pytest.raises(ValueError, match="unique"):
            prepare.dense_index(spark.createDataFrame([(i,) for i in ids], "id BIGINT"), "id", steps)
    twice = points(spark, RNG.normal(size=(20, 3))).withColumn("id", F.col("id") % 19)
    with pytest.raises(ValueError, match="unique"):
        Umap(n_neighbors=3).fit(twice, "id", "features", n_epochs=1)


def test_scores_take_text_keys(spark):
    df = points(spark, RNG.normal(size=(40, 3)))
    low = df.select("id", F.slice("features", 1, 2).alias("y"))
    marks = df.select("id", (F.col("id") % 3).cast("int").alias("cluster"))
    text = F.concat(F.lit("k"), F.col("id")).alias("id")
    assert trustworthiness(df.select(text, "features"), low.select(text, "y"), 4).first()[0] == pytest.approx(trustworthiness(df, low, 4).first()[0])
    assert silhouette(low.select(text, "y"), marks.select(text, "cluster")).first()[0] == pytest.approx(silhouette(low, marks).first()[0])


def test_descent_on_two_rows(spark):
    got = knn_descent(points(spark, [[0.0, 0.0], [3.0, 4.0]]), 1).collect()
    assert sorted((r.id, r.nbr, r.dist) for r in got) == [(0, 1, 5.0), (1, 0, 5.0)]


def test_failed_and_clamped_fits_are_recorded(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    with pytest.raises(ValueError):
        Umap(n_neighbors=3).fit(points(spark, [[0.0, float("nan")]] * 5), "id", "features", log=log)
    assert {r.key: r.value for r in read_runs(spark, str(tmp_path / "runs"), "run_metrics").collect()} == {"training_success": 0.0, "fallback": 1.0}
    same = points(spark, np.repeat(RNG.normal(size=(6, 3)), 8, axis=0))
    model = Umap(n_neighbors=5).fit(same, "id", "features", n_epochs=1)
    assert model.metrics["clamped_rows"] == fuzzy.clamped_rows(fuzzy.local_scales(knn.knn_self(same, 5), 5)).first()[0] == 48


def test_a_restarted_stream_goes_on(spark, tmp_path):
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    start = datetime(2024, 1, 1)

    def write(first, last):
        rows = [(start + timedelta(minutes=20 * k), "a", "GET", 200, float(k), k, k, 1, None, False) for k in range(first, last)]
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(source)

    for first, last in ((0, 12), (12, 24)):
        write(first, last)
        stream_rollup(spark, source, out).awaitTermination(120)
    windows = {r.window_start for r in spark.read.parquet(out).collect()}
    log = spark.read.schema(LOG_SCHEMA).parquet(source)
    everything = {r.window_start for r in requests.windowed_rollup(log).collect()}
    assert len(windows) >= 7 and everything - windows == {max(everything)}


def test_exact_latency_quantiles(spark):
    rows = [("a", float(v)) for v in range(101)] + [("b", 3.0)]
    got = {r.endpoint: (r.p50, r.p95, r.p99) for r in requests.latency_quantiles(spark.createDataFrame(rows, "endpoint STRING, latency_ms DOUBLE"), None).collect()}
    assert got == {"a": (50.0, 95.0, 99.0), "b": (3.0, 3.0, 3.0)}


@pytest.mark.parametrize("n", [5, 499])
def test_sample_is_the_same_as_by_a_full_sort(spark, n):
    df = spark.range(30_000).withColumnRenamed("id", "key").repartition(9)
    draw = F.md5(F.concat_ws("|", F.lit("42"), F.lit("sample"), F.col("key").cast("string")))
    want = [r.key for r in df.orderBy(draw, "key").limit(n).collect()]
    assert [r.key for r in prepare.bounded_sample(df, "key", n).collect()] == want
