import math

import numpy as np
import pytest
from helpers import points
from pyspark.sql import functions as F

from lowfold.functions.draws import draw_array, pick, pick_array, uniform, uniform_array
from lowfold.operators import curve, fuzzy
from lowfold.operators.knn import knn_self
from lowfold.operators.spectral import spectral_start
from lowfold.session import StepStore

RNG = np.random.default_rng(11)
KNN = "id BIGINT, nbr BIGINT, dist DOUBLE"


def test_scales_solve_the_equation(spark):
    knn = knn_self(points(spark, RNG.normal(size=(80, 4))), 10)
    pdf = knn.toPandas().merge(fuzzy.local_scales(knn, 10).toPandas(), on="id")
    pdf["term"] = np.exp(-np.maximum(0, pdf.dist - pdf.rho) / pdf.sigma)
    assert np.allclose(pdf.groupby("id").term.sum(), math.log2(10), atol=1e-8)
    assert (pdf.groupby("id").dist.min() == pdf.groupby("id").rho.first()).all()


def test_rho_of_copies(spark):
    knn = spark.createDataFrame([(0, 1, 0.0), (0, 2, 1.0), (0, 3, 2.0), (0, 4, 2.5)], KNN)
    assert fuzzy.rho(knn).first().rho == 0.0
    assert fuzzy.local_scales(knn, 4).first().rho == 0.0
    assert fuzzy.local_scales(knn, 4, positive_rho=True).first().rho == 1.0


def test_sigma_is_clamped_without_a_root(spark):
    knn = spark.createDataFrame([(0, n, 1.0) for n in range(1, 9)] + [(1, 2, 0.0), (1, 3, 0.0)], KNN)
    scales = fuzzy.local_scales(knn, 8)
    low = {r.id: r.sigma for r in scales.collect()}
    assert low[0] == pytest.approx(1e-5) and low[1] == pytest.approx(1e-5)
    assert fuzzy.clamped_rows(scales).first()[0] == 2
    short = spark.createDataFrame([(0, 1, 1.0), (0, 2, 2.0)], KNN)
    assert fuzzy.local_scales(short, 16).first().sigma == pytest.approx(1e5, rel=1e-6)


def test_cross_weights_values(spark):
    knn = spark.createDataFrame([(0, 1, 0.5), (0, 3, 1.5), (1, 0, 1.0), (1, 2, 2.0)], KNN)
    scales = spark.createDataFrame([(0, 0.5, 1.0), (1, 1.0, 2.0)], "id BIGINT, rho DOUBLE, sigma DOUBLE")
    got = {(r.i, r.j): r.w for r in fuzzy.weigh(knn, scales).collect()}
    want = {(0, 1): 1.0, (0, 3): math.exp(-1), (1, 0): 1.0, (1, 2): math.exp(-0.5)}
    assert got == pytest.approx(want)


def test_cross_membership_between_zero_and_one(spark):
    knn = knn_self(points(spark, RNG.normal(size=(30, 3))), 5)
    w = [r.w for r in fuzzy.cross_membership(knn, 5).collect()]
    assert len(w) == 150 and min(w) >= 0 and max(w) <= 1


def test_membership_equals_weigh(spark):
    knn = knn_self(points(spark, RNG.normal(size=(30, 3))), 5)
    one = {(r.i, r.j): r.w for r in fuzzy.membership(knn, 5).collect()}
    two = {(r.i, r.j): r.w for r in fuzzy.weigh(knn, fuzzy.local_scales(knn, 5)).collect()}
    assert one == pytest.approx(two)


def test_fuzzy_union(spark):
    directed = spark.createDataFrame([(0, 1, 0.5), (1, 0, 0.4), (0, 2, 0.3)], "i BIGINT, j BIGINT, w DOUBLE")
    got = {(r.i, r.j): r.w for r in fuzzy.fuzzy_union(directed).collect()}
    assert got == pytest.approx({(0, 1): 0.7, (1, 0): 0.7, (0, 2): 0.3, (2, 0): 0.3})


def test_barycentre(spark):
    train = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0, 2.0]), (2, [10.0, 10.0])], "id BIGINT, y ARRAY<DOUBLE>")
    cross = spark.createDataFrame([(5, 0, 1.0), (5, 1, 3.0), (5, 2, 0.0), (6, 0, 0.0)], "id BIGINT, train_id BIGINT, w DOUBLE")
    new = spark.createDataFrame([(5,), (6,), (7,)], "id BIGINT")
    got = {r.id: list(r.y) for r in fuzzy.barycentre(cross, train, new, 2).collect()}
    assert got == {5: [1.5, 1.5], 6: [4.0, 4.0], 7: [4.0, 4.0]}


@pytest.mark.parametrize("min_dist", [0.05, 0.1, 0.2, 0.5])
def test_curve_positive(spark, min_dist):
    d = spark.createDataFrame([(float(v),) for v in np.linspace(0.05, 3.0, 50)], "dist DOUBLE")
    fit = curve.fit_curve(d, min_dist)
    assert fit.a > 0 and fit.b > 0 and fit.source == "data"


def test_curve_quality(spark):
    d = spark.createDataFrame([(float(v),) for v in np.linspace(0.05, 3.0, 100)], "dist DOUBLE")
    assert curve.fit_curve(d, 0.1).rmse < 0.05


def test_curve_grid_is_the_published_one(spark):
    d = spark.createDataFrame([(1.0,)], "dist DOUBLE")
    fit = curve.fit_curve(d, 0.1, curve="grid")
    assert fit.a == pytest.approx(1.577, abs=2e-3) and fit.b == pytest.approx(0.895, abs=2e-3)


def test_curve_falls_back(spark):
    none = spark.createDataFrame([], "dist DOUBLE")
    assert curve.fit_curve(none, 0.1).source == "fallback"
    copies = curve.fit_curve(spark.createDataFrame([(0.0,), (0.0,), (0.5,), (2.0,)], "dist DOUBLE"), 0.1)
    assert copies.source == "data" and copies.a > 0 and copies.b > 0


def _edges(spark, w):
    i, j = np.nonzero(w)
    rows = [(int(a), int(b), float(w[a, b])) for a, b in zip(i, j)]
    return spark.createDataFrame(rows, "i BIGINT, j BIGINT, w DOUBLE")


def _vectors(start):
    return start.embedding.toPandas().sort_values("id").drop(columns="id").to_numpy()


def test_spectral_matches_dense(spark):
    w = RNG.uniform(0.1, 1.0, (30, 30))
    w = (w + w.T) / 2 * (RNG.random((30, 30)) < 0.3)
    w = np.maximum(w, w.T)
    np.fill_diagonal(w, 0)
    got = spectral_start(_edges(spark, w), 2, StepStore(spark, "test"), tol=1e-7)
    deg = w.sum(1)
    values, vectors = np.linalg.eigh(np.eye(30) - w / np.sqrt(np.outer(deg, deg)))
    assert np.allclose(got.eigenvalues, values[1:3], atol=1e-8)
    y = _vectors(got)
    assert np.allclose(y.T @ y, np.eye(2), atol=1e-8)
    assert np.allclose(np.abs(vectors[:, 1:3].T @ y), np.eye(2), atol=1e-4)


def test_spectral_clique(spark):
    w = np.ones((4, 4)) - np.eye(4)
    got = spectral_start(_edges(spark, w), 2, StepStore(spark, "test"))
    y = _vectors(got)
    assert np.allclose(got.eigenvalues, 4 / 3) and np.allclose(y.T @ y, np.eye(2), atol=1e-9)
    assert np.allclose(y.sum(0), 0, atol=1e-9)


def test_spectral_two_blocks(spark):
    w = np.kron(np.eye(2), np.ones((4, 4)) - np.eye(4))
    y = _vectors(spectral_start(_edges(spark, w), 2, StepStore(spark, "test")))
    assert np.linalg.norm(y[:4].mean(0) - y[4:].mean(0)) > 0.1


def test_spectral_blocks_agree(spark):
    knn = knn_self(points(spark, RNG.normal(size=(90, 3))), 6)
    edges = fuzzy.fuzzy_union(fuzzy.membership(knn, 6))
    one = spectral_start(edges, 2, StepStore(spark, "test"), outer=2, inner=3)
    many = spectral_start(edges, 2, StepStore(spark, "test"), outer=2, inner=3, block_rows=45)
    assert np.allclose(_vectors(one), _vectors(many), atol=1e-8)


def test_draws_agree_and_are_even(spark):
    ids = spark.range(20000).select("id", (F.col("id") * 3 % 1001).alias("j"))
    got = ids.select(
        uniform("edge", 42, 3, F.col("id"), F.col("j")).alias("u"), pick("negative", 42, 3, F.col("id"), F.col("j"), 777).alias("k")
    ).toPandas()
    i, j = np.arange(20000), np.arange(20000) * 3 % 1001
    assert (got.u.to_numpy() == uniform_array("edge", 42, 3, i, j)).all()
    assert (got.k.to_numpy() == pick_array("negative", 42, 3, i, j, 777)).all()
    assert abs(got.u.mean() - 0.5) < 0.01 and abs(got.u.std() - 12**-0.5) < 0.01
    assert np.bincount(got.k, minlength=777).min() > 5
    assert (draw_array("edge", 42, 3, i + (1 << 40), j) >= 0).all()
