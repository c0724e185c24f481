"""Registered queries, each over whole tables, and their SQL twins.

``embeddings`` is the point table, two sums over all its positions stand in for
a finished embedding and ``label`` for clusters; ``events`` is read as a request
log. Queries ending in ``_blocks`` run with small blocks, so that rows meet
across groups, and have the twin of the plain query. Numbers are rounded to six
digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lowfold.functions import draws, forces
from lowfold.operators import clustering, curve, density, descent, fuzzy, knn, layout, prepare, quality, requests, spectral
from lowfold.operators.cells import BLOCK_ROWS
from lowfold.plans.umap import Umap, UmapModel
from lowfold.session import StepStore
from lowfold.sources import tables
from lowfold.sources.runs import RunLog, read_runs

try:
    from lowfold.llm import registered as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("lowfold.llm", "corpus_pipeline"):
        raise
    llm = None

K = 15
A, B, LR, SEED, MIN_DIST = 1.577, 0.895, 0.1, 42, 0.1
SMALL = 64  # rows of a block where blocks are to meet
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.assemble(_table(spark, sf, "embeddings"), "vec_id", "embedding")


def _flat_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Two weighted sums over all positions of each vector as a 2-D embedding ``(id, y)``."""

    def weighted(every: int, middle: int) -> Column:
        parts = F.transform("features", lambda v, i: v * (((i + 1) % every) - middle) / 8.0)
        return F.aggregate(parts, F.lit(0.0), lambda a, v: a + v)

    return _points(spark, sf).select("id", F.array(weighted(7, 3), weighted(5, 2)).alias("y"))


def _whole(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors themselves as an embedding ``(id, y)``."""
    return _points(spark, sf).withColumnRenamed("features", "y")


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings")
    return rows.select(F.col("vec_id").alias("id"), F.col("label").cast("int").alias("cluster"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("line_id")
    return _table(spark, sf, "lineitem").select(key, *MEASURES)


def _log(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events")
    failed = F.col("event_type") == "error"
    method = F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST")
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"),
        method.alias("method"),
        F.when(failed, 500).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"),
        F.floor(F.col("value") * 100).cast("bigint").alias("bytes"),
        F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("n_samples"),
        F.col("user_id").cast("bigint").alias("n_features"),
        F.when(failed, F.when(F.col("value") > 50, "computation_error").otherwise("invalid_csv")).alias("error_type"),
        (F.col("value") > 100).alias("critical"),
    )


def _six(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[(F.round(c, 6) + F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns])


def _six_y(df: DataFrame, width: int = 2) -> DataFrame:
    flat = layout.flat_embedding(df, width)
    return _six(flat, *flat.columns[1:])


def _knn(spark: SparkSession, sf: str, metric: str = "euclidean", p: float = 2.0) -> DataFrame:
    return knn.knn_self(_points(spark, sf), K, metric, p).select("id", "nbr", "dist", F.col("rank").cast("int"))


def _approx_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours wanted, and whether the approximate lists hold nine tenths of the exact ones, each no nearer than it can be."""
    exact = _knn(spark, sf).select("id", "nbr", F.col("dist").alias("least"))
    found = knn.knn_graph(_points(spark, sf), K, method="approx").select("id", "nbr", "dist")
    both = exact.join(found, ["id", "nbr"], "left")
    right = F.abs(F.col("dist") - F.col("least")) <= 1e-9 * (1 + F.col("least"))
    facts = both.agg(F.count(F.lit(1)).alias("wanted"), F.count(F.when(right, 1)).alias("found"))
    return facts.select("wanted", (10 * F.col("found") >= 9 * F.col("wanted")).alias("enough"))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return fuzzy.fuzzy_union(fuzzy.membership(_knn(spark, sf), K))


def _cross(spark: SparkSession, sf: str) -> DataFrame:
    points = _points(spark, sf)
    return fuzzy.cross_membership(knn.knn_query(points, points, K), K)


# --- the queries ----------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Weighted neighbour graph of the embeddings."""
    return _edges(spark, "/root/testdata/sf0.001")


def _standardize(spark, sf):
    row = prepare.scaler_fit(_lines(spark, sf), MEASURES)
    parts = [F.col(a)[n].alias(f"{a}_{c}") for a in ("mean", "scale") for n, c in enumerate(MEASURES)]
    flat = row.select(*parts)
    return _six(flat, *flat.columns)


def _standardize_apply(spark, sf):
    lines = _lines(spark, sf)
    points = prepare.assemble(lines, "line_id", MEASURES)
    scaled = prepare.scaler_apply(points, prepare.scaler_fit(lines, MEASURES))
    flat = scaled.select("id", *[F.col("features")[n].alias(c) for n, c in enumerate(MEASURES)])
    return _six(flat, *MEASURES)


def _row_identity(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "user_id")
    return prepare.dense_index(events.withColumn("key", F.col("event_id") * 3 + 1), "key", StepStore(spark, "query")).select("key", "user_id", "idx")


def _experiment_label(spark, sf):
    source = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    return _table(spark, sf, "events").select("event_id", prepare.experiment_label("umap", source).alias("label"))


def _attach(spark, sf):
    rows = _table(spark, sf, "embeddings")
    joined = prepare.attach(_flat_positions(spark, sf), rows, "vec_id", "label")
    return _six(joined.select("id", F.col("y")[0].alias("dim_0"), "label"), "dim_0")


def _topk_merge(spark, sf):
    near = _knn(spark, sf)
    return _six(knn.merge_top_k(near, knn.reverse_graph(near), K), "dist").select("id", "nbr", "dist", "rank")


def _nn_descent_round(spark, sf):
    points, width, steps = _points(spark, sf), K, StepStore(spark, "query")
    n = points.count()
    seeds = descent.pair_distances(descent.seed_pairs(points, n, width, SEED), points, "euclidean", 2.0)
    lists = steps.save(seeds.withColumn("is_new", F.lit(1)), "seeds")
    found = descent.descent_round(points, lists, width, "euclidean", 2.0, steps, {})
    return _six(found.select("id", "nbr", "dist"), "dist")


def _laplacian(spark, sf):
    vectors = _flat_positions(spark, sf).select("id", F.col("y")[0].alias("v0"), F.col("y")[1].alias("v1"))
    return _six(spectral.laplacian_apply(_edges(spark, sf), vectors, ["v0", "v1"]), "v0", "v1")


def _psi(spark, sf):
    near = _knn(spark, sf)
    return _six(near.select("id", "nbr", curve.target_curve(F.col("dist"), MIN_DIST).alias("psi")), "psi")


def _curve_step(spark, sf):
    sums = curve.step_sums(_knn(spark, sf), MIN_DIST, [(1.0, 1.0)])
    return _six(sums.select("n", "sse", "aa", "ab", "bb", "ra", "rb"), "sse", "aa", "ab", "bb", "ra", "rb")


def _curve_fit(spark, sf):
    fit = curve.fit_curve(_knn(spark, sf), MIN_DIST)
    return spark.createDataFrame([(fit.a, fit.b, fit.rmse, fit.source)], "a DOUBLE, b DOUBLE, rmse DOUBLE, source STRING")


def _barycenter(spark, sf):
    spots = _flat_positions(spark, sf)
    return _six_y(fuzzy.barycentre(_cross(spark, sf), spots, spots, 2))


def _force(kind: Callable[..., Column]):
    def query(spark, sf):
        spots = _flat_positions(spark, sf)
        left = spots.select(F.col("id").alias("i"), F.col("y").alias("yi"))
        right = spots.select(F.col("id").alias("j"), F.col("y").alias("yj"))
        force = kind(F.col("yi"), F.col("yj"), F.col("w"), A, B)
        rows = _edges(spark, sf).join(left, "i").join(right, "j").withColumn("f", force)
        return _six(rows.select("i", "j", F.col("f")[0].alias("f0"), F.col("f")[1].alias("f1")), "f0", "f1")

    return query


def _negative_sample(spark, sf):
    points = _points(spark, sf)
    return layout.negative_draws(points, points.count(), 3, SEED)


def _layout_epochs(epochs: int, block_rows: int = BLOCK_ROWS):
    def query(spark, sf):
        steps = StepStore(spark, "query")
        spots = steps.save(_flat_positions(spark, sf), "spots")
        edges = steps.save(_edges(spark, sf), "edges")
        moved, _ = layout.optimize_layout(edges, spots, spots.count(), A, B, steps, epochs, LR, SEED, block_rows=block_rows)
        return _six_y(moved)

    return query


def _layout_plain(spark, sf):
    steps = StepStore(spark, "query")
    spots = steps.save(_flat_positions(spark, sf), "spots")
    edges = steps.save(_edges(spark, sf), "edges")
    return _six_y(layout.layout_epoch(edges, spots, spots.count(), A, B, LR, 0, SEED))


def _layout_history(spark, sf):
    steps = StepStore(spark, "query")
    spots = steps.save(_flat_positions(spark, sf), "spots")
    edges = steps.save(_edges(spark, sf), "edges")
    _, frames = layout.optimize_layout(
        edges, spots, spots.count(), A, B, steps, 4, LR, SEED, snapshot_every=2
    )
    return _six(frames.select("epoch", "id", F.col("y")[0].alias("dim_0"), F.col("y")[1].alias("dim_1")), "dim_0", "dim_1")


def _spectral(spark, sf):
    steps = StepStore(spark, "query")
    return spectral.spectral_start(steps.save(_edges(spark, sf), "edges"), 2, steps).embedding


def _umap_fit(spark, sf):
    return Umap(n_neighbors=K).fit(_points(spark, sf), "id", "features").flat


def _umap_fit_columns(spark, sf):
    part = _table(spark, sf, "part").withColumn("name_length", F.length("p_name"))
    model = Umap(n_neighbors=K).fit_standardized(
        part, id_col="p_partkey", features=["p_size", "p_retailprice", "name_length"], n_epochs=50
    )
    return model.flat


def _umap_transform(spark, sf):
    model = Umap(n_neighbors=K).fit(_points(spark, sf), "id", "features")
    return layout.flat_embedding(model.transform(_points(spark, sf), "id", "features"), 2)


def _trustworthiness(spark, sf, block_rows: int = BLOCK_ROWS):
    score = quality.trustworthiness(_points(spark, sf), _flat_positions(spark, sf), K, block_rows=block_rows)
    return _six(score, "trustworthiness")


def _silhouette(spark, sf, block_rows: int = BLOCK_ROWS):
    return _six(quality.silhouette(_whole(spark, sf), _labels(spark, sf), block_rows=block_rows), "silhouette")


def _enough(spark, sf):
    return spark.createDataFrame([(quality.enough_clusters(_labels(spark, sf)),)], "enough BOOLEAN")


def _core(spark, sf):
    return _six(density.core_distances(_points(spark, sf), 5), "core")


def _chain(spark, sf):
    """Parts as clusters: those with even keys in one chain, each before it with a leaf of its own."""
    part, key = _table(spark, sf, "part"), F.col("p_partkey").cast("long")
    odd, top = key % 2 == 1, F.max("p_partkey")
    rows = part.crossJoin(F.broadcast(part.agg(top.alias("top")))).select(key.alias("cluster"), F.when(odd, key + 1).otherwise(key + 2).alias("parent"), F.when(odd, F.col("p_size")).otherwise(F.col("p_size") * F.expr("p_partkey div 2")).cast("double").alias("stability"), "top")
    return rows.select("cluster", F.when(F.col("parent") <= F.col("top"), F.col("parent")).alias("parent"), "stability")


def _choice(spark, sf):
    return density.select_clusters(_chain(spark, sf), StepStore(spark, "query"), limit=0)


def _mutual(spark, sf):
    core = density.core_distances(_points(spark, sf), 5)
    return _six(density.mutual_reachability(_knn(spark, sf), core), "w")


def _mst(spark, sf):
    steps = StepStore(spark, "query")
    points = _points(spark, sf)
    core = steps.save(density.core_distances(points, 5), "core")
    return density.spanning_tree(points, core, steps)


def _flat_with_clusters(spark, sf):
    joined = tables.embedding_with_clusters(_flat_positions(spark, sf), _labels(spark, sf), 2)
    return _six(joined, "dim_0", "dim_1")


def _models(spark, sf):
    """Events as stored models."""
    return requests.store_use(_table(spark, sf, "events"), 1000)


def _written_parts(spark, sf) -> str:
    """``part`` as CSV files with a header."""
    path = f"{StepStore(spark, 'parts').root}/part.csv"
    tables.write_table(_table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return path


PART_SCHEMA = "p_partkey BIGINT, p_name STRING, p_size INT, p_retailprice DOUBLE"


def _csv_with_target(spark, sf):
    df, target = tables.read_with_target(spark, _written_parts(spark, sf), "p_size", PART_SCHEMA)
    return df.select("p_partkey", "p_name", F.col(target).alias("target"), "p_retailprice")


def _features_in_order(spark, sf):
    return prepare.match_features(_table(spark, sf, "part"), ["p_retailprice", "p_size"], "p_partkey")


def _feature_guard(spark, sf):
    lines = _table(spark, sf, "lineitem")
    return lines.select(*prepare.check_input(lines, min_features=3))


def _fit_run(spark, sf) -> tuple[str, str]:
    """A short fit of the vectors, saved and recorded."""
    root = StepStore(spark, "saved").root
    log = RunLog(spark, f"{root}/runs")
    model = Umap(n_neighbors=K).fit(_points(spark, sf), "id", "features", n_epochs=1, log=log)
    model.save(f"{root}/model")
    return f"{root}/model", f"{root}/runs"


def _saved_model(spark, sf):
    """The training vectors of a saved model, read back."""
    path, _ = _fit_run(spark, sf)
    train = UmapModel.load(spark, path).train.select(F.col("key").alias("id"), "features")
    return _six(train.select("id", F.col("features")[0].alias("x0"), F.col("features")[63].alias("x63")), "x0", "x63")


def _run_metrics(spark, sf):
    _, path = _fit_run(spark, sf)
    kept = ("clamped_rows", "training_success")
    return read_runs(spark, path, "run_metrics").filter(F.col("key").isin(*kept)).select("key", "value")


def _timed(spark, sf):
    log = _log(spark, sf)
    ended = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("latency_ms") * 1000).cast("bigint"))
    return _six(requests.timed_blocks(log.withColumn("started", F.col("ts")).withColumn("ended", ended)), "latency_ms")


def _rollup(spark, sf):
    return _six(requests.endpoint_rollup(_log(spark, sf)), "avg_latency_ms", "max_latency_ms", "error_rate")


def _windows(spark, sf):
    rates = requests.windowed_rollup(_log(spark, sf))
    rates = rates.withColumn("window_start", F.unix_timestamp("window_start"))
    return _six(rates, "avg_latency_ms", "max_latency_ms", "error_rate")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | (llm.QUERIES if llm else {})


def oracle_sql() -> dict[str, str]:
    return _own_sql() | (llm.SQL if llm else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "numeric_select": lambda s, d: prepare.numeric_select(_table(s, d, "lineitem")),
        "target_excluded": lambda s, d: prepare.numeric_select(_table(s, d, "part"), "p_size", ["p_name"]),
        "standardize": _standardize,
        "standardize_apply": _standardize_apply,
        "profile": lambda s, d: prepare.profile(_table(s, d, "lineitem")),
        "row_identity": _row_identity,
        "bounded_sample": lambda s, d: prepare.bounded_sample(_table(s, d, "part"), "p_partkey"),
        "preview": lambda s, d: prepare.preview(_table(s, d, "part").orderBy("p_partkey")),
        "experiment_label": _experiment_label,
        "attach_target": _attach,
        "knn_exact": lambda s, d: _six(_knn(s, d), "dist"),
        "knn_manhattan": lambda s, d: _six(_knn(s, d, "manhattan"), "dist"),
        "knn_chebyshev": lambda s, d: _six(_knn(s, d, "chebyshev"), "dist"),
        "knn_minkowski": lambda s, d: _six(_knn(s, d, "minkowski", 3.0), "dist"),
        "knn_cosine": lambda s, d: _six(_knn(s, d, "cosine"), "dist"),
        "knn_query": lambda s, d: _six(knn.knn_query(_points(s, d), _points(s, d), K), "dist"),
        "knn_reverse": lambda s, d: _six(knn.reverse_graph(_knn(s, d)), "dist"),
        "topk_merge": _topk_merge,
        "nn_descent_round": _nn_descent_round,
        "knn_approx": lambda s, d: knn.knn_graph(_points(s, d), K, method="approx"),
        "knn_approx_recall": _approx_recall,
        "rho": lambda s, d: _six(fuzzy.rho(_knn(s, d)), "rho"),
        "sigma": lambda s, d: _six(fuzzy.local_scales(_knn(s, d), K), "rho", "sigma"),
        "membership": lambda s, d: _six(fuzzy.membership(_knn(s, d), K), "w"),
        "fuzzy_union": lambda s, d: _six(_edges(s, d), "w"),
        "degree": lambda s, d: _six(fuzzy.degree(_edges(s, d)), "deg"),
        "laplacian_apply": _laplacian,
        "psi": _psi,
        "curve_step": _curve_step,
        "curve_fit": _curve_fit,
        "cross_weights": lambda s, d: _six(_cross(s, d), "w"),
        "barycenter": _barycenter,
        "attractive": _force(forces.attractive_force),
        "repulsive": _force(forces.repulsive_force),
        "edge_sample": lambda s, d: layout.sampled_edges(_edges(s, d), 3, SEED).select("i", "j"),
        "negative_sample": _negative_sample,
        "layout_epoch": _layout_epochs(1),
        "layout_epoch_plain": _layout_plain,
        "layout_two_epochs": _layout_epochs(2),
        "layout_history": _layout_history,
        "spectral": _spectral,
        "umap_fit": _umap_fit,
        "umap_fit_columns": _umap_fit_columns,
        "umap_transform": _umap_transform,
        "trustworthiness": _trustworthiness,
        "silhouette": _silhouette,
        "enough_clusters": _enough,
        "core_distance": _core,
        "mutual_reachability": _mutual,
        "spanning_tree": _mst,
        "kmeans": lambda s, d: clustering.cluster(_whole(s, d), "KMeans", 10),
        "cluster_choice": _choice,
        "hdbscan": lambda s, d: clustering.cluster(_whole(s, d), "HDBSCAN", 5),
        "knn_exact_blocks": lambda s, d: _six(knn.knn_self(_points(s, d), K, block_rows=SMALL).withColumn("rank", F.col("rank").cast("int")).select("id", "nbr", "dist", "rank"), "dist"),
        "layout_epochs_blocks": _layout_epochs(2, SMALL),
        "trustworthiness_blocks": lambda s, d: _trustworthiness(s, d, SMALL),
        "silhouette_blocks": lambda s, d: _silhouette(s, d, SMALL),
        "csv_source": lambda s, d: tables.read_csv(s, _written_parts(s, d), PART_SCHEMA),
        "csv_features": lambda s, d: tables.read_features(s, _written_parts(s, d), PART_SCHEMA),
        "csv_with_target": _csv_with_target,
        "feature_guard": _feature_guard,
        "features_in_order": _features_in_order,
        "saved_model": _saved_model,
        "run_metrics": _run_metrics,
        "clamped_rows": lambda s, d: fuzzy.clamped_rows(fuzzy.local_scales(_knn(s, d), K)),
        "latency_quantiles": lambda s, d: _six(requests.latency_quantiles(_log(s, d), None), "p50", "p95", "p99"),
        "embedding_flat": lambda s, d: _six_y(_flat_positions(s, d)),
        "result_with_clusters": _flat_with_clusters,
        "result_summary": lambda s, d: tables.result_summary(_flat_positions(s, d), 64),
        "request_metrics": lambda s, d: requests.request_metrics(_log(s, d)),
        "request_failures": lambda s, d: requests.request_failures(_log(s, d)),
        "input_size": lambda s, d: _six(requests.input_sizes(_log(s, d)), "file_size_kb"),
        "error_rate": lambda s, d: requests.typed_errors(_log(s, d)),
        "store_use": _models,
        "timed_blocks": _timed,
        "rollup_endpoint": _rollup,
        "rollup_windows": _windows,
    }


# --- the SQL twins --------------------------------------------------------

POINTS = "p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
SUM = "list_sum([x[i] * ((i % {}) - {}) / 8.0 for i in range(1, len(x) + 1)])"
SPOTS = f"y AS (SELECT id, {SUM.format(7, 3)} AS y0, {SUM.format(5, 2)} AS y1 FROM p)"
GAP = "sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))))"
MANHATTAN = "list_sum(list_transform(list_zip(a.x, b.x), lambda t: abs(t[1] - t[2])))"
CHEBYSHEV = "list_max(list_transform(list_zip(a.x, b.x), lambda t: abs(t[1] - t[2])))"
MINKOWSKI = "pow(list_sum(list_transform(list_zip(a.x, b.x), lambda t: pow(abs(t[1] - t[2]), 3))), 1.0 / 3)"
DOT = "list_sum(list_transform(list_zip({0}.x, {1}.x), lambda t: t[1] * t[2]))"
COSINE = f"1 - {DOT.format('a', 'b')} / (sqrt({DOT.format('a', 'a')}) * sqrt({DOT.format('b', 'b')}))"
TARGET = "log2(15)"


def _knn_sql(gap: str = GAP, k: int = K, others: bool = True) -> str:
    where = "WHERE a.id <> b.id" if others else ""
    return f"""{POINTS},
      d AS (SELECT a.id AS id, b.id AS nbr, {gap} AS dist FROM p a CROSS JOIN p b {where}),
      k AS (SELECT id, nbr, dist, CAST(rank AS INTEGER) AS rank FROM (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rank FROM d) WHERE rank <= {k})"""


def _scales_sql(knn_sql: str, positive: bool = False) -> str:
    rho = "coalesce(min(dist) FILTER (WHERE dist > 0), 0.0)" if positive else "min(dist)"
    return f"""{knn_sql},
      r AS (SELECT id, {rho} AS rho, list(dist) FILTER (WHERE dist > 0) AS ds FROM k GROUP BY id),
      h AS (SELECT id, rho, ds, CAST(1e-5 AS DOUBLE) AS lo, CAST(1e5 - 1e-5 AS DOUBLE) AS wd, 0 AS it FROM r
            UNION ALL
            SELECT id, rho, ds,
              CASE WHEN list_sum(list_transform(ds, lambda v: exp(-greatest(0.0, v - rho) / (lo + wd / 2)))) > {TARGET}
                   THEN lo ELSE lo + wd / 2 END, wd / 2, it + 1 FROM h WHERE it < 60),
      s AS (SELECT id, rho, lo + wd / 2 AS sigma FROM h WHERE it = 60)"""


def _member_sql(scales: str) -> str:
    return f"""{scales},
      m AS (SELECT k.id AS i, k.nbr AS j, exp(-greatest(0.0, k.dist - s.rho) / s.sigma) AS w
            FROM k JOIN s ON k.id = s.id)"""


def _edges_sql() -> str:
    return f"""{_member_sql(_scales_sql(_knn_sql()))},
      e AS (SELECT i, j, a + b - a * b AS w FROM (
              SELECT i, j, sum(a) AS a, sum(b) AS b FROM (
                SELECT i, j, w AS a, 0.0 AS b FROM m UNION ALL SELECT j, i, 0.0, w FROM m) GROUP BY i, j))"""


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"


def _r(value: str, name: str) -> str:
    return f"round({value}, 6) + 0.0 AS {name}"


def _epoch_sql(source: str, target: str, epoch: int, epochs: int) -> str:
    """CTEs for one layout epoch from table ``source`` to table ``target``."""
    lr = layout.learning_rate(LR, epoch, epochs)
    used = f"{draws.uniform_sql('edge', SEED, epoch, 'e.i', 'e.j')} <= e.w AND e.i <> e.j"
    drawn = draws.pick_sql("negative", SEED, epoch, "v.id", "t.s", "(SELECT count(*) FROM p)")
    attract = f"CASE WHEN r2 > 0 THEN -2 * {A} * {B} * pow(r2, {B} - 1) / (1 + {A} * pow(r2, {B})) ELSE 0 END * w"
    repel = f"2 * {B} / ((0.001 + r2) * (1 + {A} * pow(r2, {B}))) * (1 - w)"
    t = target
    return f"""
      {t}_att AS (SELECT e.i AS id, e.w, a.y0 - b.y0 AS g0, a.y1 - b.y1 AS g1,
                    (a.y0 - b.y0) * (a.y0 - b.y0) + (a.y1 - b.y1) * (a.y1 - b.y1) AS r2
                  FROM e JOIN {source} a ON a.id = e.i JOIN {source} b ON b.id = e.j WHERE {used}),
      {t}_drawn AS (SELECT v.id, {drawn} AS k FROM p v CROSS JOIN range(5) t(s)),
      {t}_rep AS (SELECT n.id, coalesce(e.w, 0) AS w, a.y0 - b.y0 AS g0, a.y1 - b.y1 AS g1,
                    (a.y0 - b.y0) * (a.y0 - b.y0) + (a.y1 - b.y1) * (a.y1 - b.y1) AS r2
                  FROM {t}_drawn n JOIN {source} a ON a.id = n.id JOIN {source} b ON b.id = n.k
                  LEFT JOIN e ON e.i = n.id AND e.j = n.k WHERE n.id <> n.k),
      {t} AS (SELECT id, sum(d0) AS y0, sum(d1) AS y1 FROM (
                SELECT id, y0 AS d0, y1 AS d1 FROM {source}
                UNION ALL SELECT id, {lr} * ({attract}) * g0, {lr} * ({attract}) * g1 FROM {t}_att
                UNION ALL SELECT id, {lr} * ({repel}) * g0, {lr} * ({repel}) * g1 FROM {t}_rep) GROUP BY id)"""


LOG = """log AS (SELECT ts, event_type AS endpoint,
      CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
      CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS latency_ms,
      CAST(floor(value * 100) AS BIGINT) AS bytes,
      CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS n_samples, CAST(user_id AS BIGINT) AS n_features,
      CASE WHEN event_type = 'error'
           THEN CASE WHEN value > 50 THEN 'computation_error' ELSE 'invalid_csv' END END AS error_type,
      value > 100 AS critical FROM events)"""
RATES = """count(*) AS requests, round(avg(latency_ms), 6) + 0.0 AS avg_latency_ms,
      round(max(latency_ms), 6) + 0.0 AS max_latency_ms, CAST(sum(bytes) AS BIGINT) AS bytes,
      CAST(sum(CASE WHEN status < 400 THEN 0 ELSE 1 END) AS BIGINT) AS errors,
      round(avg(CASE WHEN status < 400 THEN 0 ELSE 1 END), 6) + 0.0 AS error_rate"""


def _own_sql() -> dict[str, str]:
    near = _knn_sql()
    edges = _edges_sql()
    spots = f"{edges}, {SPOTS}"
    cross = _member_sql(_scales_sql(_knn_sql(others=False), positive=True))
    pair = """SELECT e.i, e.j, e.w, a.y0 - b.y0 AS g0, a.y1 - b.y1 AS g1,
              (a.y0 - b.y0) * (a.y0 - b.y0) + (a.y1 - b.y1) * (a.y1 - b.y1) AS r2
              FROM e JOIN y a ON a.id = e.i JOIN y b ON b.id = e.j"""
    attract = f"CASE WHEN r2 > 0 THEN -2 * {A} * {B} * pow(r2, {B} - 1) / (1 + {A} * pow(r2, {B})) ELSE 0 END * w"
    repel = f"2 * {B} / ((0.001 + r2) * (1 + {A} * pow(r2, {B}))) * (1 - w)"
    means = ", ".join(_r(f"avg({c})", f"mean_{c}") for c in MEASURES)
    scales = ", ".join(_r(f"stddev_pop({c})", f"scale_{c}") for c in MEASURES)
    z = ", ".join(_r(f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)", c) for c in MEASURES)
    list_all = "SELECT id, nbr, round(dist, 6) + 0.0 AS dist, rank FROM k"
    descent_sql = _descent_sql()
    epoch = f"{spots}, {_epoch_sql('y', 'y_a', 0, 1)}"
    two = f"{spots}, {_epoch_sql('y', 'y_a', 0, 2)}, {_epoch_sql('y_a', 'y_b', 1, 2)}"
    place = "SELECT id, round(y0, 6) + 0.0 AS dim_0, round(y1, 6) + 0.0 AS dim_1 FROM {}"
    core = f"{_knn_sql(k=15)}, c AS (SELECT id, max(dist) AS core FROM k WHERE rank <= 4 GROUP BY id)"
    found = {
        "numeric_select": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
        "target_excluded": "SELECT p_name, p_partkey, p_retailprice FROM part",
        "standardize": f"SELECT {means}, {scales} FROM lineitem",
        "standardize_apply": f"SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id, {z} FROM lineitem",
        "profile": "SELECT count(*) AS n_samples, CAST(8 AS INTEGER) AS n_features FROM lineitem",
        "row_identity": "SELECT event_id * 3 + 1 AS key, user_id, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events",
        "bounded_sample": "SELECT * FROM part ORDER BY md5('42|sample|' || CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 499",
        "preview": "SELECT * FROM part ORDER BY p_partkey LIMIT 5",
        "experiment_label": "SELECT event_id, '/' || CASE WHEN event_type = 'view' THEN 'dev' ELSE event_type END || '/umap' AS label FROM events",
        "attach_target": f"WITH {POINTS}, {SPOTS} SELECT y.id, round(y0, 6) + 0.0 AS dim_0, CAST(label AS VARCHAR) AS label FROM y JOIN embeddings ON vec_id = y.id",
        "knn_exact": _with(near, list_all),
        "knn_approx_recall": f"SELECT CAST(sum(least({K}, n - 1)) AS BIGINT) AS wanted, true AS enough FROM (SELECT count(*) OVER () AS n FROM embeddings)",
        "knn_manhattan": _with(_knn_sql(MANHATTAN), list_all),
        "knn_chebyshev": _with(_knn_sql(CHEBYSHEV), list_all),
        "knn_minkowski": _with(_knn_sql(MINKOWSKI), list_all),
        "knn_cosine": _with(_knn_sql(COSINE), list_all),
        "knn_query": _with(_knn_sql(others=False), list_all),
        "knn_reverse": _with(near, "SELECT nbr AS id, id AS nbr, round(dist, 6) + 0.0 AS dist FROM k"),
        "topk_merge": _with(
            near,
            """SELECT id, nbr, round(dist, 6) + 0.0 AS dist, CAST(rank AS INTEGER) AS rank FROM (
               SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rank FROM (
                 SELECT id, nbr, min(dist) AS dist FROM (
                   SELECT id, nbr, dist FROM k UNION ALL SELECT nbr, id, dist FROM k) GROUP BY id, nbr)) WHERE rank <= 15""",
        ),
        "nn_descent_round": descent_sql,
        "rho": _with(near, "SELECT id, round(min(dist), 6) + 0.0 AS rho FROM k GROUP BY id"),
        "sigma": _with(_scales_sql(near), f"SELECT id, {_r('rho', 'rho')}, {_r('sigma', 'sigma')} FROM s"),
        "membership": _with(_member_sql(_scales_sql(near)), f"SELECT i, j, {_r('w', 'w')} FROM m"),
        "fuzzy_union": _with(edges, f"SELECT i, j, {_r('w', 'w')} FROM e"),
        "degree": _with(edges, f"SELECT i, {_r('sum(w)', 'deg')} FROM e GROUP BY i"),
        "laplacian_apply": _with(
            f"{spots}, g AS (SELECT i, sum(w) AS deg FROM e GROUP BY i)",
            f"""SELECT y.id, {_r('any_value(y.y0) - sum(e.w / sqrt(a.deg * b.deg) * o.y0)', 'v0')},
                {_r('any_value(y.y1) - sum(e.w / sqrt(a.deg * b.deg) * o.y1)', 'v1')}
                FROM y JOIN e ON e.i = y.id JOIN g a ON a.i = e.i JOIN g b ON b.i = e.j JOIN y o ON o.id = e.j
                GROUP BY y.id""",
        ),
        "psi": _with(near, f"SELECT id, nbr, {_r(f'CASE WHEN dist <= {MIN_DIST} THEN 1.0 ELSE exp({MIN_DIST} - dist) END', 'psi')} FROM k"),
        "curve_step": _with(
            f"""{near}, q AS (SELECT -dist * dist / pow(1 + dist * dist, 2) AS da,
                  CASE WHEN dist > 0 THEN -2 * ln(dist) * dist * dist / pow(1 + dist * dist, 2) ELSE 0 END AS db,
                  CASE WHEN dist <= {MIN_DIST} THEN 1.0 ELSE exp({MIN_DIST} - dist) END - 1 / (1 + dist * dist) AS r
                FROM k)""",
            f"""SELECT count(*) AS n, {_r('sum(r * r)', 'sse')}, {_r('sum(da * da)', 'aa')}, {_r('sum(da * db)', 'ab')},
                {_r('sum(db * db)', 'bb')}, {_r('sum(da * r)', 'ra')}, {_r('sum(db * r)', 'rb')} FROM q""",
        ),
        "cross_weights": _with(cross, f"SELECT i AS id, j AS train_id, {_r('w', 'w')} FROM m"),
        "barycenter": _with(
            f"{cross}, {SPOTS}",
            f"""SELECT m.i AS id, {_r('sum(w * y0) / sum(w)', 'dim_0')}, {_r('sum(w * y1) / sum(w)', 'dim_1')}
                FROM m JOIN y ON y.id = m.j GROUP BY m.i""",
        ),
        "attractive": _with(f"{spots}, f AS ({pair})", f"SELECT i, j, {_r(f'{attract} * g0', 'f0')}, {_r(f'{attract} * g1', 'f1')} FROM f"),
        "repulsive": _with(f"{spots}, f AS ({pair})", f"SELECT i, j, {_r(f'{repel} * g0', 'f0')}, {_r(f'{repel} * g1', 'f1')} FROM f"),
        "edge_sample": _with(edges, f"SELECT i, j FROM e WHERE i <> j AND {draws.uniform_sql('edge', SEED, 3, 'i', 'j')} <= w"),
        "negative_sample": f"""SELECT * FROM (SELECT vec_id AS i, CAST(s AS INTEGER) AS draw,
            {draws.pick_sql('negative', SEED, 3, 'vec_id', 's', '(SELECT count(*) FROM embeddings)')} AS k
            FROM embeddings CROSS JOIN range(5) t(s)) WHERE i <> k""",
        "layout_epoch": _with(epoch, place.format("y_a")),
        "layout_epoch_plain": _with(epoch, place.format("y_a")),
        "layout_two_epochs": _with(two, place.format("y_b")),
        "trustworthiness": _with(
            f"""{POINTS}, {SPOTS},
                l AS (SELECT id, nbr FROM (SELECT a.id, b.id AS nbr, row_number() OVER (PARTITION BY a.id ORDER BY
                        sqrt((a.y0 - b.y0) * (a.y0 - b.y0) + (a.y1 - b.y1) * (a.y1 - b.y1)), b.id) AS rank
                        FROM y a CROSS JOIN y b WHERE a.id <> b.id) WHERE rank <= {K}),
                d AS (SELECT a.id AS id, b.id AS nbr, {GAP} AS dist FROM p a CROSS JOIN p b WHERE a.id <> b.id),
                q AS (SELECT id, nbr, rank() OVER (PARTITION BY id ORDER BY dist) AS rank FROM d),
                n AS (SELECT count(*) AS n FROM p)""",
            f"""SELECT {_r(f'1 - 2.0 / (any_value(n) * {K} * (2 * any_value(n) - 3 * {K} - 1)) * sum(greatest(0, rank - {K}))', 'trustworthiness')}
                FROM l JOIN q USING (id, nbr) CROSS JOIN n""",
        ),
        "silhouette": _with(
            f"""{POINTS},
                c AS (SELECT p.id, x, label FROM p JOIN embeddings ON vec_id = p.id),
                z AS (SELECT label AS o, count(*) AS size FROM c GROUP BY label),
                t AS (SELECT a.id, a.label, b.label AS o, sum({GAP}) AS total
                      FROM c a CROSS JOIN c b GROUP BY a.id, a.label, b.label),
                v AS (SELECT id, max(CASE WHEN label = o THEN size END) AS size,
                        max(CASE WHEN label = o AND size > 1 THEN total / (size - 1) END) AS a,
                        min(CASE WHEN label <> o THEN total / size END) AS b FROM t JOIN z USING (o) GROUP BY id)""",
            f"SELECT {_r('avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)', 'silhouette')} FROM v",
        ),
        "enough_clusters": "SELECT count(DISTINCT label) >= 2 AS enough FROM embeddings",
        "core_distance": _with(core, "SELECT id, round(core, 6) + 0.0 AS core FROM c"),
        "cluster_choice": """
            WITH RECURSIVE c AS (SELECT CAST(p_partkey AS BIGINT) AS k, CAST(p_size AS BIGINT) AS s, max(p_partkey) OVER () AS top FROM part),
              e AS (SELECT e.k, e.s * (e.k // 2) AS own, coalesce(o.s, 0) AS leaf, e.top FROM c e LEFT JOIN c o ON o.k = e.k - 1 WHERE e.k % 2 = 0),
              r AS (SELECT k, leaf AS below, CASE WHEN k + 2 > top THEN leaf ELSE greatest(own, leaf) END AS value FROM e WHERE k = 2
                UNION ALL SELECT e.k, e.leaf + r.value, CASE WHEN e.k + 2 > e.top THEN e.leaf + r.value ELSE greatest(e.own, e.leaf + r.value) END
                FROM r JOIN e ON e.k = r.k + 2),
              h AS (SELECT coalesce(max(r.k), 0) AS k FROM r JOIN e USING (k) WHERE e.k + 2 <= e.top AND e.own >= r.below)
            SELECT c.k AS cluster, CASE WHEN c.k <= h.k THEN h.k WHEN c.k % 2 = 1 AND c.k < c.top THEN c.k END AS label FROM c, h""",
        "mutual_reachability": _with(
            core, f"SELECT k.id AS i, k.nbr AS j, {_r('greatest(k.dist, a.core, b.core)', 'w')} FROM k JOIN c a ON a.id = k.id JOIN c b ON b.id = k.nbr"
        ),
        "embedding_flat": f"WITH {POINTS}, {SPOTS} {place.format('y')}",
        "result_with_clusters": f"WITH {POINTS}, {SPOTS} SELECT y.id, round(y0, 6) + 0.0 AS dim_0, round(y1, 6) + 0.0 AS dim_1, CAST(label AS INTEGER) AS cluster FROM y JOIN embeddings ON vec_id = y.id",
        "result_summary": "SELECT count(*) AS n_samples, CAST(64 AS INTEGER) AS n_features, CAST(2 AS INTEGER) AS n_components FROM embeddings",
        "request_metrics": f"WITH {LOG} SELECT endpoint, method, status, latency_ms, CAST(status < 400 AS INTEGER) AS success FROM log",
        "request_failures": f"WITH {LOG} SELECT endpoint, method, 1 AS error FROM log WHERE status >= 400",
        "input_size": f"WITH {LOG} SELECT endpoint, {_r('bytes / 1024.0', 'file_size_kb')}, n_samples, n_features FROM log",
        "error_rate": f"WITH {LOG} SELECT endpoint, error_type, critical, count(*) AS error_count FROM log WHERE error_type IS NOT NULL GROUP BY ALL",
        "store_use": "SELECT count(*) AS cached_models, count(*) / 1000.0 * 100 AS cache_utilization_pct FROM events",
        "timed_blocks": f"""WITH {LOG} SELECT endpoint, method, {_r('round(latency_ms * 1000) / 1000.0', 'latency_ms')},
            CAST(error_type IS NULL AS INTEGER) AS success, CAST(error_type IS NOT NULL AS INTEGER) AS error FROM log""",
        "rollup_endpoint": f"WITH {LOG} SELECT endpoint, method, {RATES} FROM log GROUP BY ROLLUP (endpoint, method)",
        "rollup_windows": f"WITH {LOG} SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, endpoint, {RATES} FROM log GROUP BY 1, endpoint",
    }
    parts = "SELECT p_partkey, p_name, p_size, p_retailprice FROM part"
    near_scales = _scales_sql(near)
    clamped = "count(*) FILTER (WHERE sigma <= 1e-5 * (1 + 1e-6) OR sigma >= 1e5 * (1 - 1e-6))"
    four = ", ".join(_epoch_sql("y" if k == 0 else f"y_{k}", f"y_{k + 1}", k, 4) for k in range(4))
    frame = "SELECT CAST({} AS INTEGER) AS epoch, id, round(y0, 6) + 0.0 AS dim_0, round(y1, 6) + 0.0 AS dim_1 FROM {}"
    return found | {
        "layout_history": _with(f"{spots}, {four}", f"{frame.format(1, 'y_2')} UNION ALL {frame.format(3, 'y_4')}"),
        "knn_exact_blocks": found["knn_exact"],
        "layout_epochs_blocks": found["layout_two_epochs"],
        "trustworthiness_blocks": found["trustworthiness"],
        "silhouette_blocks": found["silhouette"],
        "csv_source": parts,
        "csv_features": "SELECT p_partkey, p_size, p_retailprice FROM part",
        "csv_with_target": "SELECT p_partkey, p_name, p_size AS target, p_retailprice FROM part",
        "feature_guard": found["numeric_select"],
        "features_in_order": "SELECT p_partkey, p_retailprice, p_size FROM part",
        "saved_model": f"WITH {POINTS} SELECT id, round(x[1], 6) + 0.0 AS x0, round(x[64], 6) + 0.0 AS x63 FROM p",
        "run_metrics": _with(near_scales, f"SELECT 'clamped_rows' AS key, CAST({clamped} AS DOUBLE) AS value FROM s UNION ALL SELECT 'training_success', 1.0"),
        "clamped_rows": _with(near_scales, f"SELECT {clamped} AS clamped_rows FROM s"),
        "latency_quantiles": f"""WITH {LOG} SELECT endpoint, {", ".join(_r(f"quantile_cont(latency_ms, {q})", n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")))}
            FROM log GROUP BY endpoint""",
    }


def _descent_sql() -> str:
    """One round: seeds, the neighbours of their neighbours both ways, the best K."""
    at = draws.draw_sql("seed", SEED, 0, "p.id", "s")
    n, others = "(SELECT count(*) FROM p)", "((SELECT count(*) FROM p) - 1)"
    low, high = f"(s * {others} // {K})", f"((s + 1) * {others} // {K})"
    return _with(
        f"""{POINTS},
          b AS (SELECT p.id, (p.id + 1 + {low} + {at} % ({high} - {low})) % {n} AS nbr FROM p CROSS JOIN range({K}) t(s)),
          u AS (SELECT id, nbr FROM b UNION SELECT nbr, id FROM b),
          c AS (SELECT id, nbr FROM b UNION SELECT l.id, r.nbr FROM u l JOIN u r ON r.id = l.nbr WHERE l.id <> r.nbr),
          d AS (SELECT c.id, c.nbr, {GAP} AS dist FROM c JOIN p a ON a.id = c.id JOIN p b ON b.id = c.nbr)""",
        f"""SELECT id, nbr, round(dist, 6) + 0.0 AS dist FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rank FROM d) WHERE rank <= {K}""",
    )
