import datetime as dt

import numpy as np
import pytest
from helpers import embedding, points
from pyspark.sql import functions as F

from lowfold.operators import prepare, requests
from lowfold.session import StepStore, step_root
from lowfold.sources import tables
from lowfold.streaming.requests import LOG_SCHEMA, stream_rollup


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b,name,c,flag\n1,2.5,x,3,true\n4,5.5,y,6,false\n7,8.5,z,9,true\n")
    return str(path)


def test_csv_keeps_numeric_columns(spark, csv):
    df = tables.read_features(spark, csv)
    assert df.columns == ["a", "b", "c"] and df.count() == 3
    with pytest.raises(ValueError):
        tables.read_features(spark, csv, max_rows=3)
    assert tables.read_features(spark, csv, max_rows=4).count() == 3
    given = tables.read_csv(spark, csv, "a DOUBLE, b DOUBLE, name STRING, c DOUBLE, flag BOOLEAN")
    assert prepare.numeric_columns(given) == ["a", "b", "c"]


def test_csv_with_target(spark, csv):
    df, target = tables.read_with_target(spark, csv, "c")
    assert df.columns == ["a", "b", "name", "c", "flag"] and target == "c"
    assert prepare.numeric_select(df, target).columns == ["a", "b"]
    with pytest.raises(ValueError):
        prepare.check_input(df, exclude=["c"])
    with pytest.raises(ValueError):
        tables.read_with_target(spark, csv, "absent")


def test_csv_sink(spark, tmp_path):
    emb = embedding(spark, [[1, 2], [3, 4]])
    clusters = spark.createDataFrame([(0, 5), (1, -1)], "id BIGINT, cluster INT")
    out = str(tmp_path / "out")
    tables.write_table(tables.embedding_with_clusters(emb, clusters, 2), out)
    back = tables.read_csv(spark, out).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(0, 1.0, 2.0, 5), (1, 3.0, 4.0, -1)]
    tables.write_table(emb, str(tmp_path / "pq"), "parquet")
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 2
    assert tuple(tables.result_summary(emb, 4).first()) == (2, 4, 2)


def test_scaler_uses_the_population_deviation(spark):
    df = points(spark, [[1, 5], [2, 5], [4, 5]])
    scaler = prepare.scaler_fit_vectors(df)
    row = scaler.first()
    assert np.allclose(row["mean"], [7 / 3, 5]) and np.allclose(row["scale"], [np.std([1, 2, 4]), 1])
    z = np.stack(prepare.scaler_apply(df, scaler).toPandas().sort_values("id").features)
    assert np.allclose(z.mean(0), 0) and np.allclose(z[:, 1], 0) and np.allclose(z[:, 0].std(), 1)


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(2000)
    one = {r.id for r in prepare.bounded_sample(df, "id").collect()}
    two = {r.id for r in prepare.bounded_sample(df.repartition(5), "id").collect()}
    assert len(one) == 499 and one == two
    assert prepare.bounded_sample(spark.range(10), "id").count() == 10
    assert one != {r.id for r in prepare.bounded_sample(df, "id", seed=1).collect()}


def test_dense_index(spark):
    keys = np.random.default_rng(0).permutation(1000) * 7 + 13
    df = spark.createDataFrame([(int(k),) for k in keys], "key BIGINT").repartition(6)
    got = prepare.dense_index(df, "key", StepStore(spark, "t")).orderBy("key").toPandas()
    assert got.idx.tolist() == list(range(1000))
    numbered = prepare.row_numbers(df, StepStore(spark, "t")).toPandas()
    assert sorted(numbered.id) == list(range(1000))


def test_input_contract(spark):
    df = points(spark, [[1, 2], [3, 4]])
    assert prepare.clean_points(df).count() == 2
    bad = spark.createDataFrame([(0, [1.0, None]), (1, [1.0, 2.0]), (2, [1.0, float("inf")]), (3, None)], df.schema)
    with pytest.raises(ValueError, match="3 rows"):
        prepare.clean_points(bad)
    assert [r.id for r in prepare.clean_points(bad, "drop").collect()] == [1]
    with pytest.raises(ValueError, match="width"):
        prepare.clean_points(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], df.schema))


def test_profile_and_label(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, 4.0, None)], "x INT, y DOUBLE, s STRING")
    assert tuple(prepare.profile(df).first()) == (2, 2)
    got = [r[0] for r in df.select(prepare.experiment_label("umap", F.col("s"))).collect()]
    assert got == ["/a/umap", "/dev/umap"]


def test_steps_use_the_session_folder(spark):
    root = step_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    steps = StepStore(spark, "t")
    saved = steps.save(spark.range(5), "five")
    assert saved.count() == 5 and steps.root.startswith(root)


def _log(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = []
    for i in range(240):
        failed = i % 10 == 0
        rows.append(
            (start + dt.timedelta(minutes=i), "/train" if i % 3 else "/umap", "POST", 500 if failed else 200, float(i),
             1024 * i, i, 4, "computation_error" if failed else None, failed)
        )
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_request_operators(spark):
    log = _log(spark)
    assert requests.request_metrics(log).agg(F.sum("success")).first()[0] == 216
    assert requests.request_failures(log).count() == 24
    assert requests.input_sizes(log).filter("n_samples = 8").first().file_size_kb == 8.0
    assert sum(r.error_count for r in requests.typed_errors(log).collect()) == 24
    use = requests.store_use(spark.range(25)).first()
    assert (use.cached_models, use.cache_utilization_pct) == (25, 25.0)
    total = requests.endpoint_rollup(log).filter("endpoint IS NULL").first()
    assert total.requests == 240 and total.errors == 24 and total.error_rate == pytest.approx(0.1)
    q = {r.endpoint: r for r in requests.latency_quantiles(log).collect()}
    assert q["/umap"].p50 == pytest.approx(118.5, abs=3) and q["/umap"].p99 <= 239
    timed = requests.timed_blocks(log.withColumn("started", F.col("ts")).withColumn("ended", F.expr("ts + INTERVAL 2 SECONDS")))
    assert {r.latency_ms for r in timed.collect()} == {2000.0}


def test_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "log"), str(tmp_path / "rates")
    log = _log(spark)
    log.write.parquet(source)
    late = log.limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 DAYS"))
    late.write.mode("append").parquet(source)
    query = stream_rollup(spark, source, out, checkpoint=str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(out).orderBy("window_start", "endpoint").toPandas()
    want = requests.windowed_rollup(log).orderBy("window_start", "endpoint").toPandas()
    assert len(want) == 8 and got[want.columns].equals(want)


def test_csv_that_does_not_fit_its_schema_is_refused(spark, tmp_path):
    for name, text in (("order", "b,a,c\n1,2,3\n"), ("value", "a,b,c\n1,x,3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(Exception, match="(?i)header|malformed|csv"):
            tables.read_csv(spark, str(tmp_path / f"{name}.csv"), "a INT, b INT, c INT").collect()
