import pytest

from lowfold.llm import util


@pytest.mark.parametrize("small", [0, 100_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(util, "SMALL_ROWS", small)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (7, 7), (300, 300)] + [(k, k - 1) for k in range(430, 400, -1)]
    store = util.steps(spark, "test")
    got = {r.id: r.component for r in util.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), store).collect()}
    want = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200} | {k: 400 for k in range(400, 431)}
    assert got == want
    assert util.components(spark.createDataFrame([], "a BIGINT, b BIGINT"), store).count() == 0


@pytest.mark.parametrize("slots", [1 << 25, 1 << 15])
def test_rows_by_ids(spark, slots):
    rows = spark.range(5000).selectExpr("cast(id as string) as name", "id as v")
    ids = spark.range(0, 5000, 7).selectExpr("cast(id as string) as name", "id + 1 as w")
    got = util.by_ids(rows, ids, "name", slots).collect()
    assert sorted((r.v, r.w) for r in got) == [(k, k + 1) for k in range(0, 5000, 7)]


@pytest.mark.parametrize("small", [0, 100_000])
def test_small_sides(spark, monkeypatch, small):
    monkeypatch.setattr(util, "SMALL_ROWS", small)
    big = spark.range(30_000).selectExpr("case when id < 20000 then 1 else id end as k", "id as v")
    side = spark.range(0, 30_000, 3).selectExpr("id + 1 as k", "id as w")
    got = util.with_small(big, side, ["k"]).groupBy("k").count().collect()
    counts = {r.k: r["count"] for r in got}
    assert counts[1] == 20_000 and len(counts) == 1 + sum((k - 1) % 3 == 0 for k in range(20_000, 30_000))
    assert util.with_small(big, side, ["k"], "left").count() == 30_000
    assert util.with_small(big, side, ["k"], "left_anti").count() == 30_000 - sum(counts.values())
