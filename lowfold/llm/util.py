"""Joins that survive hot keys, id filters and connected components, shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowfold.session import StepStore

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: A side is broadcast up to so many rows (of a few numbers each, about 10 MB); beyond it the join shuffles.
SMALL_ROWS = 100_000
#: Slots of the id filter: at most 4 MB as bitmaps.
FILTER_SLOTS = 1 << 25


def steps(spark: SparkSession, label: str) -> StepStore:
    return StepStore(spark, label)


def with_small(big: DataFrame, side: DataFrame, keys: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """``big`` joined with a written ``side`` of one row a key, its size checked.

    Up to ``SMALL_ROWS`` rows the side is broadcast, so no key of ``big`` moves.
    Beyond that the join shuffles, and the keys of ``big`` that hold over one
    row in a thousand are joined apart: there are fewer than a thousand of
    them, so their side rows are broadcast.
    """
    rows = side.count() if rows is None else rows
    if rows <= SMALL_ROWS:
        return big.join(F.broadcast(side), keys, how)
    sizes = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    total = sizes.agg(F.sum("__rows")).first()[0] or 0
    hot = F.broadcast(sizes.filter(F.col("__rows") > max(10_000, total // 1000)).select(*keys))
    far = big.join(hot, keys, "left_anti").join(side, keys, how)
    near = big.join(hot, keys, "left_semi").join(F.broadcast(side.join(hot, keys, "left_semi")), keys, how)
    return far.unionByName(near)


def by_ids(rows: DataFrame, ids: DataFrame, key: str, slots: int = FILTER_SLOTS) -> DataFrame:
    """``rows`` joined with ``ids`` (one row a key), most other rows dropped before they are shuffled."""
    return held_by_ids(rows, ids, key, slots).join(ids, key)


def held_by_ids(rows: DataFrame, ids: DataFrame, key: str, slots: int = FILTER_SLOTS) -> DataFrame:
    """``rows`` whose key may be among ``ids``, without a shuffle.

    The keys are first folded into bitmaps, 4 KB for 32,768 slots and at most
    ``slots`` slots in all, which is what is broadcast. A slot shared by chance
    lets a row through, so an exact join has to follow.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(slots)) + 1
    maps = ids.select(slot.alias("__slot")).groupBy(F.expr("bitmap_bucket_number(__slot)").alias("__part"))
    maps = maps.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(__slot))").alias("__map"))
    marked = rows.withColumn("__slot", slot).withColumn("__part", F.expr("bitmap_bucket_number(__slot)"))
    byte = F.expr("conv(hex(substring(__map, cast(bitmap_bit_position(__slot) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    bit = F.expr("shiftleft(1, cast(bitmap_bit_position(__slot) % 8 as int))")
    held = marked.join(F.broadcast(maps), "__part").filter(byte.bitwiseAND(bit) != 0)
    return held.drop("__slot", "__part", "__map")


def components(edges: DataFrame, store: StepStore) -> DataFrame:
    """``(id, component)`` of each node of ``edges(a, b)``: the smallest id it can reach.

    Each round hangs every current label on the smallest label among its
    neighbours, follows the pointers to their ends and contracts the edges, so
    each round at least halves the labels that still have edges. Star centres
    may have any number of edges: they are pre-aggregated by ``min`` and looked
    up by ``with_small``.
    """
    now = store.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    pointers = []
    while now.limit(1).count():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = store.save(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("p")), "hang")
        while True:
            rows = up.count()
            lookup = up.select(F.col("v").alias("p"), F.col("p").alias("q"))
            jumped = store.save(with_small(up, lookup, ["p"], rows=rows).select("v", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "jump")
            moved = jumped.filter("moved").limit(1).count()
            up = jumped.select("v", "p")
            if not moved:
                break
        pointers.append(up)
        rows = up.count()
        for side in ("a", "b"):
            now = with_small(now, up.select(F.col("v").alias(side), F.col("p").alias("__p")), [side], rows=rows).drop(side).withColumnRenamed("__p", side)
        now = store.save(now.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    if not pointers:
        return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = pointers[0].select(F.col("v").alias("id"), F.col("p").alias("component"))
    for later in pointers[1:]:
        moved = later.select(F.col("v").alias("component"), F.col("p").alias("__p"))
        found = with_small(found, moved, ["component"], "left").select("id", F.coalesce("__p", "component").alias("component"))
    return store.save(found, "components")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of few rows, unless the user chose a size, so that very long texts stay within a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))
