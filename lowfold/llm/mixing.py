"""Mixing sources to target weights with hash-threshold histograms.

Every document draws a number below 2**52 from its id and text. A pass over a source
takes the documents that draw below a threshold, so the thresholds of later
passes and smaller budgets pick subsets of earlier ones. Thresholds come from
histograms of sizes by source and hash bucket: only the bucket in which a
budget ends is split further, until it is a single draw. If that is the draw of
several equal rows, as many of them are taken as come nearest to the budget.
No row is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import SMALL_ROWS, WORD, steps

#: A draw has 13 hexadecimal digits; each level of the histogram reads 13 of its 52 bits.
DRAW_BITS, LEVEL_BITS = 52, 13
MAX_PASSES = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: int) -> Column:
    """Below 2**52, the same for every row with this key and text; a null draws as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, DRAW_BITS // 4), 16, 10).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...], max_passes: int) -> DataFrame:
    """``(source, source_size, target)`` from ``totals(source, source_size)``.

    The sources by code point, null last, weigh ``weights`` in turn and share
    the size of all. A target stops at ``max_passes`` times its source's size
    and the excess is shared again by weight. That ends at the water level
    ``max((all - caps before) / weights from here on)`` over the sources in
    order of cap by weight. One row a source, so these windows stay small.
    """
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    pick = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("weight", F.element_at(pick, (place % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_passes).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = W.orderBy("ratio", F.asc_nulls_last("source"))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    whole = W.partitionBy()
    ranked = ranked.withColumn("level", (F.sum("source_size").over(whole) - before) / after)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.max("level").over(whole))
    return ranked.select("source", "source_size", target.alias("target"))


def _near(big: DataFrame, small: DataFrame, *keys: str) -> DataFrame:
    """Inner join on keys that may be null; one row a key in ``small``, broadcast if it is small."""
    side = small.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in small.columns if c not in keys])
    if small.count() <= SMALL_ROWS:
        side = F.broadcast(side)
    on = [big[k].eqNullSafe(side[f"__{k}"]) for k in keys]
    return big.join(side, on).drop(*[f"__{k}" for k in keys])


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = MAX_PASSES, label: str = "mix") -> DataFrame:
    """``(source, source_size, target, thresholds, edge, some)`` for a written ``sized(source, size, draw)``.

    ``thresholds`` has one number for each pass, falling: pass ``k`` takes the
    documents that draw less. The document in which a budget ends is taken if
    that comes nearer to the budget. If it is one of several equal rows, these
    draw ``edge``, and ``some`` of them are taken once more than the thresholds say.
    """
    store = steps(sized.sparkSession, label)
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = store.save(targets(totals, weights, max_passes), "targets")
    full = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    rest = F.col("target") - full * F.col("source_size")
    state = wanted.filter(F.col("source_size") > 0).select("source", full.cast("long").alias("full"), rest.alias("budget"))
    state = state.filter((F.col("budget") > 0) & (F.col("full") < max_passes))
    state = store.save(state.withColumn("below", F.lit(0).cast("long")).withColumn("head", F.lit(0).cast("long")), "budgets")
    rows, found = sized, None
    for level in range(DRAW_BITS // LEVEL_BITS):
        shift = DRAW_BITS - LEVEL_BITS * (level + 1)
        rows = rows.withColumn("head", F.shiftright("draw", shift + LEVEL_BITS))
        keys = ["source", "head"]
        inside = _near(rows.select("source", "size", "draw", "head"), state, *keys)
        if level:  # only the bucket in which a budget ends is read again
            inside = store.save(inside, f"inside{level}")
            rows = inside.select("source", "size", "draw")
        bucket = F.shiftright("draw", shift).alias("bucket")
        sums = inside.groupBy("source", "budget", "full", "below", bucket).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.max("size").alias("most"))
        upto = F.col("below") + F.sum("size").over(W.partitionBy("source").orderBy("bucket"))
        ends = sums.withColumn("upto", upto).filter(F.col("upto") >= F.col("budget"))
        found = ends.groupBy("source", "budget", "full").agg(F.min_by(F.struct("bucket", "upto", "size", "n", "least", "most"), "bucket").alias("end"))
        state = found.select("source", "full", "budget", (F.col("end.upto") - F.col("end.size")).alias("below"), F.col("end.bucket").alias("head"))
        if level < DRAW_BITS // LEVEL_BITS - 1:
            state = store.save(state, f"state{level}")
    above = F.col("end.upto") - F.col("budget")
    under = F.col("budget") - (F.col("end.upto") - F.col("end.size"))
    equal = (F.col("end.n") > 1) & (F.col("end.least") == F.col("end.most")) & (F.col("end.least") > 0)
    some = F.when(equal, F.ceil(under / F.col("end.least") - 0.5).cast("long")).alias("some")
    whole = F.when(equal, F.lit(0)).otherwise((above < under).cast("int"))
    part = found.select(F.col("source").alias("__source"), (F.col("end.bucket") + whole).alias("part"), F.when(equal, F.col("end.bucket")).alias("edge"), some)
    out = wanted.join(part, F.col("source").eqNullSafe(F.col("__source")), "left")
    passes = [F.when(F.lit(k) < full, 1 << DRAW_BITS).when(F.lit(k) == full, F.coalesce("part", F.lit(0))).otherwise(0).cast("long") for k in range(max_passes)]
    empty = F.array(*[F.lit(0).cast("long")] * max_passes)
    limits = F.when(F.col("source_size") > 0, F.array(*passes)).otherwise(empty)
    return store.save(out.select("source", "source_size", "target", limits.alias("thresholds"), "edge", "some"), "thresholds")


def _passes(limits: Column, number: Column) -> Column:
    return F.size(F.filter(limits, lambda t: number < t)).cast("long")


def _copies(rows: DataFrame, limits: DataFrame, label: str) -> DataFrame:
    """``rows(source, __draw, ...)`` with ``__copies``; ``limits`` is what ``thresholds`` returns.

    The equal rows at the end of a budget are numbered as they are written: the
    last one taken is found by counts of 65,536 numbers at a time and by a sort
    of those in which it lies.
    """
    store = steps(rows.sparkSession, label)
    limits = limits.select("source", F.col("thresholds").alias("__limits"), F.col("edge").alias("__edge"), F.col("some").alias("__some"))
    out = _near(rows, limits, "source").withColumn("__copies", _passes(F.col("__limits"), F.col("__draw")))
    if not limits.filter(F.col("__some") > 0).limit(1).count():
        return out.drop("__limits", "__edge", "__some")
    at_edge = F.coalesce((F.col("__draw") == F.col("__edge")) & (F.col("__some") > 0), F.lit(False))
    equal = store.save(out.filter(at_edge).withColumn("__number", F.monotonically_increasing_id()), "equal")
    head = F.shiftright("__number", 16).alias("__head")
    sums = equal.groupBy("source", "__some", head).agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(W.partitionBy("source").orderBy("__head"))
    ends = sums.withColumn("__upto", upto).filter(F.col("__upto").between(F.col("__some"), F.col("__some") + F.col("__n") - 1))
    ends = ends.select("source", "__head", (F.col("__some") - F.col("__upto") + F.col("__n")).alias("__left"))
    near = _near(equal.select("source", "__number", head), store.save(ends, "equal-ends"), "source", "__head")
    place = F.row_number().over(W.partitionBy("source").orderBy("__number"))
    last = near.withColumn("__place", place).filter("__place = __left").select("source", F.col("__number").alias("__last"))
    more = _near(equal, store.save(last, "equal-last"), "source")
    more = more.withColumn("__copies", F.col("__copies") + (F.col("__number") <= F.col("__last")).cast("long")).drop("__number", "__last")
    return out.filter(~at_edge).unionByName(more).drop("__limits", "__edge", "__some")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = MAX_PASSES, seed: int = 17) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, a row for each row of ``docs(doc_id, text, source)``.

    ``size`` counts words, ``copies`` how often the mix takes the document and
    ``taken`` the words that makes. Null texts have size 0, null sources are
    one source, rows with the same id and another text draw for themselves, of
    equal rows any may be taken but always as many, other columns are ignored,
    an empty table gives none.
    """
    store = steps(docs.sparkSession, "mix")
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("__draw"))
    sized = store.save(sized, "sized")
    limits = thresholds(sized.select("source", "size", F.col("__draw").alias("draw")), weights, max_passes)
    out = _near(_copies(sized, limits, "mix-equal"), limits.select("source", "source_size", "target"), "source").withColumnRenamed("__copies", "copies")
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = MAX_PASSES, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with the columns of ``docs``."""
    store = steps(docs.sparkSession, "mixed")
    number = draw(F.col("doc_id"), F.col("text"), seed)
    sized = store.save(docs.select("source", words(F.col("text")).alias("size"), number.alias("draw")), "sized")
    many = _copies(docs.withColumn("__draw", number), thresholds(sized, weights, max_passes), "mixed-equal").filter("__copies > 0")
    return many.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)


def query(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


#: The same by a sort, for ``{docs}`` (doc_id, text, source) without equal rows, which it takes or leaves together.
SQL = r"""
WITH z AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
             CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS draw FROM {docs}),
  t AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM z GROUP BY source),
  w AS (SELECT source, s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM t),
  r AS (SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
  g AS (SELECT source, s, least(CAST(3 * s AS DOUBLE), w * max(level) OVER ()) AS target FROM r),
  b AS (SELECT *, floor(target / s) AS passes, target - floor(target / s) * s AS rest FROM g),
  d AS (SELECT source, draw, sum(size) AS size FROM z GROUP BY source, draw),
  u AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw) AS upto FROM d),
  e AS (SELECT u.source, min(draw) AS draw, arg_min(upto, draw) AS upto, arg_min(u.size, draw) AS size
        FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source WHERE upto >= rest AND rest > 0 GROUP BY u.source),
  h AS (SELECT b.source, b.s, b.target, b.passes, coalesce(e.draw + CAST(e.upto - rest < rest - (e.upto - e.size) AS BIGINT), 0) AS part
        FROM b LEFT JOIN e ON b.source IS NOT DISTINCT FROM e.source),
  m AS (SELECT z.*, h.s, h.target, CASE WHEN h.s > 0 THEN CAST(h.passes AS BIGINT) + CAST(z.draw < h.part AND h.passes < 3 AS BIGINT) ELSE 0 END AS copies
        FROM z JOIN h ON z.source IS NOT DISTINCT FROM h.source)
"""
ORACLE = SQL.format(docs="documents") + "SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, target, CAST(size * copies AS BIGINT) AS taken, source FROM m"
