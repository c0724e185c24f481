"""Benchmark decontamination by winnowing.

Of every run of ``SPAN`` words the smallest hash among its runs of ``GRAM``
words is kept, once where neighbouring runs keep the same one: about two
fingerprints in seven words. A span of ``SPAN`` words that a document shares
with a benchmark item keeps the same hash in both, so no shared span can be
missed. Fingerprints of documents and benchmark are joined, and a hit is
extended to the runs of words that keep it, which are then compared as words.
Everything runs as expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import SMALL_ROWS, by_ids, held_by_ids, steps, with_small

#: Words of a window, and of a hashed run within it.
SPAN, GRAM = 10, 5
#: What parts words once A-Z are lowered, and before.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), GAP), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _gram(hashes: Column, at: Column, gram: int = GRAM) -> Column:
    return F.xxhash64(*[hashes[at + k] for k in range(gram)])


def fingerprints(ws: Column, span: int = SPAN, gram: int = GRAM) -> Column:
    """``array<struct<fp, first, last>>`` of an array of words: a kept hash and the first and last window, from 0, that keeps it."""

    def grams(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - gram), lambda i: _gram(hashes, i, gram))

    def least(found: Column) -> Column:
        across = span - gram + 1
        return F.transform(F.sequence(F.lit(1), F.size(found) - across + 1), lambda j: F.array_min(F.slice(found, j, across)))

    def runs(kept: Column) -> Column:
        new = F.filter(F.sequence(F.lit(0), F.size(kept) - 1), lambda j: (j == 0) | (kept[j] != kept[F.greatest(j - 1, F.lit(0))]))
        ends = lambda starts: F.transform(starts, lambda s, k: F.struct(kept[s].alias("fp"), s.alias("first"), (F.coalesce(F.get(starts, k + 1), F.size(kept)) - 1).alias("last")))
        return _let(new, ends)

    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) >= span, _let(_let(_let(hashed, grams), least), runs))


def _window(start: Column, length) -> Column:
    return F.array_join(F.slice("ws", start + 1, length), " ")


def _hashed(rows: DataFrame) -> DataFrame:
    """``rows(__key, ws)`` with a row for each window, its place ``at`` and the hash that it keeps, the one of ``fingerprints``.

    Rows are compiled, unlike functions of arrays, and most are dropped by a
    join right behind; the words stay an array that is made once a text, so no
    filter may stand on it.
    """
    rows = rows.withColumn("__hashes", F.transform("ws", lambda w: F.xxhash64(w)))
    starts = F.when(F.size("ws") >= SPAN, F.sequence(F.lit(0), F.size("ws") - SPAN))
    rows = rows.select("__key", "ws", "__hashes", F.explode(starts).alias("at"))
    least = F.least(*[_gram(F.col("__hashes"), F.col("at") + k) for k in range(SPAN - GRAM + 1)])
    return rows.select("__key", "ws", "at", least.alias("fp"))


def _meeting(rows: DataFrame, ids: DataFrame, key: str, count: int) -> DataFrame:
    """``rows`` whose key is among ``ids``. Few ids are broadcast; of many, a bitmap of bounded size drops most rows before the shuffle."""
    return rows.join(F.broadcast(ids), key) if count <= SMALL_ROWS else by_ids(rows, ids, key)


def contamination(docs: DataFrame, benchmark: DataFrame, label: str = "winnow") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of each row of ``docs(doc_id, text)`` against ``benchmark(item_id, text)``.

    A window is ``SPAN`` consecutive words of an item, or all words of a
    shorter one. Null and empty texts have no words and no hits, items without
    words no windows. Items with equal ids count as one; a null id is written as
    an empty one. Equal documents are told alike, also with equal or null ids;
    texts that are repeated are searched apart but counted once. Other columns
    are ignored; without documents there are no rows, without a benchmark no
    hits.
    """
    store = steps(docs.sparkSession, label)
    mark = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    items = store.save(benchmark.select(item.alias("item"), words(F.col("text")).alias("ws")).filter(F.size("ws") > 0), "items")

    # The windows of the benchmark: each text of one once, with the items that hold it.
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - SPAN, F.lit(0)))
    spans = items.select("item", "ws", F.explode(starts).alias("at"))
    held = store.save(spans.select("item", _window(F.col("at"), F.lit(SPAN)).alias("window"), F.least(F.size("ws"), F.lit(SPAN)).alias("length")).distinct(), "held")
    windows = held.groupBy("window").agg(F.min("length").alias("length"))
    windows = store.save(windows.withColumn("wid", F.monotonically_increasing_id()), "windows")
    holders = store.save(held.join(windows.select("window", "wid"), "window").select("wid", "item"), "holders")

    texts = docs.select(mark.alias("__key"), words(F.col("text")).alias("ws"))
    kept = store.save(items.select(F.inline(fingerprints(F.col("ws")))).select("fp").distinct(), "fingerprints")
    few = kept.count() <= SMALL_ROWS
    near = _hashed(texts).join(F.broadcast(kept), "fp") if few else held_by_ids(_hashed(texts), kept, "fp")
    near = near.select("fp", "__key", "at", _window(F.col("at"), F.lit(SPAN)).alias("window"))
    near = (near if few else near.join(kept, "fp")).drop("fp")  # of many, only windows are shuffled, not whole texts

    # Items shorter than a window: wherever their first word stands, as many words as they have.
    short = items.filter(F.size("ws") < SPAN).select(F.col("ws")[0].alias("word"), F.size("ws").alias("length")).distinct()
    short = store.save(short.groupBy("word").agg(F.collect_set("length").alias("lengths")), "short")
    n_short = short.count()
    if n_short:
        each = _meeting(texts.select("__key", "ws", F.posexplode("ws").alias("at", "word")), short, "word", n_short)
        each = each.select("__key", "ws", "at", F.explode("lengths").alias("length")).filter(F.col("at") + F.col("length") <= F.size("ws"))
        near = near.unionByName(each.select("__key", "at", _window(F.col("at"), F.col("length")).alias("window")))
    hits = with_small(store.save(near, "near"), windows, ["window"])
    hits = hits.groupBy("__key").agg(F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end"))).alias("spans"), F.array_sort(F.collect_set("wid")).alias("wids"))
    hits = store.save(hits.withColumn("__set", F.sha2(F.array_join("wids", ","), 256)), "hits")

    # Documents that hold the same windows hold the same items.
    sets = hits.groupBy("__set").agg(F.any_value("wids").alias("wids")).select("__set", F.explode("wids").alias("wid"))
    found = sets.join(holders, "wid").groupBy("__set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = store.save(found.select("__set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "sets")

    def cover(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["at"], state["upto"]), F.lit(0))
        return F.struct((state["n"] + fresh).alias("n"), F.greatest(span["end"], state["upto"]).alias("upto"))

    covered = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")), cover)["n"].cast("long")
    told = with_small(hits.select("__key", "__set", covered.alias("n_hit")), found, ["__set"]).drop("__set")
    told = store.save(told, "told")

    n_words = F.size(F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), RAW_GAP), "")).cast("long")
    rows = store.save(docs.select("doc_id", mark.alias("__key"), n_words.alias("n_words")), "documents")
    out = with_small(rows, told, ["__key"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_sha256 = F.coalesce("items_sha256", F.sha2(F.lit(""), 256))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), items_sha256.alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def query(spark, sf: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
  i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
  m AS (SELECT item, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 8, 2))) AS k, ws FROM i WHERE len(ws) > 0),
  w AS (SELECT DISTINCT item, n, array_to_string(ws[k:k + n - 1], ' ') AS span FROM m),
  t AS (SELECT r, n, unnest(range(1, CAST(len(ws) - n + 2 AS BIGINT))) AS k, ws FROM d JOIN (SELECT DISTINCT n FROM w) ON len(ws) >= n),
  h AS (SELECT r, t.n, k, item FROM t JOIN w ON w.n = t.n AND span = array_to_string(ws[k:k + t.n - 1], ' ')),
  p AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, CAST(k + n AS BIGINT))) AS pos FROM h) GROUP BY r),
  s AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN p USING (r) LEFT JOIN s USING (r)
"""
