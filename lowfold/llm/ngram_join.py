"""N-gram Jaccard join: documents that share enough of their word shingles.

Documents are rows and shingles columns of a sparse incidence matrix; the
overlaps of all pairs are its product with its transpose, built from blocks of
columns and summed. Bounds from the set sizes keep most of it from being built:
two sets of Jaccard similarity t share a shingle among the first
``n - ceil(t n) + 1`` of each in any one order of all shingles, so only these
columns are read; and a pair whose overlap within them is too small for its
sizes is dropped. Pairs left are checked on their whole sets.

The order puts shingles that many documents share last. It is found in rounds:
documents give their first shingles by hash, those with too many documents are
marked common, and documents short of uncommon ones give more. Documents made
mostly of common shingles (large groups of near copies) are joined among
themselves, first with the member that stands in the middle of each group and
then across the groups that remain, so a group's pairs are never written out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import WORD, by_ids, components, held_by_ids, small_batches, steps, with_small

#: A shingle that more documents give in one round is common.
COMMON = 32
#: Words of texts that are mixed in one go, which fit a core's cache.
MIXED_WORDS = 8192
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STIR = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray, run: int) -> np.ndarray:
    """Hashes of the runs of ``run`` words that begin at each word but the last ones."""
    out = np.full(len(h) - run + 1, run, np.uint64)
    for k in range(run):
        out ^= out >> np.uint64(31)
        out *= _MIX
        out += h[k : len(h) - run + 1 + k]
        out ^= out >> np.uint64(29)
        out *= _STIR
    return out.view(np.int64)


def _distinct(found: np.ndarray) -> np.ndarray:
    found.sort()
    new = found[1:] != found[:-1]
    return found if new.all() else found[np.concatenate([[True], new])]


def shingles(texts: Iterable[str | None], size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of ``size`` words; a shorter text is one run, no words are none.

    The words of several texts are mixed in one go, and runs across two texts left out.
    """
    held: list[np.ndarray] = []
    count = 0

    def out() -> Iterator[np.ndarray]:
        runs, at = _mixed(np.concatenate([*held, np.zeros(size - 1, np.uint64)]), size), 0
        for h in held:
            if len(h) >= size:
                yield _distinct(runs[at : at + len(h) - size + 1].copy())
            else:
                yield _mixed(h, len(h)) if len(h) else np.zeros(0, np.int64)
            at += len(h)

    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        held.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        count += len(words)
        if count >= MIXED_WORDS:
            yield from out()
            held, count = [], 0
    if held:
        yield from out()


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _prefix(n, percent: int):
    """How many shingles of a set of ``n`` must be read."""
    return n - (percent * n + 99) // 100 + 1


def _mark(text: Column) -> Column:
    """Digest of a text."""
    return F.unhex(F.sha2(text, 256))


def _need(n: Column, percent: int) -> Column:
    return n - F.expr(f"({percent} * n + 99) div 100") + 1


def _overlap(x: str, y: str, percent: int) -> Column:
    """Least overlap of a linked pair with sizes ``x`` and ``y``."""
    return F.expr(f"({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent}")


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``(doc_id, name, mark, n, key, head)``: the size and digest of each set and the shingles of its prefix."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [*shingles(batch.column(3).to_pylist(), size)]
            heads = [s[: _prefix(len(s), percent)] if len(s) else s for s in found]
            ends = np.cumsum([0, *map(len, heads)])
            head = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*heads, np.zeros(0, np.int64)])))
            yield pa.record_batch([*batch.columns[:3], pa.array([len(s) for s in found], pa.int64()), pa.array([_key(s) for s in found], pa.binary()), head], names=["doc_id", "name", "mark", "n", "key", "head"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "name", "mark", "text").mapInArrow(read, f"doc_id {kind}, name long, mark binary, n long, key binary, head array<long>")


def _fetch(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(cid, tokens)``: for ``wanted(name, cid, key, low, high)`` the shingles from place ``low`` to before ``high``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, parts = [], []
            texts, *others = (c.to_pylist() for c in batch.columns)
            for found, cid, key, low, high in zip(shingles(texts, size), *others, strict=True):
                if _key(found) == key:
                    cids.append(cid)
                    parts.append(found[low:high])
            ends = np.cumsum([0, *map(len, parts)])
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))
            yield pa.record_batch([pa.array(cids, pa.int64()), tokens], names=["cid", "tokens"])

    rows = by_ids(docs.select("name", "text"), wanted, "name").select("text", "cid", "key", "low", "high")
    return rows.mapInArrow(read, "cid long, tokens array<long>").dropDuplicates(["cid"])


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int, label: str, marked: bool = False):
        self.spark, self.size, self.percent = docs.sparkSession, size, percent
        small_batches(self.spark)
        self.store = steps(self.spark, label)
        # Ids may repeat or be null, so a row is fetched by its id and text; a chance collision fetches a row too many, which its key tells.
        name = F.xxhash64("doc_id", "text")
        mark = _mark(F.col("text")) if marked else F.lit(None).cast("binary")
        self.docs = docs.select("doc_id", "text").withColumn("name", name).withColumn("mark", mark)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        return self.store.save(df, name)

    def groups(self) -> tuple[DataFrame, DataFrame]:
        """The sets of the rows, and ``(key, component, component_id)`` of those with words."""
        rows = self.save(_sets(self.docs, self.size, self.percent), "sets")
        classes = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.min("name").alias("name"), F.any_value("n").alias("n"), F.any_value("head").alias("head"))
        self.classes = self.save(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
        self.base = self.classes.select("cid", "name", "key", "n", _need(F.col("n"), self.percent).alias("p"))
        given, common, state = self._prefixes()
        links = self._uncommon(given, common, state)
        links = self._among_common(given, state, links)
        reach = components(links, self.store)
        known = self.classes.select("cid", "key", "first").join(reach.withColumnRenamed("id", "cid"), "cid", "left")
        known = self.save(known.withColumn("component", F.coalesce("component", "cid")), "known")
        least = self.save(known.groupBy("component").agg(F.min("first").alias("component_id")), "least")
        return rows, self.save(with_small(known, least, ["component"]).select("key", "component", "component_id"), "told")

    def run(self) -> DataFrame:
        """``(doc_id, n, component_id)``."""
        rows, told = self.groups()
        linked = with_small(rows.filter("n > 0").select("doc_id", "n", "key"), told.select("key", "component_id"), ["key"]).select("doc_id", "n", "component_id")
        return linked.unionByName(rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))

    def _prefixes(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Postings ``(token, cid, n)`` given so far, the common tokens, and ``(cid, n, p, given, uncommon, last)`` per class."""
        first = self.classes.select("cid", "n", F.explode("head").alias("token"))
        fresh = given = self.save(first.select("token", "cid", "n"), "given")
        last = F.when(F.col("n") <= F.size("head"), F.lit((1 << 63) - 1)).otherwise(F.element_at("head", -1))
        state = self.classes.select("cid", "name", "key", "n", _need(F.col("n"), self.percent).alias("p"), F.size("head").cast("long").alias("given"), last.alias("last"))
        state = self.save(state, "state")
        common = None
        while True:
            new = fresh.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > COMMON).select("token")
            common = self.save(new if common is None else common.unionByName(new).distinct(), "common")
            hits = with_small(given, common, ["token"]).groupBy("cid").agg(F.count(F.lit(1)).alias("hits"))
            state = self.save(state.drop("uncommon").join(hits, "cid", "left").withColumn("uncommon", F.col("given") - F.coalesce("hits", F.lit(0))).drop("hits"), "state")
            short = state.filter("uncommon < p and given < n")
            grown = F.least("n", F.col("given") + F.greatest(2 * (F.col("p") - F.col("uncommon")), F.expr("given div 2")))
            wanted = self.save(short.select("name", "cid", "key", F.col("given").alias("low"), grown.alias("high")), "short")
            if not wanted.limit(1).count():
                return given, common, state
            more = self.save(_fetch(self.docs, wanted, self.size), "more")
            sizes = state.select("cid", "n")
            fresh = self.save(more.join(sizes, "cid").select(F.explode("tokens").alias("token"), "cid", "n"), "fresh")
            given = given.unionByName(fresh)
            ends = more.select("cid", F.element_at("tokens", -1).alias("end")).join(wanted.select("cid", "high"), "cid")
            state = state.join(ends, "cid", "left").withColumn("given", F.coalesce("high", "given"))
            last = F.when(F.col("given") >= F.col("n"), F.lit((1 << 63) - 1)).otherwise(F.coalesce("end", "last"))
            state = state.withColumn("last", last).drop("end", "high")

    def _sized(self, x: str, y: str) -> Column:
        return F.expr(f"100 * least({x}, {y}) >= {self.percent} * greatest({x}, {y})")

    def _uncommon(self, given: DataFrame, common: DataFrame, state: DataFrame) -> DataFrame:
        """Links of pairs that meet in an uncommon token. Such a token has a bounded number of documents."""
        rare = with_small(given, common, ["token"], "left_anti")
        x, y = (rare.select("token", F.col("cid").alias(c), F.col("n").alias(f"n{c}")) for c in ("x", "y"))
        pairs = x.join(y, "token").filter("x < y").filter(self._sized("nx", "ny"))
        product = pairs.groupBy("x", "y", "nx", "ny").agg(F.count(F.lit(1)).alias("c"))
        product = self.save(product, "product")
        for side in ("x", "y"):
            known = state.select(F.col("cid").alias(side), F.col("uncommon").alias(f"u{side}"), F.col("last").alias(f"l{side}"))
            product = product.join(known, side)
        # Of the one read less far, every uncommon token up to its last one is known to be in the other or not.
        least = _overlap("nx", "ny", self.percent)
        low_x = F.col("c") >= F.col("ux") - (F.col("nx") - least)
        low_y = F.col("c") >= F.col("uy") - (F.col("ny") - least)
        product = product.filter(F.when(F.col("lx") <= F.col("ly"), low_x).otherwise(low_y))
        candidates = self.save(product.select("x", "y", "nx", "ny", (F.col("c") / F.least("ux", "uy")).alias("share")), "candidates")
        return self._checked(candidates)

    def _checked(self, candidates: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """Links that connect what ``candidates(x, y, nx, ny, share)`` connect: each document's best pair first, then pairs across groups."""
        ends = candidates.select(F.col("x").alias("cid"), "x", "y", "share").unionByName(candidates.select(F.col("y").alias("cid"), "x", "y", "share"))
        best = ends.groupBy("cid").agg(F.max(F.struct("share", F.struct(-F.col("x"), -F.col("y")).alias("at"))).alias("best"))
        best = best.select((-F.col("best.at.col1")).alias("x"), (-F.col("best.at.col2")).alias("y")).distinct()
        best = self.save(candidates.join(best, ["x", "y"]).select("x", "y", "nx", "ny"), "best")
        wanted = best.select(F.explode(F.array("x", "y")).alias("cid")).distinct()
        sets = self._whole(wanted)
        links = self._verified(best, sets, sets.count())
        links = links if known is None else known.unionByName(links)
        rest = candidates.join(best.select("x", "y"), ["x", "y"], "left_anti")
        rest = self._across(rest, links).select("x", "y", "nx", "ny")
        rest = self.save(rest, "rest")
        # Each document of a pair is in a best pair, so its set is there.
        ends = self.save(rest.select(F.explode(F.array("x", "y")).alias("cid")).distinct(), "ends")
        more = self._verified(rest, held_by_ids(sets, ends, "cid"), ends.count())
        return self.save(links.unionByName(more), "links")

    def _across(self, pairs: DataFrame, links: DataFrame) -> DataFrame:
        """The pairs whose ends are not connected yet."""
        reach = components(links, self.store)
        rows = reach.count()
        for side in ("x", "y"):
            pairs = with_small(pairs, reach.select(F.col("id").alias(side), F.col("component").alias(f"g{side}")), [side], "left", rows)
        return pairs.filter(F.coalesce("gx", "x") != F.coalesce("gy", "y")).drop("gx", "gy")

    def _whole(self, wanted: DataFrame) -> DataFrame:
        """``(cid, tokens)``, the whole sets of ``wanted(cid)``."""
        whole = self.base.join(wanted, "cid").select("name", "cid", "key", F.lit(0).cast("long").alias("low"), F.col("n").alias("high"))
        return self.save(_fetch(self.docs, self.save(whole, "whole"), self.size), "tokens")

    def _verified(self, pairs: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
        """``(a, b)`` of the pairs ``(x, y, nx, ny)`` that are linked, by their whole sets, of which there are about ``rows``."""
        for side in ("x", "y"):
            # Sets are longer than the rows that with_small broadcasts, so fewer of them are small.
            pairs = with_small(pairs, sets.select(F.col("cid").alias(side), F.col("tokens").alias(f"t{side}")), [side], rows=rows * 500)
        both = F.size(F.array_intersect("tx", "ty"))
        linked = 100 * both >= self.percent * (F.col("nx") + F.col("ny") - both)
        return self.save(pairs.filter(linked).select(F.col("x").alias("a"), F.col("y").alias("b")), "verified")

    def _among_common(self, given: DataFrame, state: DataFrame, links: DataFrame) -> DataFrame:
        """``links`` and those among documents that are all read and short of uncommon tokens."""
        inner = self.save(state.filter("uncommon < p and given >= n").select("cid", "n", "p"), "inner")
        if not inner.limit(1).count():
            return links
        rows = with_small(given.select("token", "cid"), inner, ["cid"])
        rows = self.save(rows.select("token", "cid", "n", "p"), "postings")
        docs = self.save(rows.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1"), "docs")
        rows = with_small(rows, docs, ["token"])
        # The rarest shared tokens first. Tokens of one document are in no pair, so overlaps are at most ``shared``.
        by_doc = W.partitionBy("cid")
        rows = rows.withColumn("place", F.row_number().over(by_doc.orderBy("docs", "token"))).withColumn("shared", F.count(F.lit(1)).over(by_doc))
        # Places count the tokens that are not shared, which come first.
        rows = rows.withColumn("place", F.col("place") + F.col("n") - F.col("shared"))
        rows = rows.filter(F.col("place") <= F.col("p")).select("token", "cid", "n", "shared", "place")
        rows = self.save(rows, "inner-prefix")
        middle = rows.groupBy("token").agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("part"), (-F.col("cid")).alias("cid"), F.col("n").alias("n"), F.col("shared").alias("shared"))).alias("m"))
        middle = self.save(middle.select("token", (-F.col("m.cid")).alias("hub"), F.col("m.n").alias("hub_n"), F.col("m.shared").alias("hub_shared")), "middle")
        near = with_small(rows, middle, ["token"]).filter("cid <> hub").filter(self._sized("n", "hub_n"))
        near = near.filter(F.least("shared", "hub_shared") >= _overlap("n", "hub_n", self.percent))
        near = near.groupBy("cid", "n", "hub", "hub_n").agg(F.count(F.lit(1)).alias("c"))
        near = near.groupBy("cid", "n").agg(F.max(F.struct("c", (-F.col("hub")).alias("hub"), "hub_n")).alias("m"))
        stars = near.select(F.least("cid", -F.col("m.hub")).alias("x"), F.greatest("cid", -F.col("m.hub")).alias("y"), F.col("n").alias("nx"), F.col("m.hub_n").alias("ny")).dropDuplicates(["x", "y"])
        stars = self.save(stars, "stars")
        sets = self._whole(stars.select(F.explode(F.array("x", "y")).alias("cid")).distinct())
        links = self.save(links.unionByName(self._verified(stars, sets, sets.count())), "links")
        # What is left are pairs across groups: each document outside the group of its token's middle, with the others.
        reach = components(links, self.store)
        reached = reach.count()
        rows = with_small(rows, reach.select(F.col("id").alias("cid"), "component"), ["cid"], "left", reached)
        rows = self.save(rows.withColumn("component", F.coalesce("component", "cid")), "grouped")
        mixed = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max(F.struct((F.col("shared") / F.col("n")).alias("part"), (-F.col("cid")).alias("cid"), F.col("component").alias("of"))).alias("m"))
        mixed = self.save(mixed.filter("low <> high").select("token", F.col("m.of").alias("major")), "mixed")
        rows = with_small(rows, mixed, ["token"])
        x = rows.filter("component <> major").select("token", *[F.col(c).alias(f"{c}_x") for c in ("cid", "n", "shared", "place", "component")])
        y = rows.select("token", "major", *[F.col(c).alias(f"{c}_y") for c in ("cid", "n", "shared", "place", "component")])
        once = (F.col("component_y") == F.col("major")) | (F.col("cid_x") < F.col("cid_y"))
        # The first token that a linked pair shares stands early enough in both for the rest to make up its overlap.
        least = _overlap("n_x", "n_y", self.percent)
        early = (F.col("place_x") <= F.col("n_x") - least + 1) & (F.col("place_y") <= F.col("n_y") - least + 1)
        bound = (F.least("shared_x", "shared_y") >= least) & early
        pairs = x.join(y, "token").filter((F.col("component_x") != F.col("component_y")) & once & self._sized("n_x", "n_y") & bound)
        pairs = pairs.groupBy(F.least("cid_x", "cid_y").alias("x"), F.greatest("cid_x", "cid_y").alias("y"), F.col("n_x").alias("nx"), F.col("n_y").alias("ny")).agg(F.count(F.lit(1)).alias("share"))
        pairs = self.save(pairs.join(stars.select("x", "y"), ["x", "y"], "left_anti"), "across")
        return self._checked(pairs, links)


def near_copies(docs: DataFrame, size: int = 4, percent: int = 85, label: str = "ngrams") -> DataFrame:
    """``(doc_id, n, component_id)`` for each row of ``docs(doc_id, text)``.

    ``n`` is the number of distinct runs of ``size`` words, ``component_id``
    the smallest id that links of at least ``percent`` in a hundred reach.
    Null texts and texts without words have no runs and no links; equal sets
    are one class, so any number of copies costs one; rows with equal ids are
    separate documents; null ids are smaller than none, so a component of
    null ids alone has a null id. Other columns are ignored; an empty table
    gives no rows.
    """
    return _Join(docs, size, percent, label).run()


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one row of each group left, and all rows without words, which are in no group.

    It is the row with the smallest id, null ids last, and of equal ids the
    one whose text has the smallest SHA-256. Rows equal in both are told apart
    by their other columns, as JSON; rows equal in all columns are one.
    """
    join = _Join(docs, size, percent, "ngram-stage", marked=True)
    rows, told = join.groups()
    rows = with_small(rows.filter("n > 0").select("doc_id", "mark", "key"), told.select("key", "component"), ["key"])
    least = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("least"))

    def name(doc_id: str, mark: Column) -> Column:
        return F.concat(F.hex(mark), F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit("")))

    kept = join.save(least.select(name("least.doc_id", F.col("least.mark")).alias("__name")), "kept")
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    # Copies of a row meet before they are shuffled, so a row that is repeated any number of times is one row a task.
    held = held_by_ids(docs.filter(worded).withColumn("__name", name("doc_id", _mark(F.col("text")))), kept, "__name")
    held = held.groupBy("__name").agg(F.min_by(F.struct(*docs.columns), order).alias("__row"))
    return held.join(kept, "__name", "left_semi").select("__row.*").unionByName(docs.filter(~worded))


def query(spark, sf: str) -> DataFrame:
    out = near_copies(spark.read.parquet(f"{sf}/documents.parquet"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  l AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
          ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] for i in range(1, len(ws) - 2)]) END AS g FROM w),
  s AS (SELECT doc_id, unnest(g) AS g FROM l),
  z AS (SELECT doc_id, len(g) AS n FROM l),
  p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  e AS (SELECT x, y FROM p JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
  u AS (SELECT x AS a, y AS b FROM e UNION ALL SELECT y, x FROM e),
  r AS (SELECT doc_id AS a, doc_id AS b FROM z UNION SELECT r.a, u.b FROM r JOIN u ON u.a = r.b)
SELECT z.doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(b) AS component_id FROM z JOIN r ON r.a = z.doc_id GROUP BY z.doc_id
"""
