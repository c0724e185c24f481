"""Phrase collocations from a weighted de Bruijn graph.

Nodes are runs of three words and edges runs of four, weighted by how often
they come. Every word of a piece begins one run; near the end of a piece the run
is shorter, which is the piece-end correction. The count of a node is the sum
of its edges and of the runs that end with it; likewise pairs from nodes and
words from pairs, so only the longest runs are counted in the text. Unary paths
of edges that reach the least count are compacted by pointer doubling: a node
inside one has the count of its edges and is no candidate of its own.

A phrase that is too rare can neither be a candidate nor a part of one, and no
phrase around it can. A first reading therefore counts words and pairs by a
64-bit hash; runs are cut at words and between pairs that are too rare, which
keeps most of the text from being shuffled as words. Hashes that coincide only
let more of it through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import FILTER_SLOTS, small_batches, steps, with_small

#: Occurrences of a candidate at least; phrases a language returns; share, in a hundred, of a longer phrase that drops a shorter one.
LEAST, TOP, COVER = 30, 2000, 80
LONGEST = 4
#: Words that a task counts before it gives out what it has, and words of one language and document read at once.
CHUNK_WORDS, SLICE_WORDS = 2_000_000, 30_000
_BREAK = b"\xff"  # in no UTF-8 text
_SIGNS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")
_MIX, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
TOTAL, WORD, PAIR = 0, 1, 2


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, with ``_BREAK`` between pieces."""
    return text.lower().translate(_SIGNS).replace(_BREAK, b" \xff ").split()


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang.encode()))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left ^ (left >> np.uint64(31))) * _MIX + right
    return (out ^ (out >> np.uint64(29))) * _STIR


class _Words:
    """Numbers and hashes of the words of a chunk; 0 is a break, and so are words that ``frequent`` refuses."""

    def __init__(self, frequent=None):
        self.frequent = frequent
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, dict[bytes, int]] = {}
        self.words, self.langs, self.hashes = [b""], [""], [0]

    def __call__(self, lang: str, found: list[bytes]) -> np.ndarray:
        known = self.known.get(lang)
        if known is None:
            known = self.known[lang] = {_BREAK: 0}
        for word in set(found).difference(known):
            h = word_hash(lang, word)
            if self.frequent is not None and not self.frequent(h):
                known[word] = 0
                continue
            known[word] = len(self.words)
            self.words.append(word)
            self.langs.append(lang)
            self.hashes.append(h)
        return np.fromiter(map(known.__getitem__, found), np.uint32, len(found))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")


def _read_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, kind, hash, n)``: words of each language, and each word and pair by hash."""
    words, ids, size, totals = _Words(), [], 0, Counter()

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal ids, size
        every, hashes = np.concatenate([*ids, np.zeros(1, np.uint32)]), np.asarray(words.hashes, np.uint64)
        ids, size = [], 0
        found = np.bincount(every, minlength=len(hashes))
        one = pa.nulls(len(hashes) - 1, pa.string()), np.full(len(hashes) - 1, WORD, np.int8), hashes[1:].view(np.int64), found[1:]
        left, right = every[:-1].astype(np.uint64), every[1:].astype(np.uint64)
        both = (left > 0) & (right > 0)
        pairs, n = np.unique(left[both] << np.uint64(32) | right[both], return_counts=True)
        h = pair_hash(hashes[pairs >> np.uint64(32)], hashes[pairs & np.uint64(0xFFFFFFFF)])
        two = pa.nulls(len(h), pa.string()), np.full(len(h), PAIR, np.int8), h.view(np.int64), n
        for lang, kind, key, n in (one, two):
            yield pa.record_batch([lang, pa.array(kind), pa.array(key), pa.array(n.astype(np.int64))], names=["lang", "kind", "hash", "n"])
        words.clear()

    for lang, text in _rows(batches):
        found = tokens(text)
        ids.append(words(lang, found))
        ids.append(np.zeros(1, np.uint32))
        totals[lang] += int(np.count_nonzero(ids[-2]))
        size += len(found) + 1
        if size >= CHUNK_WORDS:
            yield from out()
    yield from out()
    zeros = np.zeros(len(totals), np.int64)
    yield pa.record_batch([pa.array(list(totals), pa.string()), pa.array(zeros.astype(np.int8)), pa.array(zeros), pa.array(list(totals.values()), pa.int64())], names=["lang", "kind", "hash", "n"])


def _bitmap(frequent: DataFrame, slots: int) -> bytes:
    """The hashes of ``frequent`` as bits; what reaches the driver is 4 KB for 32,768 slots, ``slots`` bits at most."""
    slot = F.col("hash").bitwiseAND(F.lit(slots - 1)) + 1
    maps = frequent.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("part"))
    flat = bytearray(slots // 8)
    for row in maps.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect():
        at = (row["part"] - 1) * 4096
        flat[at : at + 4096] = row["bits"][: slots // 8]
    return bytes(flat)


def _runs(docs: DataFrame, bits: bytes, slots: int) -> DataFrame:
    """``(lang, head, last, size, n)``: the run of up to four words that begins at each word, the first three as ``head``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, mask = np.frombuffer(bits, np.uint8), np.uint64(slots - 1)
        frequent = lambda h: bits[(h & (slots - 1)) >> 3] >> (h & 7) & 1
        words, ids, begins, size = _Words(frequent), [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal ids, begins, size
            every = np.concatenate([*ids, np.zeros(LONGEST, np.uint32)])
            begin = np.concatenate(begins) & (every[:-LONGEST] > 0)
            h = np.asarray(words.hashes, np.uint64)[every]
            slot = pair_hash(h[:-1], h[1:]) & mask
            joined = (flat[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            joined &= (every[:-1] > 0) & (every[1:] > 0)
            at = np.flatnonzero(begin)
            run, held = every[at].astype(np.uint64), np.ones(len(at), bool)
            for k in range(1, LONGEST):
                held &= joined[at + k - 1]
                run = run << np.uint64(16) | np.where(held, every[at + k], 0).astype(np.uint64)
            runs, n = np.unique(run, return_counts=True)
            ids, begins, size = [], [], 0
            at = [(runs >> np.uint64(16 * (3 - k)) & np.uint64(0xFFFF)).astype(np.int32) for k in range(LONGEST)]
            text = pa.array([*words.words], pa.binary()).cast(pa.string())
            take = lambda k: text.take(pa.array(at[k], mask=at[k] == 0))
            lang = pa.array(words.langs, pa.string()).take(pa.array(at[0]))
            head = pc.binary_join_element_wise(take(0), take(1), take(2), " ", null_handling="skip")
            length = sum((a > 0).astype(np.int32) for a in at)
            columns = [lang, head, take(3), pa.array(length), pa.array(n.astype(np.int64))]
            whole = pa.record_batch(columns, names=["lang", "head", "last", "size", "n"])
            words.clear()
            for k in range(0, whole.num_rows, 100_000):
                yield whole.slice(k, 100_000)

        for lang, text in _rows(batches):
            found = tokens(text)
            for start in range(0, len(found), SLICE_WORDS):
                part = found[start : start + SLICE_WORDS + LONGEST - 1]
                if size >= CHUNK_WORDS or len(words.words) + len(part) >= 1 << 16:
                    if ids:
                        yield from out()
                    words.clear()
                ids += [words(lang, part), np.zeros(1, np.uint32)]
                begin = np.zeros(len(part) + 1, bool)
                begin[:SLICE_WORDS] = True
                begins.append(begin)
                size += len(part) + 1
        if ids:
            yield from out()

    return _texts(docs).mapInArrow(read, "lang string, head string, last string, size int, n long")


def _words_of(text: str, low: int, high: int) -> Column:
    """Words ``low`` to ``high``, from 1, of a phrase."""
    return F.array_join(F.slice(F.split(text, " "), low, high - low + 1), " ")


class Graph:
    """The weighted graph of a corpus.

    ``totals(lang, n)``; ``counts(lang, phrase, size, n)`` of the phrases of one
    to four words that come ``least`` times or more; ``paths(lang, phrase,
    edges, n)``, the compacted edges among them; and ``inner(lang, phrase)``,
    the nodes inside paths of two edges or more.
    """

    def __init__(self, docs: DataFrame, least: int = LEAST, slots: int = FILTER_SLOTS, label: str = "collocations"):
        small_batches(docs.sparkSession)
        self.least, self.store = least, steps(docs.sparkSession, label)
        read = _texts(docs).mapInArrow(_read_counts, "lang string, kind byte, hash long, n long")
        seen = read.groupBy("lang", "kind", "hash").agg(F.sum("n").alias("n"))
        seen = self.store.save(seen.filter((F.col("n") >= least) | (F.col("kind") == TOTAL)), "seen")
        self.totals = seen.filter((F.col("kind") == TOTAL) & (F.col("n") > 0)).select("lang", "n")
        bits = _bitmap(seen.filter(F.col("kind") > TOTAL), slots)
        runs = _runs(docs, bits, slots).groupBy("lang", "head", "last", "size").agg(F.sum("n").alias("n"))
        runs = self.store.save(runs, "runs")
        nodes = self._flow(runs.filter("size >= 3").select("lang", F.col("head").alias("phrase"), "n"), "nodes")
        pairs = nodes.select("lang", _words_of("phrase", 1, 2).alias("phrase"), "n")
        pairs = self._flow(pairs.unionByName(runs.filter("size = 2").select("lang", F.col("head").alias("phrase"), "n")), "pairs")
        words = pairs.select("lang", _words_of("phrase", 1, 1).alias("phrase"), "n")
        words = self._flow(words.unionByName(runs.filter("size = 1").select("lang", F.col("head").alias("phrase"), "n")), "words")
        edges = runs.filter(f"size = 4 AND n >= {least}").select("lang", F.concat_ws(" ", "head", "last").alias("phrase"), "n")
        edges = self.store.save(edges.withColumn("eid", F.monotonically_increasing_id()), "edges")
        every = [t.filter(F.col("n") >= least).select("lang", "phrase", F.lit(k + 1).alias("size"), "n") for k, t in enumerate((words, pairs, nodes, edges))]
        self.counts = self.store.save(every[0].unionByName(every[1]).unionByName(every[2]).unionByName(every[3]), "counts")
        self._compact(edges)

    def _flow(self, rows: DataFrame, name: str) -> DataFrame:
        return self.store.save(rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), name)

    def _compact(self, edges: DataFrame) -> None:
        """Edges follow one another where all that passes their node comes by the one and leaves by the other."""
        into = edges.select("lang", _words_of("phrase", 2, 4).alias("node"), F.col("eid").alias("before"), F.lit(None).cast("long").alias("after"), "n")
        outof = edges.select("lang", _words_of("phrase", 1, 3).alias("node"), F.lit(None).cast("long").alias("before"), F.col("eid").alias("after"), "n")
        ends = into.unionByName(outof).groupBy("lang", "node").agg(
            F.count("before").alias("ins"), F.count("after").alias("outs"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("before").alias("before"), F.max("after").alias("after")
        )
        ends = ends.filter("ins = 1 AND outs = 1 AND low = high AND before <> after")
        counts = self.counts.filter("size = 3").select("lang", F.col("phrase").alias("node"), F.col("n").alias("all"))
        unary = self.store.save(ends.join(counts, ["lang", "node"]).filter("low = all").select("lang", "node", "before", "after"), "unary")
        self.inner = unary.select("lang", F.col("node").alias("phrase"))
        # The edge that a path begins with, by pointer doubling; paths cannot be closed, for a piece enters each of them.
        back = edges.select("eid").join(unary.select(F.col("after").alias("eid"), F.col("before").alias("to")), "eid", "left")
        back = self.store.save(back.select("eid", F.coalesce("to", "eid").alias("to"), F.col("to").isNotNull().cast("long").alias("far")), "back")
        while True:
            ahead = back.select(F.col("eid").alias("to"), F.col("to").alias("__to"), F.col("far").alias("__far"))
            new = with_small(back, ahead, ["to"]).select("eid", F.col("__to").alias("to"), (F.col("far") + F.col("__far")).alias("far"), (F.col("__far") > 0).alias("moved"))
            new = self.store.save(new, "back")
            self.store.drop(back)
            back = new.select("eid", "to", "far")
            if not new.filter("moved").limit(1).count():
                break
        placed = back.join(edges, "eid")
        whole = F.array_sort(F.collect_list(F.struct("far", F.substring_index("phrase", " ", -1).alias("word"))))
        paths = placed.groupBy("to").agg(F.any_value("lang").alias("lang"), F.any_value("n").alias("n"), F.min_by("phrase", "far").alias("first"), whole.alias("rest"))
        rest = F.slice(F.transform("rest", lambda r: r["word"]), 2, F.size("rest"))
        self.paths = paths.select("lang", F.concat_ws(" ", "first", rest).alias("phrase"), F.size("rest").cast("long").alias("edges"), "n")


def _exact(text: str) -> Column:
    """Whole numbers of up to 38 digits."""
    return F.expr(text.replace("[", "CAST(").replace("]", " AS DECIMAL(20, 0))"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER, slots: int = FILTER_SLOTS, label: str = "collocations") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``, the first ``top`` phrases of each language of ``docs(text, lang)``.

    A null language is ``und``. Null and empty texts have no words; a language
    with no phrase of ``least`` occurrences has no rows. Every row counts, also
    equal ones and rows with equal ids. Ties in score and count go by the
    phrase. Other columns are ignored, an empty table gives no rows. ``slots``
    bits, a power of two, tell rare words and pairs from others: fewer let more
    of the text be shuffled and change no result.
    """
    graph = Graph(docs, least, slots, label)
    store = graph.store
    found = graph.counts.filter("size >= 2").join(graph.inner, ["lang", "phrase"], "left_anti")
    found = store.save(found, "candidates")

    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice("ws", i, k), " "))))
    longer = found.filter("size >= 3").withColumn("ws", F.split("phrase", " ")).select("lang", "n", F.explode(parts).alias("phrase"))
    longer = store.save(longer.groupBy("lang", "phrase").agg(F.max("n").alias("most")), "longer")
    kept = with_small(found, longer, ["lang", "phrase"], "left").filter(_exact(f"100 * [coalesce(most, 0)] < {cover} * [n]")).drop("most")

    cuts = F.transform(F.sequence(F.lit(1), F.size("ws") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("ws", 1, k), " ").alias("left"), F.array_join(F.slice("ws", k + 1, 4), " ").alias("right")))
    cut = kept.withColumn("ws", F.split("phrase", " ")).select("lang", "phrase", F.col("n").alias("a"), F.inline(cuts))
    cut = store.save(cut, "cuts")
    known = graph.counts.filter(f"size < {LONGEST}")
    rows = known.count()
    for side, name in (("left", "l"), ("right", "r")):
        cut = with_small(cut, known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side], rows=rows)
        cut = store.save(cut, f"cuts-{side}")
    scored = cut.withColumn("score", _exact("2000000 * [a] div ([l] + [r])").cast("long"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.*")

    # A language's best of each of many buckets first, so that no task sorts a whole language.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(256))
    some = best.withColumn("rank", F.row_number().over(W.partitionBy("lang", bucket).orderBy(*order))).filter(F.col("rank") <= top)
    some = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return with_small(store.save(some, "best"), graph.totals, ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf}/documents.parquet"))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
  g AS (SELECT lang, size, phrase, count(*) AS f FROM (
      SELECT lang, size, unnest([array_to_string(ws[i:i + size - 1], ' ') for i in range(1, CAST(len(ws) - size + 2 AS BIGINT))]) AS phrase FROM w, (VALUES (1), (2), (3), (4)) t(size) WHERE len(ws) >= size)
    GROUP BY ALL HAVING count(*) >= 30),
  t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
  c AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE size > 1),
  s AS (SELECT lang, f, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM c, (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) v(k, i) WHERE k < size AND i <= size - k + 1),
  m AS (SELECT lang, phrase, max(f) AS most FROM s GROUP BY ALL),
  k AS (SELECT lang, phrase, f AS a, unnest(range(1, size)) AS k, ws FROM c LEFT JOIN m USING (lang, phrase) WHERE 100 * coalesce(most, 0) < 80 * f),
  x AS (SELECT k.*, l.f AS l, r.f AS r, (2000000 * a) // (l.f + r.f) AS score FROM k
        JOIN g l ON l.lang = k.lang AND l.phrase = array_to_string(ws[1:k.k], ' ') JOIN g r ON r.lang = k.lang AND r.phrase = array_to_string(ws[k.k + 1:len(ws)], ' ')),
  b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""
