"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines.

Unit vectors are projected on Gaussian directions, shifted and cut into cells;
several cells make a bucket, and several tables of buckets give a close pair
several chances to meet. Equal vectors are one class from the start. Classes
that share a bucket are compared in blocks of bounded size inside a task, by
their exact cosine; a pair counts in the first table where it meets. What
leaves a task are link counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import components, steps, with_small

#: Tables, projections a table and cell width. Two vectors at cosine 0.98, 0.2 apart, share a cell with probability
#: 0.867, a bucket with 0.867 ** 8 = 0.32 and one of the ten buckets with 0.98; closer pairs do more often.
TABLES, PROJECTIONS, WIDTH = 10, 8, 1.2
LEAST_COSINE = 0.98
#: Rows of a block: a bucket with more is compared block by block.
BLOCK = 1024


def _keyed(rows: DataFrame) -> DataFrame:
    """``(vec_id, space, key, vector)`` of the vectors that can link: a space is a label and a width."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, spaces, keys, vectors = [], [], [], []
            for k, (label, x) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if label is None or x is None or None in x:
                    continue
                v = np.asarray(x, np.float64) + 0.0
                if not np.isfinite(v).all() or not v.any():
                    continue
                space = f"{label}/{len(v)}"
                keep.append(k)
                spaces.append(space)
                keys.append(hashlib.blake2b(space.encode() + b"\0" + v.tobytes(), digest_size=16).digest())
                vectors.append(x)
            yield pa.record_batch([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(spaces, pa.string()), pa.array(keys, pa.binary()), pa.array(vectors, batch.schema.field(2).type)], names=["vec_id", "space", "key", "vector"])

    kind, vector = rows.schema["vec_id"].dataType.simpleString(), rows.schema["embedding"].dataType.simpleString()
    return rows.select("vec_id", "label", "embedding").mapInArrow(key, f"vec_id {kind}, space string, key binary, vector {vector}")


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled first so that huge and tiny components neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _coded(classes: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """``classes`` with ``codes``: the bucket of each table."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    names = classes.columns
    at, space_at = names.index("vector"), names.index("space")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            vectors, spaces = batch.column(at).to_pylist(), batch.column(space_at).to_pylist()
            out = np.zeros((len(vectors), tables), np.int64)
            by_width: dict[int, list[int]] = {}
            for k, v in enumerate(vectors):
                by_width.setdefault(len(v), []).append(k)
            for dim, places in by_width.items():
                if dim not in known:
                    draw = np.random.default_rng([seed, dim])
                    known[dim] = (draw.standard_normal((dim, tables * projections)), draw.uniform(0, width, tables * projections))
                directions, shift = known[dim]
                cells = np.floor((_unit(np.asarray([vectors[k] for k in places], np.float64)) @ directions + shift) / width).astype(np.int64)
                cells = cells.reshape(len(places), tables, projections)
                for i, k in enumerate(places):
                    for t in range(tables):
                        name = spaces[k].encode() + t.to_bytes(2, "little") + cells[i, t].tobytes()
                        out[k, t] = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little", signed=True)
            codes = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, tables), pa.int32()), pa.array(out.ravel()))
            yield pa.record_batch([*batch.columns, codes], names=[*names, "codes"])

    return classes.mapInArrow(code, f"{schema}, codes array<long>")


def _compare(vectors: np.ndarray, codes: np.ndarray, table: int, n: np.ndarray, half: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row weighted by ``n``, and the smallest row of its component; ``half`` parts two blocks, of which only mixed pairs count."""
    unit = _unit(vectors)
    linked = unit @ unit.T >= least
    np.fill_diagonal(linked, False)
    if half is not None:
        linked &= half[:, None] != half[None, :]
    for earlier in range(table):
        linked &= codes[:, None, earlier] != codes[None, :, earlier]
    counts = linked @ n.astype(np.float64)
    label = np.arange(len(n))
    while linked.any():
        low = np.minimum(label, np.where(linked, label[None, :], len(n)).min(axis=1))
        low = low[low]
        if (low == label).all():
            break
        label = low
    return counts.astype(np.int64), label


def _links(groups: DataFrame, least: float) -> DataFrame:
    """``(cid, links, root)`` from rows of ``(code, tbl, i, j, block, cid, n, vector, codes)``, sorted so that a group stands together."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish(rows: pa.Table) -> pa.RecordBatch | None:
            if rows.num_rows < 2:
                return None
            i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
            cid, n = rows.column("cid").to_numpy(), rows.column("n").to_numpy()
            order = np.argsort(cid, kind="stable")
            vectors = np.asarray(rows.column("vector").to_pylist(), np.float64)[order]
            codes = np.asarray(rows.column("codes").to_pylist(), np.int64)[order]
            half = rows.column("block").to_numpy()[order] if i != j else None
            counts, label = _compare(vectors, codes, rows.column("tbl")[0].as_py(), n[order], half, least)
            some = counts > 0
            if not some.any():
                return None
            cid = cid[order]
            return pa.record_batch([pa.array(cid[some]), pa.array(counts[some]), pa.array(cid[label][some])], names=["cid", "links", "root"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("code", "tbl", "i", "j")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            starts = [0, *edges.tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                key = tuple(keys[:, a].tolist())
                if key != last and held:
                    out = finish(pa.Table.from_batches(held))
                    held = []
                    if out is not None:
                        yield out
                last = key
                held.append(batch.slice(a, b - a))
        if held:
            out = finish(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return groups.mapInArrow(compare, "cid long, links long, root long")


def near_duplicates(
    rows: DataFrame, least: float = LEAST_COSINE, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, block: int = BLOCK, seed: int = 5, label: str = "near"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``rows(vec_id, embedding, label)``.

    Only vectors of one label and width meet. Null labels, vectors that are
    null, zero or hold null or non-finite components link with nothing and are
    kept. Rows with equal ids are separate vectors. Links found have a cosine
    of ``least`` or more; which of them are found is a matter of chance fixed
    by ``seed``. Other columns are ignored, an empty table gives no rows.
    """
    store = steps(rows.sparkSession, label)
    keyed = _keyed(rows)
    classes = keyed.groupBy("key", "space").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"), F.any_value("vector").alias("vector"))
    classes = store.save(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = store.save(keyed.select("vec_id", "key"), "members")
    coded = store.save(_coded(classes.select("cid", "space", "n", "vector"), tables, projections, width, seed), "coded")

    met = coded.select("cid", F.posexplode("codes").alias("tbl", "code"))
    buckets = met.groupBy("tbl", "code").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = store.save(buckets, "buckets")
    parts = F.ceil(F.col("size") / block).cast("int")
    placed = with_small(met, buckets, ["tbl", "code"]).select("cid", "tbl", "code", parts.alias("parts"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    # A block meets itself and every other block once; one block of a bucket of one goes out once.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = placed.withColumn("other", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    shipped = placed.select("cid", "tbl", "code", "block", "i", "j").join(coded.select("cid", "n", "vector", "codes"), "cid")
    groups = shipped.repartition("code", "tbl", "i", "j").sortWithinPartitions("code", "tbl", "i", "j")
    found = store.save(_links(groups.select("code", "tbl", "i", "j", "block", "cid", "n", "vector", "codes"), least), "links")

    reach = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), store)
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select("cid", "key", "n", "first").join(sums, "cid", "left").join(reach.withColumnRenamed("id", "cid"), "cid", "left")
    known = store.save(known.withColumn("component", F.coalesce("component", "cid")), "known")
    least_ids = store.save(known.groupBy("component").agg(F.min("first").alias("component_id")), "components")
    told = with_small(known, least_ids, ["component"]).select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    told = store.save(told, "told")
    linked = with_small(members, told, ["key"]).select("vec_id", "n_links", "component_id")
    # Rows that cannot link have no key; they are told apart by the same rule as in _keyed.
    alone = rows.select("vec_id", "label", "embedding").filter(~_can_link())
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _can_link():
    x = F.col("embedding")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(x, lambda c: c.isNotNull() & (c != 0))
    return F.col("label").isNotNull() & x.isNotNull() & F.coalesce(sound, F.lit(False))


def query(spark, sf: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"))
    return out.select("vec_id", "n_links", F.col("component_id").cast("long").alias("component_id"), "kept")


#: Every pair of a label; the same rows where hashing finds every link.
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, [CAST(c AS DOUBLE) for c in embedding] AS x FROM embeddings
    WHERE label IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0 AND len([c for c in embedding if c <> 0]) > 0),
  e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
  n AS (SELECT a, count(*) AS n FROM e GROUP BY a),
  r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
  c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, CAST(c AS BIGINT) AS component_id, vec_id = c AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
