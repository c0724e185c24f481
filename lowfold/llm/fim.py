"""Fill-in-middle transformation by secondary sort.

A text is cut into units, a word with the white space before it or white space
at the end, and the units into prefix, middle and suffix. They leave the first
task as pieces of whole units keyed by document and place in the output; a
part's first piece carries the part's marker. Repartitioning by document and
sorting within the partitions brings them together in that order, so a document
is only streamed through an incremental digest and never held whole. The same
stream reads the markers, and with them every piece's place in the source:
sorting again, in the same partitions and without another shuffle, restores the
text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import small_batches

#: Bytes of one piece, at most, and of one Arrow batch that a task gives out, about.
PIECE_BYTES, BATCH_BYTES = 1 << 15, 1 << 22
SEED = 42
#: Documents in a hundred that are transformed; of these, in a hundred, those with the suffix first.
CHANGED, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARKER = re.compile(rb"<[PSM]>")
#: Where the parts stand in the source, and in the output of each form.
SOURCE_ORDER = (PREFIX, MIDDLE, SUFFIX)
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Pieces of one part, at most: 32 TB of text.
PART_PLACES = 1 << 30


def unit_ends(data: bytes) -> np.ndarray:
    """The byte after each unit of a UTF-8 text."""
    codes = np.frombuffer(data, np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    return np.append(ends, len(codes)) if len(codes) and space[-1] else ends


def choose(doc_id, n: int, data: bytes, seed: int = SEED) -> tuple[str, int, int]:
    """Form of a document of ``n`` units, and the units after which its prefix and its middle end."""
    name = "" if doc_id is None else str(doc_id)
    drawn = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[k : k + 8], 16) for k in range(0, 32, 8))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not data or h3 % 100 >= CHANGED or _MARKER.search(data):
        return "plain", low, high
    return "spm" if h4 % 100 < SUFFIX_FIRST else "psm", low, high


def _cut(data: bytes, ends: np.ndarray, low: int, high: int, limit: int) -> Iterator[bytes]:
    """``data[low:high]`` in pieces of at most ``limit`` bytes, which end with a unit or, where that is longer, with a code point."""
    while high - low > limit:
        k = int(np.searchsorted(ends, low + limit, "right")) - 1
        stop = int(ends[k]) if k >= 0 else 0
        if stop <= low:
            stop = low + limit
            while data[stop] & 0xC0 == 0x80:
                stop -= 1
        yield data[low:stop]
        low = stop
    yield data[low:high]


class _Rows:
    """Collects rows and gives them out as Arrow batches of bounded size."""

    def __init__(self, kinds: dict[str, pa.DataType]):
        self.kinds, self.rows, self.bytes = kinds, [], 0

    def add(self, *row, weight: int = 100) -> bool:
        """True where a batch is full."""
        self.rows.append(row)
        self.bytes += weight
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.kinds]
        out = pa.record_batch([pa.array(c, k) for c, k in zip(columns, self.kinds.values(), strict=True)], names=list(self.kinds))
        self.rows, self.bytes = [], 0
        return out


_KEY = ["doc_id", "mark", "part"]
_TOLD = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
_TOLD_SQL = "n long, form string, prefix_chars long, middle_chars long"


def _key_kinds(schema: pa.Schema) -> dict[str, pa.DataType]:
    return {"doc_id": schema.field("doc_id").type, "mark": pa.binary(), "part": pa.int32()}


def pieces(docs: DataFrame, seed: int = SEED, limit: int = PIECE_BYTES) -> DataFrame:
    """``(doc_id, mark, part, place, body, n, form, prefix_chars, middle_chars)`` of ``docs(doc_id, text)``, in any order.

    ``body`` is a piece of the output and ``place`` its place there; the first
    piece tells the rest. ``mark``, a digest of the text, and ``part``, the
    partition that it was read from, tell documents with equal ids apart.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            out = out or _Rows(_key_kinds(batch.schema) | {"place": pa.int64(), "body": pa.binary()} | _TOLD)
            for doc_id, part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = data or b""
                ends = unit_ends(data)
                n = len(ends)
                form, low, high = choose(doc_id, n, data, seed)
                at = [0, *(int(ends[k - 1]) if k else 0 for k in (low, high)), len(data)]
                told = (n, form, None, None)
                if form == "plain":
                    parts = [(b"", 0, len(data))]
                else:
                    starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
                    told = (n, form, *(int(np.count_nonzero(starts[at[k] : at[k + 1]])) for k in (0, 1)))
                    where = {marker: (at[k], at[k + 1]) for k, marker in enumerate(SOURCE_ORDER)}
                    parts = [(marker, *where[marker]) for marker in FORMS[form]]
                mark, place = hashlib.blake2b(data, digest_size=16).digest(), 0
                for marker, first, last in parts:
                    for k, body in enumerate(_cut(data, ends, first, last, limit)):
                        body = body if k else marker + body
                        if out.add(doc_id, mark, part, place, body, *(told if place == 0 else (None,) * 4), weight=len(body) + 100):
                            yield out.batch()
                        place += 1
        if out:
            yield out.batch()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.spark_partition_id().alias("part"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, f"doc_id {kind}, mark binary, part int, place long, body binary, {_TOLD_SQL}")


def in_order(rows: DataFrame, shuffled: bool = True) -> DataFrame:
    """Pieces of one document together and by place; ``shuffled`` is false where they already share a partition."""
    return (rows.repartition(*_KEY) if shuffled else rows).sortWithinPartitions(*_KEY, "place")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Schema, tuple, Iterator[tuple]]]:
    """Schema, key and rows, from ``place`` on, of each document of a sorted stream."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            schema = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield schema, row

    for key, group in groupby(rows(), lambda r: r[1][:3]):
        first = next(group)
        yield first[0], key, (r for part in ((first,), group) for _, r in part)


def _told_and_bodies(rows: Iterator[tuple]) -> tuple[list, Iterator[bytes]]:
    """What the first piece tells, and the bodies. Equal rows of a table send equal pieces: one of each is read, their number is ``told[4]`` in the end."""
    first = next(rows)
    told = [*first[5:9], 1]

    def bodies() -> Iterator[bytes]:
        yield first[4]
        last = first[3]
        for row in rows:
            if row[3] == last:
                told[4] += last == first[3]
                continue
            last = row[3]
            yield row[4]

    return told, bodies()


def _sections(form: str, bodies: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """Place in the source and text of each piece of an output; ``form`` says which markers to expect."""
    if form == "plain":
        yield from enumerate(bodies)
        return
    expected, part, k = list(FORMS[form]), 0, 0
    for body in bodies:
        if expected and body.startswith(expected[0]):
            marker = expected.pop(0)
            part, k, body = SOURCE_ORDER.index(marker), 0, body[len(marker) :]
        yield part * PART_PLACES + k, body
        k += 1


def digests(docs: DataFrame, seed: int = SEED, limit: int = PIECE_BYTES) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``, one row for each row of ``docs(doc_id, text)``.

    Null and empty texts have no units, are plain and digest as empty. A null
    id draws as an empty one. Rows with equal ids are separate documents, with
    the same draws; rows equal in both id and text give equal rows. Units of
    any length are cut further. Other columns are ignored, an empty table gives
    no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest each output and send its pieces back to their places in the source, before them a row that tells the rest."""
        out = None
        for schema, key, rows in _documents(batches):
            out = out or _Rows(_key_kinds(schema) | {"place": pa.int64(), "body": pa.binary()} | _TOLD | {"copies": pa.int64()})
            told, bodies = _told_and_bodies(rows)
            digest = hashlib.sha256()

            def read(bodies=bodies, digest=digest) -> Iterator[bytes]:
                for body in bodies:
                    digest.update(body)
                    yield body

            for place, body in _sections(told[1], read()):
                if out.add(*key, place, body, *(None,) * 5, weight=len(body) + 100):
                    yield out.batch()
            out.add(*key, -1, digest.digest(), *told)
        if out:
            yield out.batch()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for schema, key, rows in _documents(batches):
            out = out or _Rows({"doc_id": schema.field("doc_id").type} | _TOLD | {"output_sha256": pa.string(), "restored_sha256": pa.string()})
            head = next(rows)
            digest = hashlib.sha256()
            for row in rows:
                digest.update(row[4])
            for _ in range(head[9]):
                if out.add(key[0], *head[5:9], head[4].hex(), digest.hexdigest(), weight=300):
                    yield out.batch()
        if out:
            yield out.batch()

    turned = in_order(pieces(docs, seed, limit)).mapInArrow(turn, f"doc_id {kind}, mark binary, part int, place long, body binary, {_TOLD_SQL}, copies long")
    return in_order(turned, shuffled=False).mapInArrow(finish, f"doc_id {kind}, {_TOLD_SQL}, output_sha256 string, restored_sha256 string")


def _texts(schema_of: str, write: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for schema, key, rows in _documents(batches):
            out = out or _Rows({"doc_id": schema.field("doc_id").type} | _TOLD | {schema_of: pa.string()})
            told, bodies = _told_and_bodies(rows)
            text = write(told, bodies)
            for _ in range(told[4]):
                if out.add(key[0], *told[:4], text, weight=len(text) + 100):
                    yield out.batch()
        if out:
            yield out.batch()

    return run


def transformed(docs: DataFrame, seed: int = SEED, limit: int = PIECE_BYTES) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``: the texts to train on. Odd rows as in ``digests``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    write = _texts("output", lambda told, bodies: b"".join(bodies).decode("utf-8", "replace"))
    return in_order(pieces(docs, seed, limit)).mapInArrow(write, f"doc_id {kind}, {_TOLD_SQL}, output string")


def restore(output: str, form: str) -> str:
    """The source of one output text."""
    if form == "plain":
        return output
    markers = [m.decode() for m in FORMS[form]]
    texts, rest = {}, output
    for marker, following in zip(markers, [*markers[1:], None], strict=True):
        rest = rest[len(marker) :]
        texts[marker], rest = (rest, "") if following is None else (rest[: rest.index(following)], rest[rest.index(following) :])
    return "".join(texts[m.decode()] for m in SOURCE_ORDER)


def query(spark, sf: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf}/documents.parquet"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
             regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us FROM documents),
  k AS (SELECT *, CAST(len(us) AS BIGINT) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in range(0, 4)] AS hs FROM d),
  c AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
          CASE WHEN n = 0 OR hs[3] % 100 >= 50 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
            WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
  p AS (SELECT *, coalesce(array_to_string(us[1:a], ''), '') AS p, coalesce(array_to_string(us[a + 1:b], ''), '') AS m,
          coalesce(array_to_string(us[b + 1:n], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
