"""Dictionary-compressed web archives.

Every archive is one file that Spark writes: first a skippable frame that holds
the Zstandard dictionary, then the records, each compressed alone as one frame
with that dictionary. Between rows the text writer puts its line separator;
here that is an empty skippable frame, which readers of Zstandard pass over, so
the files are whole archives and any file system that Spark knows can hold
them.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import small_batches, steps, with_small

#: Frame numbers of the format: the dictionary, and a frame to skip (as text, with its length of zero).
DICTIONARY_FRAME = 0x184D2A5D
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
#: The dictionary is built from so many records at most, drawn by the digest of their payload, and is so large at most.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8192, 65_536
#: Payloads from this size on are archived once.
LEAST_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6
#: Payload bytes that one archive holds on average, at most; a file is read back as one value.
ARCHIVE_BYTES = 128 << 20


def build_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples, empty where they are too few or too alike to make one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def record(url: str | None, key: str, digest: str, payload: bytes, kind: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps no payload, only its length and digest."""
    body = b"" if kind == "revisit" else payload
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{key}>", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + " ".join((url or "").split()), f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Bytes: {len(payload)}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def frame_end(data: bytes, at: int) -> int:
    """Where the frame at ``at`` ends, from the sizes in its block headers; nothing is decompressed or copied."""
    import zstandard

    head = data[at : at + 18]
    checked = head[4] & 4
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last = bool(block & 1)
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run of one byte stores that byte
    return at + (4 if checked else 0)


def frames(data: bytes) -> Iterator[bytes]:
    """The records of one archive. The dictionary is the archive's own first frame."""
    import zstandard

    number, length = struct.unpack_from("<II", data)
    if number != DICTIONARY_FRAME:
        raise ValueError("an archive begins with its dictionary")
    dictionary = data[8 : 8 + length]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    at, view = 8 + length, memoryview(data)
    while at < len(data):
        number = struct.unpack_from("<I", data, at)[0]
        if number & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        end = frame_end(data, at)
        yield reader.decompressobj().decompress(view[at:end])
        at = end


def _keyed(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    return pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))


def archive(pages: DataFrame, path: str, archives: int | None = None, label: str = "warc") -> None:
    """Write ``pages(page_id, url, html)`` as ``.warc.zst`` files into the folder ``path``.

    Of records with equal payloads of ``LEAST_BYTES`` or more, the first row
    with the smallest ``page_id`` (null before all) is a response, the others
    revisit it. A null html is an empty payload, a null url an empty one; rows
    with equal page_id and html are further revisits; other columns are
    ignored; an empty table writes archives without records. ``archives``
    is the number of files, by default one for each shuffle partition, more
    where these would hold over ``ARCHIVE_BYTES``.
    """
    spark = pages.sparkSession
    small_batches(spark)
    store = steps(spark, label)
    pages = pages.select("page_id", "url", "html")
    sizes = pages.select("page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"))
    sizes = store.save(sizes, "digests")
    copies = sizes.filter(F.col("bytes") >= LEAST_BYTES).groupBy("digest")
    order = F.struct(F.col("page_id").isNotNull(), "page_id")
    copies = copies.agg(F.count(F.lit(1)).alias("n"), F.min_by("page_id", order).alias("first")).filter("n > 1")
    copies = store.save(copies.select("digest", "first"), "copies")
    # Only small rows meet the digests that repeat; the page joins its own reference by key.
    mine = sizes.filter(F.col("bytes") >= LEAST_BYTES).groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    refs = with_small(mine, copies, ["digest"]).select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "first")
    refs = store.save(refs, "references")
    keyed = _keyed(pages)
    joined = keyed.join(refs, keyed["page_id"].eqNullSafe(refs["__page"]) & (keyed["digest"] == refs["__digest"]), "left")
    joined = joined.select("page_id", "url", "payload", "digest", F.col("__digest").isNotNull().alias("copied"), "first")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    files = archives or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ARCHIVE_BYTES))
    spread = joined.repartition(files, "page_id", "digest").sortWithinPartitions("page_id", "digest")

    threshold = (1 << 32) - 1
    drawn = sizes.filter("bytes > 0").select("digest").distinct()
    cut = min(threshold, int(threshold * 2.0 * SAMPLE_RECORDS / max(1, drawn.count())))
    draw = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    picked = drawn.filter(draw <= cut).orderBy("digest").limit(SAMPLE_RECORDS)
    picked = store.save(picked, "picked")
    samples = _keyed(pages).join(F.broadcast(picked), "digest").groupBy("digest").agg(F.min("payload").alias("payload"))
    samples = [bytes(r["payload"])[:SAMPLE_BYTES] for r in samples.orderBy("digest").select(F.substring("payload", 1, SAMPLE_BYTES).alias("payload")).collect()]
    dictionary = build_dictionary(samples)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if own:
            own.precompute_compress(level=LEVEL)
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=own) if not own else zstandard.ZstdCompressor(dict_data=own)
        yield pa.record_batch([pa.array([dictionary_frame(dictionary)], pa.binary())], names=["frame"])
        last, n = None, 0
        for batch in batches:
            out = []
            for page, url, payload, digest, copied, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = n + 1 if (page, digest) == last else 0
                last = (page, digest)
                revisit = copied and not (page == first and n == 0)
                key = f"{'' if page is None else page}/{n}"
                target = f"{'' if first is None else first}/0" if revisit else None
                out.append(writer.compress(record(url, key, digest, payload, "revisit" if revisit else "response", target)))
            yield pa.record_batch([pa.array(out, pa.binary())], names=["frame"])

    rows = spread.mapInArrow(write, "frame binary").select(F.col("frame").cast("string").alias("value"))
    rows.write.option("lineSep", SEPARATOR).mode("overwrite").text(path)


RECORDS = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, stored_bytes long, payload binary"


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``RECORDS`` of the archives under ``path``; the digest is computed from the payload where it is stored."""
    small = spark.read.format("binaryFile").load(path).select("content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for data in batch.column(0):
                rows: list[tuple] = []
                for one in frames(data.as_py()):
                    fields, body = parse(one)
                    kind = fields["WARC-Type"]
                    name = lambda key: fields[key][len("<urn:page:") : -1].rsplit("/", 1)[0] or None  # noqa: B023, E731
                    stored = kind == "response"
                    digest = hashlib.sha256(body).hexdigest() if stored else fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if stored and digest != fields["WARC-Payload-Digest"].removeprefix("sha256:"):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                    length = len(body) if stored else int(fields["X-Payload-Bytes"])
                    rows.append((name("WARC-Record-ID"), fields["WARC-Target-URI"], length, digest, kind, None if stored else name("WARC-Refers-To"), len(body), body if payloads else None))
                    if len(rows) == 256:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return small.mapInArrow(records, RECORDS)


def query(spark, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    path = steps(spark, "archives").root
    archive(pages, path)
    kind = pages.schema["page_id"].dataType
    out = read(spark, path, payloads=False).drop("payload", "stored_bytes")
    return out.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url")


ORACLE = r"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
  d AS (SELECT page_id, url, octet_length(body) AS n, sha256(body) AS h FROM p),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest, url,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f
"""
