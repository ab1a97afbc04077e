"""WARC archives compressed record by record with a Zstandard dictionary that each archive carries itself.

An archive is a run of Zstandard frames: first a skippable frame (magic 0x184D2A5D) with the dictionary, itself compressed, then
one frame per record. The dictionary is trained by one task on pieces of a bounded sample of the records to be archived, so
that headers and page boilerplate, which a record alone could not repeat, cost a few bytes.

Of the records with one payload, told by SHA-256, that of the smallest page_id is a ``response`` and the others are ``revisit``
records without payload. Finding it shuffles a digest and an id per different payload and task. Payloads that make up over a
thousandth of all rows, fewer than a thousand, reach every task as ids; their copies give up the payload before any shuffle
and are dealt evenly. The rest meets its first page by a join.

Spark's text writer commits the files, so that they may lie in any store Spark writes to and a lost task leaves nothing behind.
It puts a separator behind each row; the separator is an empty skippable frame, which every Zstandard reader passes over. A
row is a pack of frames, and an archive holds a bounded number of packs. Reading goes by Spark's binary files, one at a time.

Defined results. Null html is an empty payload. A null page_id is never the smallest and stays null; where a payload has only
such rows, all are responses. Rows that share the smallest page_id of their payload are all responses. A null url has no
target header; control and other characters that a header cannot hold are percent-encoded. An empty table gives no records.
Where nothing can be sampled, or too little to train on, the dictionary is what was sampled, or absent. Columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import release
from tessera.sources.workspace import materialize, new_path

#: Records in the sample, bytes of a piece, pieces to train on, bytes of the dictionary.
SAMPLE_RECORDS, PIECE, PIECES, DICTIONARY_BYTES = 1500, 8192, 2048, 1 << 16
LEVEL = 3
#: Bytes of frames in a pack (a longer frame is a pack of its own) and packs in an archive.
PACK_BYTES, PACKS = 512 << 10, 64
#: Payloads with a larger part of all rows than one in so many are hot.
HOT_PART = 1000
#: The frame that holds a dictionary, the frames that readers skip, and an empty one of these in ASCII.
DICTIONARY_MAGIC, SKIPPABLE, SKIPPABLE_MASK = 0x184D2A5D, 0x184D2A50, 0xFFFFFFF0
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
IDS = uuid.uuid5(uuid.NAMESPACE_URL, "tessera-page")

Batches = Iterator[pa.RecordBatch]


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(IDS, f'{page_id} {digest}')}>"


def fields(pairs: list[tuple[str, object]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value is not None).encode()


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, first: int | None, date: str) -> bytes:
    """A response, or without a payload a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = payload is None
    block = http if revisit else http + payload
    head = fields(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Profile", PROFILE if revisit else None),
            ("WARC-Refers-To", record_id(first, digest) if revisit else None),
            ("X-Page-ID", page_id),
            ("X-Refers-To-Page-ID", first if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def information(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n"
    ident = f"<urn:uuid:{uuid.uuid5(IDS, 'info ' + date)}>"
    head = fields([("WARC-Type", "warcinfo"), ("WARC-Record-ID", ident), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def records_of(batch: pa.RecordBatch, date: str) -> Iterator[bytes]:
    for row in range(batch.num_rows):
        page_id, url, payload, size, sha1, first = (batch.column(name)[row].as_py() for name in ("page_id", "url", "payload", "size", "sha1", "first"))
        yield record(page_id, url, payload, size, base64.b32encode(bytes.fromhex(sha1)).decode(), first, date)


def pieces_of(date: str) -> Callable[[Batches], Batches]:
    """``place, piece``: the sampled records cut up, in an order of chance that is the same in every run."""

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            for whole in records_of(batch, date):
                pieces = [whole[at : at + PIECE] for at in range(0, len(whole), PIECE)]
                places = [hashlib.md5(piece).digest() for piece in pieces]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.binary()), pa.array(pieces, pa.binary())], names=["place", "piece"])

    return cut


def trained(batches: Batches) -> Batches:
    samples = [piece for batch in batches for piece in batch.column("piece").to_pylist()]
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too small: what they hold is the dictionary
        dictionary = b"".join(samples)[:DICTIONARY_BYTES]
    yield pa.RecordBatch.from_arrays([pa.array([dictionary], pa.binary())], names=["dictionary"])


def dictionary_for(rows: DataFrame, total: int, date: str) -> bytes:
    """A dictionary from at most ``PIECES`` pieces of about ``SAMPLE_RECORDS`` different records."""
    every = max(1, total // SAMPLE_RECORDS)
    picked = rows.filter(F.pmod(F.xxhash64("page_id", "url", "payload"), F.lit(every)) == 0).dropDuplicates(["sha256"])
    sample = picked.withColumn("first", F.lit(None).cast("long")).mapInArrow(pieces_of(date), "place binary, piece binary")
    found = sample.orderBy("place").limit(PIECES).coalesce(1).mapInArrow(trained, "dictionary binary").collect()
    return bytes(found[0]["dictionary"]) if found else b""


def dictionary_frame(dictionary: bytes) -> bytes:
    if not dictionary:
        return b""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body


def packed(dictionary: bytes, date: str) -> Callable[[Batches], Batches]:
    """Rows of whole frames. Row 0 of every ``PACKS + 1`` opens an archive with the dictionary."""
    opening = dictionary_frame(dictionary)

    def pack(batches: Batches) -> Batches:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data is not None:
            data.precompute_compress(level=LEVEL)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True, write_content_size=True).compress
        written = 0

        def row(frames: list[bytes]) -> Batches:
            nonlocal written
            if written % PACKS == 0:
                yield pa.RecordBatch.from_arrays([pa.array([opening + squeeze(information(date))], pa.binary())], names=["value"])
            written += 1
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["value"])

        frames, size = [], 0
        for batch in batches:
            for whole in records_of(batch, date):
                frame = squeeze(whole)
                if frames and size + len(frame) > PACK_BYTES:
                    yield from row(frames)
                    frames, size = [], 0
                frames.append(frame)
                size += len(frame)
        if frames:
            yield from row(frames)
        release()

    return pack


def page_rows(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "sha256": F.sha2("payload", 256)})


def with_first(rows: DataFrame, total: int) -> DataFrame:
    """``first``: the page that a row revisits, else null; a revisit has no payload."""
    copies = rows.groupBy("sha256").agg(F.min("page_id").alias("smallest"), F.count("*").alias("copies")).filter("copies > 1 AND smallest IS NOT NULL")
    copies = materialize(copies, "copies")
    is_hot = F.col("copies") * HOT_PART > total
    hot = copies.filter(is_hot).select("sha256", F.col("smallest").alias("hot"))
    known = rows.join(F.broadcast(hot), "sha256", "left")
    dealt = F.when(F.col("hot").isNull(), F.col("sha256")).otherwise(F.xxhash64("page_id", "url").cast("string"))
    known = known.withColumn("dealt", dealt).withColumn("payload", F.when(F.col("hot").isNull() | F.col("page_id").eqNullSafe(F.col("hot")), F.col("payload")))
    rest = copies.filter(~is_hot).select(F.col("sha256").alias("dealt"), "smallest")
    smallest = F.coalesce("hot", "smallest")
    revisits = smallest.isNotNull() & ~F.col("page_id").eqNullSafe(smallest)
    return known.join(rest, "dealt", "left").select(
        "page_id", "url", F.when(~revisits, F.col("payload")).alias("payload"), "size", "sha1", F.when(revisits, smallest).alias("first")
    )


def write_archives(pages: DataFrame, folder: str, date: str = DATE, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write a record per page below ``folder``; gives the folder."""
    total = pages.count()
    rows = page_rows(pages, page_id, url, html)
    dictionary = dictionary_for(rows, total, date)
    archives = with_first(rows, total).mapInArrow(packed(dictionary, date), "value binary")
    # The text writer writes the bytes as they are.
    archives.select(F.col("value").cast("string")).write.options(lineSep=SEPARATOR, maxRecordsPerFile=PACKS + 1, compression="none").text(folder)
    return folder


@dataclass(frozen=True)
class Frame:
    """Where a compressed record lies in an archive, and its bytes."""

    offset: int
    length: int
    record: bytes


#: Bytes that the decoder gets at a time.
FED = 16 << 10


def frames(archive: bytes) -> Iterator[Frame]:
    """The records of an archive; its own dictionary decodes them."""
    view, at = memoryview(archive), 0
    decoder = zstandard.ZstdDecompressor()
    while at + 8 <= len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & SKIPPABLE_MASK == SKIPPABLE:
            if magic == DICTIONARY_MAGIC and at == 0:
                body = zstandard.ZstdDecompressor().decompress(view[8 : 8 + size])
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
            continue
        one, parts, fed = decoder.decompressobj(), [], at
        while not one.eof:
            if fed >= len(view):
                raise ValueError(f"the archive ends within the frame at {at}")
            parts.append(one.decompress(view[fed : fed + FED]))
            fed = min(fed + FED, len(view))
        end = fed - len(one.unused_data)
        yield Frame(at, end - at, b"".join(parts))
        at = end


def headers(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    named = dict(line.split(": ", 1) for line in lines)
    return named, block[: int(named["Content-Length"])]


RECORDS = pa.schema(
    [
        ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
        ("target_uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to", pa.int64()), ("refers_to_record", pa.string()), ("payload", pa.binary()),
    ]
)
RECORDS_DDL = (
    "archive string, offset long, length long, record_type string, record_id string, target_uri string, page_id long,"
    " payload_bytes long, payload_digest string, refers_to long, refers_to_record string, payload binary"
)


def parsed(archive: str, frame: Frame) -> dict | None:
    """A row for a page's record; a payload that does not fit its digest is an error."""
    named, block = headers(frame.record)
    if named["WARC-Type"] == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = named["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{archive}: the payload at {frame.offset} does not fit its digest")

    def number(name: str) -> int | None:
        return int(named[name]) if name in named else None

    return {
        "archive": archive, "offset": frame.offset, "length": frame.length, "record_type": named["WARC-Type"], "record_id": named["WARC-Record-ID"],
        "target_uri": named.get("WARC-Target-URI"), "page_id": number("X-Page-ID"), "payload_bytes": size, "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page-ID"), "refers_to_record": named.get("WARC-Refers-To"), "payload": None if revisit else payload,
    }


def archive_rows(with_payload: bool) -> Callable[[Batches], Batches]:
    def read(batches: Batches) -> Batches:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                for frame in frames(content.as_buffer()):
                    row = parsed(name.as_py(), frame)
                    if row is None:
                        continue
                    size += len(row["payload"] or b"") if with_payload else 0
                    rows.append(row if with_payload else row | {"payload": None})
                    if len(rows) >= 4096 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORDS)

    return read


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per page's record with its place: archive, offset and length allow reading it alone."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(archive_rows(with_payload), RECORDS_DDL)


def restored(records: DataFrame) -> DataFrame:
    """``page_id, payload`` of every record, revisits with the payload of the response they refer to."""
    whole = records.filter("record_type = 'response'").select(F.col("record_id").alias("whole"), F.col("payload").alias("other")).dropDuplicates(["whole"])
    found = records.join(whole, F.col("refers_to_record") == F.col("whole"), "left")
    return found.select("page_id", F.coalesce("payload", "other").alias("payload"))


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives below the shared folder and return what they say of each page."""
    folder = write_archives(pages, new_path(pages.sparkSession, "archives"), page_id=page_id, url=url, html=html)
    records = read_archives(pages.sparkSession, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS smallest FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN smallest IS NULL OR page_id IS NOT DISTINCT FROM smallest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN smallest IS NOT NULL AND page_id IS DISTINCT FROM smallest THEN smallest END AS refers_to
FROM firsts
"""
