"""WARC archives, compressed record by record with a shared Zstandard dictionary.

An archive (``.warc.zst``) begins with a skippable frame that embeds the dictionary; after it
comes a frame for each record, so that any record can be read alone from its offset with
the archive's own dictionary.  The dictionary is trained on whole records of a bounded sample
(``SAMPLE_RECORDS`` pages of at most ``SAMPLE_BYTES``, those with the smallest hashes); where that is
too little to train on, the sampled records themselves are the dictionary.

Pages with equal payloads (compared by SHA-256 and length) of at least ``least`` bytes are archived
once: the one with the smallest page_id is a ``response`` record with an HTTP message, the
others are ``revisit`` records that refer to it and have the HTTP header only.  Groups larger than a
thousandth of all rows (so fewer than a thousand) reach their pages by a broadcast join, the
others by a shuffle that no group dominates.

Tasks write archives into the shared folder through pyarrow's file systems, under a name of their own for
each attempt, and return a row for each archive.  These rows, written as a table, are the
manifest: readers open what it lists, so that what a lost executor left behind counts for nothing.
Each archive is read back by one task as a stream, frame after frame; every block digest, and
the payload digest of every response, is compared with the bytes, and a difference is an error.

Defined results: null html is an empty payload.  Payloads smaller than ``least`` are all responses.
Rows that share the smallest page_id of their group are all responses.  A null page_id is larger
than any other; pages of a group without any page_id are all responses.  Control characters and
spaces in a url are percent-encoded in the record, and a null or empty url has no target field (a revisit
then none for its target either).  An empty table makes no archive.  Other columns are not read.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .shared import shared_dir, ship, written

#: Of the skippable frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: The sample that the dictionary is trained on.
SAMPLE_RECORDS = 2_000
SAMPLE_BYTES = 16_384
#: An archive is closed when it has so many bytes.
ARCHIVE_BYTES = 256_000_000
#: Groups with a larger share of all rows are joined by broadcast.
HEAVY = 1 / 1000
CHUNK = 1 << 20

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.UUID("6f1c1c2a-5d0b-5b52-9a57-0d9f4f1d5a01")
MANIFEST = "archive string, records bigint, bytes bigint"
RECORDS = (
    "archive string, offset bigint, length bigint, record_type string, record_id string, uri string, page_id bigint, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, refers_to_record string, payload binary")


# -- records ---------------------------------------------------------------------------------------------------------


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id} {digest} {url}')}>"


def clean_uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")


def serialised(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record: version, named fields, block, two line ends."""
    fields = [*fields, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, keep: tuple[int, str | None] | None, date: str) -> bytes:
    """The response record of a page, or its revisit record if ``keep`` names the (page_id, url) of the response."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = clean_uri(url)
    fields = [("WARC-Type", "revisit" if keep else "response"), ("WARC-Record-ID", record_id(page_id, url, digest)),
              ("WARC-Date", date), ("WARC-Target-URI", uri), ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Page-Id", "" if page_id is None else str(page_id))]
    if keep:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(*keep, digest)), ("WARC-Refers-To-Target-URI", clean_uri(keep[1])),
                   ("WARC-Refers-To-Date", date), ("Refers-To-Page-Id", str(keep[0]))]
    return serialised(fields, http if keep else http + payload)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """(fields in lower case, block) of a serialised record; ValueError if it isn't a whole one."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:]))
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    block = rest[:size]
    if fields.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
        raise ValueError("the block differs from its digest")
    return fields, block


def record_row(archive: str, offset: int, length: int, record: bytes) -> tuple | None:
    """What RECORDS has of a page's record; None for others (warcinfo)."""
    fields, block = parsed(record)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:]))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(http["content-length"])
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("the payload differs from its digest or length")
    number = lambda name: int(fields[name]) if name in fields else None
    return (archive, offset, length, kind, fields["warc-record-id"], fields.get("warc-target-uri"), number("page-id"), size, digest,
            number("refers-to-page-id"), fields.get("warc-refers-to"), payload if kind == "response" else None)


# -- archives --------------------------------------------------------------------------------------------------------


def trained(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from whole records; the records themselves where they are too few for training; empty from none."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(total // 8, 256)), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class ArchiveWriter:
    """Writes one archive to a binary stream."""

    def __init__(self, out, dictionary: bytes):
        self.out, self.bytes, self.records = out, 0, 0
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True)
        self._write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.bytes += len(raw)

    def add(self, record: bytes) -> int:
        """Appends a record as a frame of its own; its offset."""
        at = self.bytes
        self._write(self.compressor.compress(record))
        self.records += 1
        return at


def read_frames(source) -> Iterator[tuple[int, int, bytes]]:
    """(offset, compressed length, record) of each record of an archive's stream; memory for one record at a time."""
    head = source.read(8)
    if len(head) < 8 or struct.unpack("<II", head)[0] != SKIPPABLE:
        raise ValueError("the archive has no dictionary frame")
    size = struct.unpack("<II", head)[1]
    dictionary = source.read(size)
    if len(dictionary) != size:
        raise ValueError("the dictionary is cut short")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    offset, data = 8 + size, source.read(CHUNK)
    while data:
        frame, used, out = reader.decompressobj(), 0, []
        while True:
            out.append(frame.decompress(data))
            if frame.eof:
                used += len(data) - len(frame.unused_data)
                data = frame.unused_data
                break
            used += len(data)
            data = source.read(CHUNK)
            if not data:
                raise ValueError(f"the archive ends inside the record at {offset}")
        yield offset, used, b"".join(out)
        offset += used
        data = data or source.read(CHUNK)


def read_at(path: str, offset: int, length: int) -> bytes:
    """One record alone, by the place that ``read_archives`` gives."""
    from pyarrow import fs
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as f:
        size = struct.unpack("<II", f.read_at(8, 0))[1]
        dictionary = f.read_at(size, 8)
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        return zstandard.ZstdDecompressor(dict_data=own).decompressobj().decompress(f.read_at(length, offset))


# -- jobs ------------------------------------------------------------------------------------------------------------


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def marked(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html and, for revisits, keep_id and keep_url: the page of their response."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")).withColumn(
        "size", F.octet_length(_payload())).withColumn("sha", F.when(F.col("size") >= least, F.unhex(F.sha2(_payload(), 256))))
    groups = (rows.filter("sha is not null").groupBy("sha", "size")
              .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("keep"), F.count(F.lit(1)).alias("copies")))
    groups = written(groups.filter("copies > 1 and keep is not null"), "payloads")
    bound = rows.agg(F.count(F.lit(1))).first()[0] * HEAVY
    few = F.broadcast(groups.filter(F.col("copies") > bound).select(F.col("sha").alias("h_sha"), F.col("size").alias("h_size"), F.col("keep").alias("h_keep")))
    rest = groups.filter(F.col("copies") <= bound).select(F.col("sha").alias("r_sha"), F.col("size").alias("r_size"), F.col("keep").alias("r_keep"))
    rows = rows.join(few, (F.col("sha") == F.col("h_sha")) & (F.col("size") == F.col("h_size")), "left")
    # A row whose response is known, or that has none, gets a key of its own, so that such rows spread.
    own = F.unhex(F.sha2(F.concat_ws(" ", F.lit("row"), F.monotonically_increasing_id().cast("string")), 256))
    rows = rows.withColumn("key", F.when(F.col("h_keep").isNull() & F.col("sha").isNotNull(), F.col("sha")).otherwise(own))
    rows = rows.join(rest, (F.col("key") == F.col("r_sha")) & (F.col("size") == F.col("r_size")), "left")
    keep = F.coalesce("h_keep", "r_keep")
    keep = F.when(keep["page_id"].eqNullSafe(F.col("page_id")), None).otherwise(keep)
    return rows.select("page_id", "url", "html", keep.alias("keep")).select(
        "page_id", "url", "html", F.col("keep.page_id").alias("keep_id"), F.col("keep.url").alias("keep_url"))


def sample_records(pages: DataFrame, date: str) -> list[bytes]:
    """Whole records of at most SAMPLE_RECORDS different payloads, those with the smallest hashes.  The hashes are
    cut first, so that no task sends more than them to the driver."""
    rows = (pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), _payload().cast("string").alias("html"))
            .filter(F.octet_length("html") <= SAMPLE_BYTES).withColumn("hash", F.xxhash64("html")))
    last = rows.select("hash").distinct().orderBy("hash").limit(SAMPLE_RECORDS).agg(F.max("hash")).first()[0]
    if last is None:
        return []
    few = rows.filter(F.col("hash") <= last).groupBy("hash").agg(F.min(F.struct("page_id", "url", "html")).alias("page")).orderBy("hash")
    return [page_record(r["page"]["page_id"], r["page"]["url"], r["page"]["html"].encode(), None, date) for r in few.collect()]


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, date: str | None = None,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives ``pages`` (page_id, url, html) below ``folder`` (default: a new one in the shared folder) and
    returns the manifest: archive (its address), records, bytes."""
    spark: SparkSession = pages.sparkSession
    ship(spark)
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = (folder or f"{shared_dir(spark)}/llm-archives-{uuid.uuid4().hex}").rstrip("/")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    shared = spark.sparkContext.broadcast(trained(sample_records(pages, date)))
    arrow = to_arrow_schema(StructType.fromDDL(MANIFEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        writer = out = name = None

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": f"{folder}/{name}", "records": writer.records, "bytes": writer.bytes}], arrow)

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                html = part.column("html").cast(pa.large_binary()).to_pylist()
                for page_id, url, raw, keep_id, keep_url in zip(*(part.column(c).to_pylist() for c in ("page_id", "url")), html,
                                                                *(part.column(c).to_pylist() for c in ("keep_id", "keep_url"))):
                    if writer is None:
                        name = f"pages-{uuid.uuid4().hex}.warc.zst"
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                        writer = ArchiveWriter(out, shared.value)
                        writer.add(serialised([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                               ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    writer.add(page_record(page_id, url, raw or b"", None if keep_id is None else (keep_id, keep_url), date))
                    if writer.bytes >= archive_bytes:
                        yield close()
                        writer = None
        if writer is not None:
            yield close()

    return written(marked(pages, least).mapInArrow(run, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records (RECORDS) of all archives that ``manifest`` lists, each archive streamed by one task."""
    ship(manifest.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(RECORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(archive)
                rows, size = [], 0
                with system.open_input_stream(name, compression=None) as source:
                    for offset, length, record in read_frames(source):
                        try:
                            row = record_row(archive, offset, length, record)
                        except (ValueError, KeyError) as wrong:
                            raise ValueError(f"{archive} at {offset}: {wrong}") from wrong
                        if row is None:
                            continue
                        rows.append(row if payloads else (*row[:-1], None))
                        size += len(record) if payloads else 256
                        if size >= 8 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), arrow)], schema=arrow)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), arrow)], schema=arrow)

    archives = manifest.select("archive")
    return archives.repartition(max(1, archives.count())).mapInArrow(run, RECORDS)


def archived_digests(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives the pages, reads the archives back, and returns for each record: page_id, payload_bytes, payload_digest,
    record_type, refers_to."""
    return read_archives(write_archives(pages, least=least), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
