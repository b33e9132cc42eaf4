"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames followed by a seek table in a skippable frame
(for each frame its compressed size, decompressed size and checksum), so that a reader finds
any frame from the end of the file and decompresses nothing else.  Records are grouped into
frames of about FRAME_BYTES; the index maps a record id to (bundle, frame, offset in the
frame, length).

Writing: payload digests are computed by column expressions; of equal payloads (digest, length
and a second hash agree) of at least REVISIT_BYTES the one with the largest id becomes a
response, the others revisit it.  A task writes its rows into bundles of about BUNDLE_BYTES under a
temporary name and renames each when it is complete; only bundles that a successful task
reports are in the index, so a lost executor or a repeated attempt leaves at most a file that
nothing names.  Every payload is written into the shared folder through the file system of its
URI.

Reading back uses the bundles alone: the seek table, then frame by frame, each record parsed
and its payload verified against its digest.

Defined results: NULL payload counts as empty; NULL urls are written as an empty target; a row
with a NULL id gets a record of its own and comes back with a NULL id; repeated rows give a
record each (all of them responses if theirs is the largest id of the payload); an empty table
gives no bundle and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.materialize import materialize
from tallyspark.session import scratch_root

FRAME_BYTES = 1 << 18        # uncompressed bytes of records in a frame
BUNDLE_BYTES = 1 << 26       # uncompressed bytes of records in a bundle
REVISIT_BYTES = 1000
LEVEL = 3
RECORD_DATE = datetime(2024, 1, 1, tzinfo=UTC)     # one date for all, so that runs agree

# Fixed values of the formats
WARC_VERSION = "WARC/1.1"
CRLF = b"\r\n"
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ---------------------------------------------------------------------------------

def record_uri(record_id: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record_id)}>"


def to_base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def to_hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


def record_bytes(record_id: str, page_id: int | None, url: str | None, payload: bytes,
                 digest: str, refers_to: int | None, refers_record: str | None) -> bytes:
    """One record.  A revisit has no payload of its own: it names the record that has it."""
    revisit = refers_record is not None
    block = b"" if revisit else payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [WARC_VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_uri(record_id)}",
            f"WARC-Date: {RECORD_DATE.strftime('%Y-%m-%dT%H:%M:%SZ')}",
            f"WARC-Target-URI: {target}", "Content-Type: text/html; charset=utf-8",
            f"WARC-Payload-Digest: {to_base32(digest)}",
            f"X-Page-ID: {'' if page_id is None else page_id}",
            f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_uri(refers_record)}", f"X-Refers-To-Page: {refers_to}",
                 f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return CRLF.join([*(h.encode() for h in head), b"", block]) + CRLF + CRLF


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a decompressed frame."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        first, *lines = data[at:end].split(CRLF)
        if first.decode() != WARC_VERSION:
            raise ValueError(f"no record at {at}: {first[:40]!r}")
        head = dict(line.decode().split(": ", 1) if b": " in line else (line.decode().rstrip(":"), "")
                    for line in lines)
        start = end + 4
        stop = start + int(head["Content-Length"])
        if data[stop:stop + 4] != CRLF + CRLF:
            raise ValueError(f"record at {at} isn't closed")
        yield head, data[start:stop]
        at = stop + 4


# --- seekable bundles ------------------------------------------------------------------------

def checksum(data: bytes) -> int:
    """The seekable format's: the low 32 bits of XXH64 over the decompressed frame."""
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class BundleWriter:
    """Frames, then the seek table.  ``add`` gives the record's (frame, offset)."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.pending, self.size, self.frames, self.total = [], 0, [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        place = len(self.frames), self.size
        self.pending.append(record)
        self.size += len(record)
        self.total += len(record)
        return place

    def flush(self) -> None:
        if self.size:
            data = b"".join(self.pending)
            frame = self.compressor.compress(data)
            self.out.write(frame)
            self.frames.append((len(frame), len(data), checksum(data)))
            self.pending, self.size = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)))
        self.out.write(entries + footer)


class BundleReader:
    """Random access to the frames of an open, seekable file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_TABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the bundle")
        source.seek(size - 9 - 12 * n)
        table = source.read(12 * n)
        self.frames, at = [], 0
        for packed, plain, expected in struct.iter_unpack("<III", table):
            self.frames.append((at, packed, plain, expected))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain, expected = self.frames[i]
        self.source.seek(at)
        data = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)
        if checksum(data) != expected:
            raise ValueError(f"frame {i} is damaged")
        return data

    def record(self, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return next(parse_records(self.frame(frame)[offset:offset + length]))


def file_system(uri: str):
    """(file system, path) of a URI or a plain absolute path."""
    from pyarrow import fs
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


# --- jobs ------------------------------------------------------------------------------------

def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The rows to write: record (a unique id), id, url, payload, digest, refers_to, refers_record."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        payload.alias("payload"))
    keys = rows.select("id", F.sha1("payload").alias("digest"),
                       F.octet_length("payload").alias("size"), F.xxhash64("payload").alias("proof"))
    groups = (keys.filter(F.col("size") >= min_bytes).groupBy("digest", "size", "proof")
              .agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select(F.col("digest").alias("g_digest"), F.col("size").alias("g_size"),
                      F.col("proof").alias("g_proof"), "best"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "proof": F.xxhash64("payload"),
                             "size": F.octet_length("payload")})
    joined = rows.join(groups, (rows["digest"] == groups["g_digest"])
                       & (rows["size"] == groups["g_size"]) & (rows["proof"] == groups["g_proof"]), "left")
    other = F.col("best").isNotNull() & ~F.col("id").eqNullSafe(F.col("best"))
    return joined.select("id", "url", "payload", "digest",
                         F.when(other, F.col("best")).alias("refers_to"))


INDEX_SCHEMA = ("bundle string, record string, page_id long, frame long, offset long, length long")


def write_bundles(rows: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the planned rows; the index, one row per record, is written beside the bundles."""
    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        seen_response: set = set()
        name = out = writer = None
        rows_of: list[tuple] = []

        def closed() -> pa.RecordBatch:
            writer.close()
            out.close()
            store.move(f"{root}/{name}.part", f"{root}/{name}")
            cols = list(zip(*rows_of))
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              ["bundle", "record", "page_id", "frame", "offset", "length"])

        for b in batches:
            for i in range(b.num_rows):
                page, url, payload, digest, refers = (b.column(c)[i].as_py() for c in (
                    "id", "url", "payload", "digest", "refers_to"))
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = store.open_output_stream(f"{root}/{name}.part")
                    writer, rows_of = BundleWriter(out, frame_bytes), []
                record = str(page) if page is not None and page not in seen_response \
                    else f"{page}-{uuid.uuid4().hex}"
                seen_response.add(page)
                data = record_bytes(record, page, url, payload, digest, refers,
                                    None if refers is None else str(refers))
                frame, offset = writer.add(data)
                rows_of.append((f"{folder}/{name}", record, page, frame, offset, len(data)))
                if writer.total >= bundle_bytes:
                    yield closed()
                    writer = None
                    seen_response = set()
        if writer is not None:
            yield closed()

    return materialize(rows.mapInArrow(run, INDEX_SCHEMA))


READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, url string")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """All records of the bundles named in the column ``bundle``, payloads verified."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("bundle").to_pylist():
                store, path = file_system(uri)
                with store.open_input_file(path) as source:
                    reader = BundleReader(source)
                    for i in range(len(reader.frames)):
                        rows = [read_record(h, block) for h, block in parse_records(reader.frame(i))]
                        yield pa.RecordBatch.from_pylist(rows, READ_ARROW)

    return bundles.mapInArrow(run, READ_SCHEMA)


READ_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string())])


def read_record(head: dict[str, str], block: bytes) -> dict:
    digest = to_hex(head["WARC-Payload-Digest"])
    kind = head["WARC-Type"]
    if kind == "response" and (hashlib.sha1(block).hexdigest() != digest
                               or len(block) != int(head["X-Payload-Length"])):
        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
    return {"page_id": int(head["X-Page-ID"]) if head["X-Page-ID"] else None,
            "payload_bytes": int(head["X-Payload-Length"]), "payload_digest": digest,
            "record_type": kind,
            "refers_to": int(head["X-Refers-To-Page"]) if kind == "revisit" else None,
            "url": head["WARC-Target-URI"]}


def lookup(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """(page_id, payload) of the wanted pages (column page_id) by random access: only the frames
    that hold them, or the records that they revisit, are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, blocks, refers = [], [], []
            for r in b.to_pylist():
                store, path = file_system(r["bundle"])
                with store.open_input_file(path) as source:
                    head, block = BundleReader(source).record(r["frame"], r["offset"], r["length"])
                revisit = head["WARC-Type"] == "revisit"
                ids.append(r["page_id"])
                blocks.append(None if revisit else block)
                refers.append(int(head["X-Refers-To-Page"]) if revisit else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(blocks, pa.binary()), pa.array(refers, pa.int64())],
                ["page_id", "payload", "refers_to"])

    wanted = index.join(page_ids.distinct(), "page_id", "left_semi")
    schema = "page_id long, payload binary, refers_to long"
    direct = wanted.mapInArrow(run, schema)
    hops = direct.filter("refers_to IS NOT NULL").select("page_id", F.col("refers_to").alias("r"))
    target = index.join(hops.select(F.col("r").alias("page_id")).distinct(), "page_id", "left_semi")
    targets = target.mapInArrow(run, schema).select(F.col("page_id").alias("r"), "payload")
    return (direct.filter("refers_to IS NULL").select("page_id", "payload")
            .unionByName(hops.join(targets, "r").select("page_id", "payload")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    index = write_bundles(planned(pages), scratch_root(spark))
    # an explicit number on an expression of its own: by their few bytes the names would all be
    # coalesced into one task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bundles = index.select("bundle").distinct().repartition(tasks, F.xxhash64("bundle"))
    return read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest",
                                        "record_type", "refers_to")
