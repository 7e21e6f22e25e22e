"""WARC archives compressed with a Zstandard dictionary.

Each task writes archives of its pages. The first records of an archive train
its dictionary (``TRAIN_RECORDS`` records, ``TRAIN_BYTES`` bytes, a bounded
sample that only affects the ratio); the dictionary leads the file in a
skippable frame, and every record is a Zstandard frame of its own, so that a
record can be read alone. Archives roll over at ``ROLL_BYTES``. Files get
unique names in a shared folder, and a table of the files of finished tasks is
written by Spark: what a lost or repeated task left is in no table.

Equal payloads of at least ``REVISIT_FROM`` bytes are found by SHA-1 and
length: the one with the largest id is the response, the others are revisit
records that point at it and hold no payload.

Defined cases: NULL html is an empty payload; a NULL url has no target URI;
rows of a NULL id are responses or revisits like others but never referred to
unless their whole group has no id (then all are responses); rows that repeat
the largest id are all responses; an empty table writes no archive and gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import shared_path, staged

REVISIT_FROM = 1000
ROLL_BYTES = 32 << 20
TRAIN_RECORDS, TRAIN_BYTES, DICTIONARY_BYTES = 400, 4 << 20, 64 << 10
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
#: fixed values of the formats
SKIPPABLE, ZSTD_FRAME, ZSTD_DICTIONARY = 0x184D2A5D, b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def folder(path: str):
    """A pyarrow file system and the path in it, for a Hadoop-style URI."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + re.sub("^file:", "", path)
    return fs.FileSystem.from_uri(path)


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}') if page_id is not None else uuid.uuid4()}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    revisit = refers_to is not None
    return record([("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
                   ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
                   ("WARC-Refers-To", record_id(refers_to) if revisit else None), ("WARC-Profile", PROFILE if revisit else None),
                   ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", refers_to),
                   ("Content-Type", "application/http; msgtype=response")], http if revisit else http + payload)


def dictionary(records: list[bytes]):
    """A trained dictionary; too few or too equal records are one themselves."""
    import zstandard

    samples = [r[: TRAIN_BYTES // 64] for r in records]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """One file: dictionary frame, then a frame for each record."""

    def __init__(self, system, path: str, first: list[bytes]) -> None:
        import zstandard

        held = dictionary(first)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        body = zstandard.ZstdCompressor(level=LEVEL).compress(held.as_bytes())
        self.name, self.records, self.bytes = path.rpartition("/")[2], 0, 0
        self.out = system.open_output_stream(path)
        self._put(struct.pack("<II", SKIPPABLE, len(body)) + body)
        info = b"software: cairn\r\nformat: WARC File Format 1.1\r\n"
        self.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                         ("Content-Type", "application/warc-fields")], info))
        for r in first:
            self.add(r)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.packer.compress(data))
        self.records += 1


def write_archives(pages: DataFrame, path: str) -> DataFrame:
    """Write (id, url, html, refers_to) below ``path``; a row per archive: archive, records, bytes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = folder(path)
        system.create_dir(root, recursive=True)
        now, waiting, size = None, [], 0

        def start() -> Archive:
            return Archive(system, f"{root}/{uuid.uuid4().hex}.warc.zst", waiting)

        def end(archive: Archive) -> pa.RecordBatch:
            archive.out.close()
            return pa.RecordBatch.from_pydict({"archive": [archive.name], "records": [archive.records], "bytes": [archive.bytes]})

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html", "refers_to")), strict=True)
            for page_id, url, html, refers_to in rows:
                data = page_record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to)
                if now is None:
                    waiting.append(data)
                    size += len(data)
                    if len(waiting) < TRAIN_RECORDS and size < TRAIN_BYTES:
                        continue
                    now = start()
                    waiting, size = [], 0
                else:
                    now.add(data)
                if now.bytes >= ROLL_BYTES:
                    yield end(now)
                    now = None
        if now is None and waiting:
            now = start()
        if now is not None:
            yield end(now)

    return staged(pages.select("id", "url", "html", "refers_to").mapInArrow(write, "archive string, records long, bytes long"), "archives")


def records_of(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of every record of an archive's stream."""
    import zstandard

    magic, size = struct.unpack("<II", data.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    held = data.read(size)
    if held.startswith(ZSTD_FRAME):
        held = zstandard.ZstdDecompressor().decompress(held)
    kind = zstandard.DICT_TYPE_FULLDICT if held.startswith(ZSTD_DICTIONARY) else zstandard.DICT_TYPE_RAWCONTENT
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held, dict_type=kind))
    text = io.BufferedReader(unpacker.stream_reader(data, read_across_frames=True), 1 << 20)
    while line := text.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := text.readline().strip()):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = text.read(int(headers["content-length"]))
        text.read(4)
        yield headers, block


def read_archives(archives: DataFrame, path: str) -> DataFrame:
    """A row per page record of the listed archives: page_id, payload_bytes,
    payload_digest (of the payload itself where the record holds it),
    record_type, refers_to, url, archive."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = folder(path)
        number = lambda x: int(x) if x is not None else None

        def rows(name: str):
            with system.open_input_stream(f"{root}/{name}") as data:
                for headers, block in records_of(data):
                    if (kind := headers["warc-type"]) not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
                    digest = hashlib.sha1(payload).hexdigest() if kind == "response" else headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and length != len(payload):
                        raise ValueError(f"payload of {headers['warc-record-id']} is cut")
                    yield (number(headers.get("x-page-id")), length, digest, kind, number(headers.get("x-refers-to-page-id")), headers.get("warc-target-uri"), name)

        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("url", pa.string()), ("archive", pa.string())])
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                if found := list(rows(name)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    n = max(1, archives.count())  # one archive a task
    return archives.select("archive").repartition(n).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string")


def with_revisits(df: DataFrame, key: str = "page_id") -> DataFrame:
    """(id, url, html, refers_to): refers_to is the response's id for revisits."""
    pages = df.select(F.col(key).cast("long").alias("id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    marked = pages.withColumns({"digest": F.sha1(payload), "size": F.length(payload)})
    groups = staged(marked.filter(F.col("size") >= REVISIT_FROM).groupBy("digest", "size")
                    .agg(F.max("id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n"), "payloads")
    refers_to = F.when(F.col("id").isNull() | (F.col("id") < F.col("first_id")), F.col("first_id"))
    return marked.join(groups, ["digest", "size"], "left").select("id", "url", "html", refers_to.alias("refers_to"))


def round_trip(df: DataFrame, key: str = "page_id") -> DataFrame:
    """Write all pages as archives and return what the archives hold."""
    path = shared_path(df.sparkSession, "warc")
    return read_archives(write_archives(with_revisits(df, key), path), path).withColumnRenamed("page_id", key)
