"""WARC archives, Zstandard-compressed: one frame per record, dictionary in a leading skippable frame.

Writing: equal payloads are found by one aggregation on their digest (map-side
combine, so a payload shared by many pages costs one row per task); the page
with the largest id carries the payload, the others are ``revisit`` records.
Each task writes archives of about ``archive_bytes`` straight to the shared
folder and returns their paths; only paths in the checkpointed manifest are read,
so files that a lost or repeated task left behind are ignored.

Reading: each task streams its archives in chunks, loads the dictionary from the
skippable frame, decodes frame by frame and holds one record at a time.
Headers, lengths and digests are validated; a bad record raises ``WarcError``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm.common import ensure_checkpoint_dir, materialize, scratch_path

#: Frame magics of the Zstandard format, profile and version of the WARC format.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "1970-01-01T00:00:00Z"   # records are reproducible: no wall clock in them
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 4 << 20, 32 << 10
CHUNK = 1 << 20
MANIFEST = "path string, records bigint, bytes bigint"
RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
          "payload_bytes bigint, payload_digest string")
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                           ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string())])


class WarcError(ValueError):
    """A frame, header, length or digest that does not fit the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """One line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text)


def _from_header(text: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit without the payload where ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"),
            ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _header_value(url)))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest) of one record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version != VERSION:
        raise WarcError(f"no WARC record: {data[:40]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.decode().partition(": ")
        if not colon or name in fields:
            raise WarcError(f"header line {line!r}")
        fields[name] = value
    missing = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Payload-Digest", "Content-Length"} - fields.keys()
    if missing:
        raise WarcError(f"missing headers: {sorted(missing)}")
    if not fields["Content-Length"].isdigit() or len(rest) != int(fields["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"{fields['WARC-Record-ID']}: block of {len(rest) - 4} bytes, not {fields['Content-Length']}")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: (\d+)$", http)
    if not found or not length:
        raise WarcError(f"{fields['WARC-Record-ID']}: no HTTP header")
    kind, sha1 = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page, refers = _page(fields["WARC-Record-ID"]), None
    if kind == "response":
        if len(payload) != int(length[1]) or digest(payload) != sha1:
            raise WarcError(f"{fields['WARC-Record-ID']}: payload does not fit its length or digest")
    elif kind == "revisit":
        if payload or "WARC-Refers-To" not in fields:
            raise WarcError(f"{fields['WARC-Record-ID']}: a revisit needs a reference and no payload")
        payload, refers = None, _page(fields["WARC-Refers-To"])
    else:
        raise WarcError(f"record type {kind!r}")
    url = fields.get("WARC-Target-URI")
    return page, url if url is None else _from_header(url), kind, refers, payload, int(length[1]), sha1


def _page(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(null|-?\d+)>", urn)
    if not m:
        raise WarcError(f"record id {urn!r}")
    return None if m[1] == "null" else int(m[1])


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of a few records; empty where they are too few or too short for one."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return b""


class ArchiveWriter:
    """Writes one archive; ``sample`` records train its dictionary."""

    def __init__(self, out, sample: list[bytes]):
        self.out, self.records, self.bytes = out, 0, 0
        raw = train_dictionary(sample)
        if raw:
            packed = zstd.ZstdCompressor().compress(raw)
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        self.zstd = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(raw) if raw else None, write_checksum=True)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.zstd.compress(record))
        self.records += 1


def read_frames(source) -> Iterator[bytes]:
    """The decoded frames of an archive; ``source.read(n)`` gives its bytes."""
    held = source.read(8)
    dictionary = None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", held[4:])[0]
        raw = source.read(size)
        if len(raw) != size:
            raise WarcError("the dictionary frame is cut off")
        if raw[:4] == struct.pack("<I", ZSTD_FRAME):
            raw = zstd.ZstdDecompressor().decompress(raw)
        dictionary, held = zstd.ZstdCompressionDict(raw), b""
    decoder = zstd.ZstdDecompressor(dict_data=dictionary)
    while held or (held := source.read(CHUNK)):
        frame, parts = decoder.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(held))
            except zstd.ZstdError as e:
                raise WarcError(f"bad frame: {e}") from e
            if frame.eof:
                held = frame.unused_data
                break
            held = source.read(CHUNK)
            if not held:
                raise WarcError("the last frame is cut off")
        yield b"".join(parts)


def _filesystem(path: str):
    return pa.fs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0, archive_bytes: int = 64 << 20,
                   broadcast_rows: int = 100_000) -> DataFrame:
    """Write a record per page to archives in ``folder``; returns the manifest (path, records, bytes).

    NULL html is an empty payload.  Of equal payloads of at least ``min_bytes``
    bytes the record with the largest page_id is the response and the others
    revisit it; rows that repeat that id with the same payload are responses
    too.  A NULL url is left out of the record; a NULL page_id is smaller than
    any other, and where a group has only such ids all are responses.  An
    empty table writes nothing.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("same"))
    shared = materialize(rows.where(F.octet_length("payload") >= min_bytes).groupBy("same")
                         .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1").drop("n"))
    small = F.broadcast if shared.count() <= broadcast_rows else (lambda df: df)
    typed = rows.join(small(shared), "same", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def records(batches) -> Iterator[bytes]:
        for b in batches:
            for i in range(b.num_rows):
                page_id, url, data, refers_to = (b.column(c)[i].as_py() for c in range(4))
                yield make_record(page_id, url, data, refers_to)

    def run(batches):
        stream, files, done = records(batches), _filesystem(folder), False
        fs, root = files
        fs.create_dir(root, recursive=True)
        while not done:
            sample, size = [], 0
            for r in stream:
                sample.append(r)
                size += len(r)
                if len(sample) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
                    break
            if not sample:
                return
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(path, compression=None) as out:
                w = ArchiveWriter(out, sample)
                for r in sample:
                    w.add(r)
                done = True
                for r in stream:
                    w.add(r)
                    if w.bytes >= archive_bytes:
                        done = False
                        break
            yield pa.RecordBatch.from_pylist([{"path": path, "records": w.records, "bytes": w.bytes}], schema=schema)

    return materialize(typed.mapInArrow(run, MANIFEST))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the archives in a manifest, validated; ``payload`` is NULL for revisits.

    Raises ``WarcError`` on a malformed record and where an archive does not
    hold the number of records its manifest row states.
    """

    def run(batches):
        fs, _ = _filesystem(folder)
        for b in batches:
            for row in b.to_pylist():
                held, size, n = [], 0, 0
                with fs.open_input_stream(row["path"], compression=None) as source:
                    for frame in read_frames(source):
                        held.append(parse_record(frame))
                        size, n = size + len(frame), n + 1
                        if size >= 4 << 20:
                            yield _batch(held)
                            held, size = [], 0
                if n != row["records"]:
                    raise WarcError(f"{row['path']}: {n} records, not {row['records']}")
                if held:
                    yield _batch(held)

    return manifest.mapInArrow(run, RECORD)


def _batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_SCHEMA)], schema=RECORD_SCHEMA)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives under the shared checkpoint folder, as a URI."""
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    return path if re.match(r"[a-z0-9]+:/", path) else f"file://{path}"
