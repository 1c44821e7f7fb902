import base64
import hashlib
import io
import os
import struct

import pyarrow as pa
import pytest
import zstandard as zstd

from fraudlens.llm import warc


def sha1(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def roundtrip(spark, df, **kw):
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(df.withColumnRenamed("text", "html").withColumnRenamed("doc_id", "page_id")
                                   .selectExpr("page_id", "html", "concat('http://x/', page_id, '\n%') AS url", "'c' AS payload", "1 AS refers_to"), folder, **kw)
    return manifest, folder, warc.read_archives(manifest, folder).collect()


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_round_trip_with_revisits(spark, frame, broadcast_rows):
    rows = [(1, "same"), (2, "same"), (3, None), (4, ""), (5, "é" * 200_000), (6, "one"), (7, "same"), (None, "same"), (8, "a\r\n\r\nb")]
    _, _, got = roundtrip(spark, frame(rows), broadcast_rows=broadcast_rows)
    by = {r["page_id"]: r for r in got}
    for i, t in rows:
        r, equal = by[i], [j for j, u in rows if (u or "") == (t or "") and j is not None]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((t or "").encode()), sha1(t))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == max(equal) else ("revisit", max(equal)))
        assert bytes(r["payload"]).decode() == (t or "") if r["record_type"] == "response" else r["payload"] is None
        assert r["url"] == (None if i is None else f"http://x/{i}\n%")
    assert len(got) == len(rows)


def test_small_payloads_stay_responses_and_archives_roll(spark, frame):
    rows = [(i, "tiny" if i % 2 else "x" * 5000 + str(i)) for i in range(700)]
    manifest, _, got = roundtrip(spark, frame(rows), min_bytes=100, archive_bytes=2000)
    assert {r["record_type"] for r in got} == {"response"} and len(got) == 700
    assert manifest.count() >= 3


def test_empty_table(spark, frame):
    manifest, _, got = roundtrip(spark, frame([]))
    assert got == [] and manifest.count() == 0


def test_archive_layout_and_dictionary(tmp_dir):
    records = [warc.make_record(i, "http://h/", f"<p>{i} {'lorem ipsum dolor ' * 30}</p>".encode(), None) for i in range(200)]
    out = io.BytesIO()
    w = warc.ArchiveWriter(out, records)
    for r in records:
        w.add(r)
    data = out.getvalue()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_FRAME and data[8 + size:12 + size] == struct.pack("<I", warc.ZSTD_FRAME)
    assert list(warc.read_frames(io.BytesIO(data))) == records
    raw = zstd.ZstdDecompressor().decompress(data[8:8 + size])      # an uncompressed dictionary is read as well
    plain = struct.pack("<II", warc.DICTIONARY_FRAME, len(raw)) + raw + data[8 + size:]
    assert list(warc.read_frames(io.BytesIO(plain))) == records
    assert list(warc.read_frames(io.BytesIO(b""))) == []
    without = io.BytesIO()
    w = warc.ArchiveWriter(without, records[:1])                    # too few samples: no dictionary frame
    w.add(records[0])
    assert list(warc.read_frames(io.BytesIO(without.getvalue()))) == records[:1]


@pytest.mark.parametrize("damage", [
    lambda d: d.replace(b"WARC/1.1", b"WARC/9.9"), lambda d: d.replace(b"WARC-Date: ", b"X-Date: "), lambda d: d[:-1],
    lambda d: d.replace(b"hello", b"jello"), lambda d: d.replace(b"sha1:", b"sha1:A"), lambda d: d.replace(b"WARC-Type: response", b"WARC-Type: other"),
    lambda d: d.replace(b"<urn:page:1>", b"<urn:x>"), lambda d: d.replace(b"WARC-Type", b"WARC-Date", 1), lambda d: b"",
    lambda d: d.replace(b"WARC-Type: response", b"WARC-Type: revisit")])
def test_bad_records_are_rejected(damage):
    good = warc.make_record(1, "u", b"hello", None)
    assert warc.parse_record(good)[4] == b"hello"
    with pytest.raises(warc.WarcError):
        warc.parse_record(damage(good))


def test_cut_and_damaged_frames_are_rejected():
    frame = zstd.ZstdCompressor(write_checksum=True).compress(b"record" * 100)
    for bad in (frame[:-3], frame[:-1] + b"\x00", b"not a frame", struct.pack("<II", warc.DICTIONARY_FRAME, 99) + b"x"):
        with pytest.raises(warc.WarcError):
            list(warc.read_frames(io.BytesIO(bad)))


def test_manifest_guards_against_missing_records(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a.warc.zst")
    with open(path, "wb") as f:
        w = warc.ArchiveWriter(f, [])
        w.add(warc.make_record(1, None, b"x", None))
    manifest = spark.createDataFrame([(path, 2, 1)], warc.MANIFEST)
    with pytest.raises(Exception, match="1 records, not 2"):
        warc.read_archives(manifest, f"file://{tmp_dir}").collect()
    assert isinstance(pa.schema([]), pa.Schema)
