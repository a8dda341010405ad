import base64
import hashlib
import os
import struct

import zstandard

from support import prose
from venuerank.llm import warc

SCHEMA = "page_id long, url string, html string, score int, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], SCHEMA)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_round_trip(spark):
    rows = [(i, f"http://a.example/{i}", f"<p>{prose(80, i % 40)}</p>") for i in range(200)]
    rows += [(300, None, None), (301, "", ""), (302, "http://b.example/a b\r\nX: y", "WARC/1.1\r\n\r\n" + prose(9, 1)), (303, "http://é.example/", "é" * 400_000)]
    got = {r.page_id: r for r in warc.archived(pages(spark, rows)).collect()}
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(i, largest.get(h or "", -1))
    assert set(got) == {i for i, _, _ in rows}
    for i, _, h in rows:
        payload, response, r = (h or "").encode(), largest[h or ""], got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest(payload))
        assert (r.record_type, r.refers_to) == (("response", None) if response == i else ("revisit", response))
        assert r.payload == (bytearray(payload) if response == i else None)
    assert got[302].url == "http://b.example/a%20b%0D%0AX:%20y"


def test_small_payloads_and_repeated_rows(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long enough"), (4, "u", "long enough"), (4, "u", "long enough"), (None, "u", "long enough"), (None, "v", "z")]
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.archived(pages(spark, rows), least_bytes=5).collect())
    assert got == [
        ("1", "response", None), ("2", "response", None), ("3", "revisit", 4), ("4", "response", None), ("4", "response", None),
        ("None", "response", None), ("None", "revisit", 4),
    ]


def test_empty_table(spark):
    assert warc.archived(pages(spark, [])).count() == 0


def test_archives_are_standard(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    made = warc.write(pages(spark, [(i, "http://x.example/", prose(600, i)) for i in range(300)]), folder)
    files = sorted(f for f in os.listdir(tmp_path / "archives") if f.endswith(".warc.zst"))
    assert made == len(files) > 0 and not [f for f in os.listdir(tmp_path / "archives") if f.endswith(".tmp")]
    content = (tmp_path / "archives" / files[0]).read_bytes()
    magic, size = struct.unpack("<II", content[:8])
    assert magic == 0x184D2A5D and content[8:12] == struct.pack("<I", 0xEC30A437)
    # each record is a frame that can be read alone
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8 : 8 + size])).decompressobj()
    record = reader.decompress(content[8 + size :])
    assert record.startswith(b"WARC/1.1\r\n") and record.count(b"WARC/1.1\r\n") == 1 and reader.unused_data


def test_a_few_pages_have_a_dictionary_too(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    rows = [(i, "http://x.example/", prose(60, 1) + prose(20, i)) for i in range(4)] + [(9, None, "x" * (300 << 10))]
    assert warc.write(pages(spark, rows), folder) > 0
    for name in os.listdir(tmp_path / "archives"):
        if not name.endswith(".warc.zst"):
            continue
        content = (tmp_path / "archives" / name).read_bytes()
        magic, size = struct.unpack("<II", content[:8])
        # records as they are archived, whole
        assert magic == 0x184D2A5D and content[8 : 8 + size].startswith(b"WARC/1.1\r\n") and prose(60, 1).encode() in content[8 : 8 + size]
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8 : 8 + size])).decompressobj()
        assert reader.decompress(content[8 + size :]).startswith(b"WARC/1.1\r\n")
    assert {r.page_id: len(r.payload or "") for r in warc.archived(pages(spark, rows)).collect()} == {i: len(h) for i, _, h in rows}


def test_archives_roll(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, "u", prose(150, i)) for i in range(400)]  # far more than the dictionary holds
    made = warc.write(pages(spark, rows), f"file://{tmp_path}/a")
    assert made > 40 and warc.read(spark, f"file://{tmp_path}/a").count() == 400


def test_a_damaged_payload_is_noticed(spark):
    from venuerank.llm.warc import parse, record
    import io

    raw = record(1, "u", b"payload", None)
    (fields, block), = parse(io.BufferedReader(io.BytesIO(raw)))
    assert fields["warc-payload-digest"] == f"sha1:{digest(b'payload')}" and block.endswith(b"payload")
