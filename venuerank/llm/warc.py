"""WARC archives compressed record by record with a Zstandard dictionary of their own.

A dictionary is trained on a bounded sample of the payloads and stands in a skippable frame at the
head of every archive; each record is a frame of its own. Of pages with equal payloads the one
with the largest page_id is written as a response, the others as revisits that name it and keep
its HTTP header, so a payload is stored once. Archives are written by the tasks to the shared
folder: first under a name of the attempt, then moved to the partition's name. A partition's
pages are sorted, so a task that runs again after a lost executor writes the same archives.

The sample is whole records of at most DICTIONARY_SAMPLES pages, the first by a hash of page_id, those of at
most DICTIONARY_RECORD bytes and of DICTIONARY_INPUT bytes together; it bounds the dictionary only. A
sample too small to train on is a dictionary itself, as plain content: the ends of its records one after
another, with that of an empty page first, so there is always one.

Defined results: a null html is an empty payload, and payloads below `least_bytes` are never
revisits; pages with equal payload and page_id are all responses; a null page_id is written as
`null` and revisits the others; a null url becomes the page's own name, and control characters
and blanks in it are escaped; an empty table gives no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuerank.llm.sampling import first_by_hash
from venuerank.session import materialise, shared_dir

DICTIONARY_SAMPLES = 2000
DICTIONARY_RECORD = 256 << 10
DICTIONARY_INPUT = 16 << 20
DICTIONARY_BYTES = 64 << 10
LEAST_RECORDS, LEAST_INPUT = 16, 8 * DICTIONARY_BYTES  # of a sample that is trained on
LEVEL = 3
ARCHIVE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"  # pages carry no date
_SKIPPABLE = 0x184D2A5D  # fixed by the format for dictionaries
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def train(pages: DataFrame) -> bytes:
    """The dictionary of archives of these pages."""
    import zstandard

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    chosen = materialise(first_by_hash(rows.filter(F.octet_length("html") <= DICTIONARY_RECORD), "page_id", DICTIONARY_SAMPLES), "warc-sample")
    # at most DICTIONARY_SAMPLES rows; the last may pass DICTIONARY_INPUT
    upto = F.sum(F.octet_length("html")).over(Window.orderBy(F.xxhash64("page_id"), "page_id", "url", "html").rowsBetween(Window.unboundedPreceding, -1))
    kept = chosen.withColumn("before", F.coalesce(upto, F.lit(0))).filter(F.col("before") < DICTIONARY_INPUT)
    samples = [record(r["page_id"], r["url"], r["html"].encode(), None) for r in kept.orderBy("before").collect()]  # bounded by the three parameters
    if len(samples) >= LEAST_RECORDS and sum(map(len, samples)) >= LEAST_INPUT:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    return b"".join([record(None, None, b"", None), *samples])[-DICTIONARY_BYTES:]


def _name(page_id: int | None) -> str:
    return f"urn:x-page:{'null' if page_id is None else page_id}"


def _uri(url: str | None, page_id: int | None) -> str:
    return "".join(f"%{b:02X}" if b < 33 or b > 126 else chr(b) for b in url.encode()) if url else _name(page_id)


def record(page_id: int | None, url: str | None, payload: bytes, refers: tuple[int | None] | None) -> bytes:
    """One WARC/1.1 record; `refers` holds the response's page_id for revisits."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    fields = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: <{_name(page_id)}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url, page_id)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if refers:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_name(refers[0])}>"]
    return "\r\n".join([*fields, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a decompressed archive."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no WARC record where one should start: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b": ")
            fields[key.decode().lower()] = value.decode()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield fields, block


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    import zstandard

    dictionary, at = None, 0
    if len(content) >= 8 and struct.unpack("<I", content[:4])[0] == _SKIPPABLE:
        at = 8 + struct.unpack("<I", content[4:8])[0]
        dictionary = zstandard.ZstdCompressionDict(content[8:at])
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(content[at:]), read_across_frames=True)
    yield from parse(io.BufferedReader(reader, 1 << 20))


def _page_id(name: str) -> int | None:
    tail = name.strip("<>").rpartition(":")[2]
    return None if tail == "null" else int(tail)


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> int:
    """Write all pages as archives below `folder`; the number of archives."""
    dictionary = train(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha2("html", 256))
    sizes = F.octet_length("html")
    # equal payloads: the narrow keys meet, with map-side sums; the payloads stay where they are
    known = materialise(keyed.filter(sizes >= least_bytes).select("page_id", "sha").distinct(), "warc-keys")
    first = materialise(known.groupBy("sha").agg(F.max("page_id").alias("refers_to")), "warc-first")
    revisits = materialise(
        known.join(first, "sha").filter(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("r_page_id"), F.col("sha").alias("r_sha"), "refers_to"),
        "warc-revisits",
    )
    met = keyed.join(revisits, keyed["page_id"].eqNullSafe(revisits["r_page_id"]) & (keyed["sha"] == revisits["r_sha"]), "left")
    parts = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = met.select("page_id", "url", "html", "refers_to").repartition(parts, "page_id", F.length("html")).sortWithinPartitions("page_id", "url", "html")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        head = struct.pack("<II", _SKIPPABLE, len(dictionary)) + dictionary
        part, made = TaskContext.get().partitionId(), 0
        frames = io.BytesIO()

        def close() -> int:
            nonlocal frames, made
            if not frames.tell():
                return 0
            temporary = f"{base}/_{uuid.uuid4().hex}.tmp"
            with store.open_output_stream(temporary) as out:
                out.write(head)
                out.write(frames.getbuffer())
            store.move(temporary, f"{base}/part-{part:06d}-{made:04d}.warc.zst")
            frames, made = io.BytesIO(), made + 1
            return 1

        done = 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4))):
                page_id, url, html, refers = (x.as_py() for x in row)
                frames.write(compressor.compress(record(page_id, url, html.encode(), None if refers is None else (refers,))))
                if frames.tell() >= ARCHIVE_BYTES:
                    done += close()
        yield pa.RecordBatch.from_arrays([pa.array([done + close()], pa.int64())], names=["archives"])

    _make_folder(rows, folder)
    return dealt.mapInArrow(archive, "archives long").agg(F.sum("archives")).first()[0] or 0


def _make_folder(df: DataFrame, folder: str) -> None:
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def read(spark, folder: str) -> DataFrame:
    """Every record of the archives below `folder`; payloads of responses are checked against their digests."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out: dict[str, list] = {c: [] for c in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
                for fields, block in read_archive(content.as_buffer()):
                    header, _, payload = block.partition(b"\r\n\r\n")
                    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in header.decode().split("\r\n")[1:])}
                    digest, response = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "response"
                    if response and (len(payload) != int(http["content-length"]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"payload of {fields['warc-record-id']} doesn't match its digest")
                    row = (
                        _page_id(fields["warc-record-id"]), fields["warc-target-uri"], int(http["content-length"]), digest, fields["warc-type"],
                        None if response else _page_id(fields["warc-refers-to"]), payload if response else None,
                    )
                    for column, value in zip(out.values(), row):
                        column.append(value)
                    if len(out["page_id"]) >= 512:
                        yield _batch(out)
                        out = {c: [] for c in out}
                yield _batch(out)

    def _batch(out: dict[str, list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return files.mapInArrow(records, schema)


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to a new folder of the shared one and read the archives back."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    write(pages, folder, least_bytes)
    return read(spark, folder)
