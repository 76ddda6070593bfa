"""WARC archives as seekable Zstandard bundles: independent frames of records, a seek table as footer, and an index of offsets."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import stored

#: Bytes of records after which a frame ends, and of compressed frames after which a bundle ends.
FRAME, BUNDLE = 1 << 18, 128 << 20
#: Rows and payload bytes a reader hands on at a time.
ROWS, BYTES = 4096, 8 << 20

# Fixed values of the formats: magic numbers of Zstandard's skippable frame and seek table, the revisit profile.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "record_id string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"
INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, offset long, length long"


def _record_id(page: int | None, row: int) -> bytes:
    return b"urn:x-page:%s:%d" % (b"" if page is None else b"%d" % page, row)


def _page_of(record_id: str) -> int | None:
    page = record_id.split(":")[2]
    return int(page) if page else None


def _clean(url: str) -> bytes:
    """Blanks and control characters, which would end the header line, percent-encoded."""
    return re.sub("[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url).encode()


def record(page: int | None, row: int, url: str | None, payload: bytes, sha1: str, first: tuple[int | None, int] | None, date: str) -> bytes:
    """One WARC/1.1 record: a response, or where ``first`` names another record of this payload, a revisit without it."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"response" if first is None else b"revisit"), b"WARC-Record-ID: <%s>" % _record_id(page, row), b"WARC-Date: " + date.encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _clean(url))
    if first is None:
        block += payload
    else:
        lines += [b"WARC-Profile: " + _PROFILE, b"WARC-Refers-To: <%s>" % _record_id(*first)]
    lines += [
        b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Writes one bundle after the other to a folder: a frame at a time, so memory is bounded by a frame and a record.

    A record longer than a frame gets a frame of its own. Bundles have names never used before, so an attempt of a task
    that is lost leaves files that no index names.
    """

    def __init__(self, folder: str, frame: int = FRAME, bundle: int = BUNDLE) -> None:
        self.files, self.folder = pafs.FileSystem.from_uri(folder)
        self.frame_size, self.bundle_size = frame, bundle
        self.coder = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.out = None
        self.held: list[bytes] = []
        self.size = 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        """The bundle, the frame's number there and the record's offset in the frame's content."""
        if self.held and self.size + len(data) > self.frame_size:
            self._end_frame()
        if self.out is None:
            self.name, self.frames, self.written = f"bundle-{uuid.uuid4().hex}.warc.zst", [], 0
            self.files.create_dir(self.folder, recursive=True)
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        place = (self.name, len(self.frames), self.size)
        self.held.append(data)
        self.size += len(data)
        return place

    def _end_frame(self) -> None:
        packed = self.coder.compress(b"".join(self.held))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.written += len(packed)
        self.held, self.size = [], 0
        if self.written >= self.bundle_size:
            self.close()

    def close(self) -> None:
        if self.held:
            self._end_frame()
        if self.out is not None:
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out = None


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer of the seekable format: a skippable frame of compressed and plain sizes, then their number and a magic number."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames) + struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


class BundleReader:
    """A bundle's frames by number, from its footer."""

    def __init__(self, folder: str, name: str) -> None:
        files, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
        self.file = files.open_input_file(path)
        end = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._bytes(end - 9, 9))
        if magic != _SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        entry = 12 if flags & 0x80 else 8
        table = self._bytes(end - 9 - entry * count, entry * count)
        self.sizes = [struct.unpack_from("<II", table, entry * k) for k in range(count)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.decoder = zstandard.ZstdDecompressor()

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        packed, plain = self.sizes[number]
        return self.decoder.decompress(self._bytes(self.starts[number], packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def parse(data: bytes, at: int = 0) -> Iterator[tuple[tuple, bytes | None, int]]:
    """The records from offset ``at`` of a frame's content on: (the columns of RECORD, payload, offset); a revisit has no payload.

    A response's digest and length are those of its payload as read; one that differs from its header raises.
    """
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head].split(b"\r\n")
        if version != b"WARC/1.1":
            raise ValueError(f"no record at offset {at}")
        fields = {name.lower(): value for name, value in (line.split(b": ", 1) for line in lines)}
        begin, size = head + 4, int(fields[b"content-length"])
        body = data.index(b"\r\n\r\n", begin) + 4
        known = fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
        name, kind = fields[b"warc-record-id"][1:-1].decode(), fields[b"warc-type"].decode()
        url = fields[b"warc-target-uri"].decode() if b"warc-target-uri" in fields else None
        length = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", data[begin:body])[1])
        payload, refers = None, None
        if kind == "revisit":
            refers = _page_of(fields[b"warc-refers-to"][1:-1].decode())
        else:
            payload = data[body : begin + size]
            if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != known:
                raise ValueError(f"the payload of {name} is not the one its header names")
        yield (name, _page_of(name), url, kind, refers, known, length), payload, at
        at = begin + size + 4


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    frame: int = FRAME,
    bundle: int = BUNDLE,
) -> DataFrame:
    """Write a WARC record for every row into bundles below ``folder``; the index of records, from ``folder/index``.

    Of rows with equal payloads of at least ``least`` bytes, that with the smallest key is a response, the others are
    revisits of it; all shorter ones are responses. A null payload counts as empty, a null url leaves its header out.
    Null keys come last in that order, and of rows of the same key and payload one is the response. Repeated rows
    are records of their own. No rows give no bundles and an empty index. ``date`` goes into every record.

    The table is read twice and must give the same rows in the same order both times, as files do; what a shuffle dealt
    is to be stored first, and a difference raises. Only payloads
    that occur twice enter the join, and a payload most rows share is one row of each task before it. The index is
    committed by Spark, and names the bundles of the successful tasks only.
    """
    given = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = given.select("*", F.monotonically_increasing_id().alias("row"), F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size"))
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "row")
    shared = stored(rows.filter(F.col("size") >= least).groupBy("sha1", "size").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    joined = rows.join(shared, ["sha1", "size"], "left").select("key", "url", "payload", "row", "sha1", F.col("first.key").alias("first_key"), F.col("first.row").alias("first_row"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        writer, arrow = BundleWriter(f"{folder}/bundles", frame, bundle), to_arrow_schema(target)
        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            keys, urls, numbers, hashes, first_keys, first_rows = (columns[k].to_pylist() for k in (0, 1, 3, 4, 5, 6))
            out: list[tuple] = []
            for k, row in enumerate(numbers):
                first = None if first_rows[k] in (None, row) else (first_keys[k], first_rows[k])
                data = record(keys[k], row, urls[k], columns[2][k].as_buffer().to_pybytes(), hashes[k], first, date)
                out.append((_record_id(keys[k], row).decode(), keys[k], "response" if first is None else "revisit", *writer.add(data), len(data)))
            yield pa.RecordBatch.from_arrays([pa.array(values, type=f.type) for values, f in zip(zip(*out, strict=True), arrow, strict=True)] if out else [pa.array([], f.type) for f in arrow], schema=arrow)
        writer.close()

    target = pages.sparkSession.createDataFrame([], INDEX).schema
    joined.mapInArrow(run, target).write.parquet(f"{folder}/index")
    index = pages.sparkSession.read.schema(target).parquet(f"{folder}/index")
    revisits = index.filter("record_type = 'revisit'").count()
    if revisits != (shared.agg(F.sum(F.col("n") - 1)).first()[0] or 0):
        raise RuntimeError("the pages changed between two reads")
    return index


def _read(index: DataFrame, folder: str, schema: str, rows_of) -> DataFrame:
    """``rows_of(reader, asked)`` for every bundle of ``index`` (columns bundle, asked), a bundle a task at most."""
    spark = index.sparkSession
    target = spark.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(values, type=f.type) for values, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for name, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = BundleReader(f"{folder}/bundles", name)
                for row, weight in rows_of(reader, asked):
                    held.append(row)
                    size += weight
                    if len(held) >= ROWS or size >= BYTES:
                        yield out()
                        held, size = [], 0
                reader.close()
        if held:
            yield out()

    return index.select("bundle", "asked").mapInArrow(run, target)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives the index names, read from the bundles: the columns of RECORD, and the payload.

    A response's digest is computed anew from its payload; a revisit has the digest and length its headers name, and no
    payload. ``refers_to`` is the key of the revisited response. Bundles are dealt evenly to tasks.
    """
    index = spark.read.schema(spark.createDataFrame([], INDEX).schema).parquet(f"{folder}/index")
    bundles = stored(index.groupBy("bundle").agg(F.count("*").alias("asked")))
    tasks = max(1, min(bundles.count(), 64 * spark.sparkContext.defaultParallelism))

    def rows_of(reader: BundleReader, asked: int) -> Iterator[tuple[tuple, int]]:
        found = 0
        for number in range(len(reader.sizes)):
            for fields, payload, _ in parse(reader.frame(number)):
                found += 1
                yield (fields + (payload,) if payloads else fields), (len(payload or b"") if payloads else 0)
        if found != asked:
            raise ValueError(f"a bundle holds {found} records, its index {asked}")

    return _read(bundles.repartition(tasks), folder, RECORD + (", payload binary" if payloads else ""), rows_of)


def lookup(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is among ``wanted``'s: only their frames are read, from the offsets of the index.

    The columns of ``read``. An id that is not in the index gives no row; one asked for twice gives one.
    """
    hits = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    asked = hits.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset"))).alias("asked"))

    def rows_of(reader: BundleReader, places: list[dict]) -> Iterator[tuple[tuple, int]]:
        number, data = -1, b""
        for place in places:
            if place["frame"] != number:
                number = place["frame"]
                data = reader.frame(number)
            fields, payload, _ = next(parse(data, place["offset"]))
            yield fields + (payload,), len(payload or b"")

    return _read(asked, folder, RECORD + ", payload binary", rows_of)
