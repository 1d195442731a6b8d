"""WARC archives with a Zstandard dictionary: a writer, and a reader that streams.

Each archive begins with a skippable frame that holds a dictionary built from records of that archive; every record
follows as a Zstandard frame of its own, so it can be read alone by its offset. Of records with equal payloads one is
kept as a response, the others as revisits of it without a payload.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparge.llm.common import settings, write_stage
from sparge.session import scratch_path

DEDUP_BYTES = 1000
LEVEL = 3
# Records that a dictionary is built from: the first of an archive, up to so many bytes of them.
SAMPLE_BYTES = 2 << 20
SAMPLE_PART = 64 << 10
DICTIONARY_BYTES = 64 << 10
# An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
# Magic number of the skippable frame that carries a dictionary.
SKIPPABLE = 0x184D2A5D
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("8c6f0c3c-2f1e-5d3f-9b6a-2f0f5a3f7d11")


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page} {digest}')}>"


def _clean(value: str) -> str:
    """A header value on one line: line breaks and other control characters as percent escapes."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit names the response it repeats and has an empty block."""
    block = b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page, digest)}",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page is not None:
        lines.append(f"X-Page-Id: {page}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        lines.append(f"X-Refers-To-Page: {refers_to}")
    else:
        lines.append("Content-Type: text/html; charset=utf-8")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on the records; if they are too few or too alike for that, their own bytes are it."""
    samples = [r[at : at + SAMPLE_PART] for r in records for at in range(0, len(r), SAMPLE_PART)]
    with suppress(zstandard.ZstdError):
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 10)), samples)
    return zstandard.ZstdCompressionDict(b"".join(records)[-size:].rjust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """Writes one archive; records wait in memory until there are enough for the dictionary."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.path, self.waiting, self.size, self.frames = path, [], 0, None
        # The stream must not compress by the name's ending; frames are made here.
        self.out = files.open_output_stream(path, compression=None)

    def add(self, data: bytes) -> None:
        if self.frames:
            self._write(self.frames.compress(data))
            return
        self.waiting.append(data)
        self.size += len(data)
        if self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        dictionary = build_dictionary(self.waiting)
        raw = dictionary.as_bytes()
        self.size = 0
        self._write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for data in self.waiting:
            self._write(self.frames.compress(data))
        self.waiting = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if not self.frames:
            self._begin()
        self.out.close()


def _write_archives(folder: str, archive_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        part, archive, counted, done = TaskContext.get().partitionId(), None, 0, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to", "revisit")]
            for page, url, html, digest, refers_to, revisit in zip(*columns, strict=True):
                if archive is None:
                    # Every attempt has files of its own; only those of the attempt that succeeded are listed.
                    archive = Archive(files, f"{root}/part-{part:05d}-{uuid.uuid4().hex}.warc.zst")
                payload = (html or "").encode("utf-8", "surrogatepass")
                archive.add(record(page, url, payload, digest, refers_to, revisit))
                counted += 1
                if archive.frames and archive.size >= archive_bytes:
                    archive.close()
                    done.append((archive.path, counted))
                    archive, counted = None, 0
        if archive:
            archive.close()
            done.append((archive.path, counted))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.rsplit("/", 1)[1] for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            ["archive", "n_records"],
        )

    return run


def _exactly(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends early: {len(data)} of {size} bytes")
    return data


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open archive; one record at a time is held."""
    magic, size = struct.unpack("<II", _exactly(stream, 8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame in front")
    raw = _exactly(stream, size)
    trained = raw[:4] == struct.pack("<I", 0xEC30A437)
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    data = b""
    while True:
        if not data and not (data := stream.read(1 << 18)):
            return
        frame = reader.decompressobj()  # ends where its frame does; what it was given beyond that begins the next one
        parts = [frame.decompress(data)]
        while not frame.eof:
            data = stream.read(1 << 18)
            if not data:
                raise ValueError("archive ends within a record")
            parts.append(frame.decompress(data))
        data = frame.unused_data
        whole = b"".join(parts)
        head, _, rest = whole.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = rest[: int(headers["Content-Length"])]
        if lines[0] != "WARC/1.1" or rest != block + b"\r\n\r\n":
            raise ValueError("not a record")
        yield headers, block


def _read_archives(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        rows: list[tuple] = []
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for headers, block in read_archive(stream):
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = headers["WARC-Type"] == "revisit"
                        if not revisit and hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
                        page, to = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                        rows.append((page and int(page), headers["WARC-Type"], None if revisit else len(block), digest,
                                     to and int(to), headers.get("WARC-Target-URI")))
                        if len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def shared_uri(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a URI that says which file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(path).toUri()
    system.mkdirs(path)
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of all pages in `folder` (a URI that all executors reach); returns (archive, n_records).

    `pages` has page_id, url and html; other columns are not read. A null html is an empty payload, a null url has no
    target header. Of equal payloads of at least DEDUP_BYTES the one with the largest page_id is the response (all
    rows with that id, should it repeat), the others are revisits. Without any id, or below that size, all are
    responses. An empty table writes no archive.
    """
    settings(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
        F.octet_length(html).alias("n_bytes"),
    )
    large = rows.filter(F.col("n_bytes") >= DEDUP_BYTES)
    repeated = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("response_id"))
    # Written out: one row per payload that repeats, so that a join can split the pages of one that is very frequent.
    repeated = write_stage(repeated.filter("n > 1 AND response_id IS NOT NULL").select("digest", "response_id"), "repeated")
    joined = rows.join(repeated.hint("shuffle_hash"), "digest", "left")
    is_revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    decided = joined.select("page_id", "url", "html", "digest", is_revisit.alias("revisit"),
                            F.when(is_revisit, F.col("response_id")).alias("refers_to"))
    return write_stage(decided.mapInArrow(_write_archives(folder, archive_bytes), "archive string, n_records long"), "archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the listed archives: page_id, record_type, payload_bytes, payload_digest, refers_to, target_uri.

    Responses are checked against their digest; the bytes of a revisit are those of the response that it refers to.
    """
    # The number is given, so that tasks are not joined because names are short: each has much to read.
    names = archives.select("archive").repartition(max(1, archives.count()), "archive")
    found = names.mapInArrow(
        _read_archives(folder),
        "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, target_uri string",
    )
    found = write_stage(found, "records")
    referred = found.filter("record_type = 'revisit'").select("payload_digest").distinct()
    responses = found.filter("record_type = 'response'").join(referred, "payload_digest", "left_semi")
    sizes = responses.groupBy("payload_digest").agg(F.max("payload_bytes").alias("whole_bytes"))
    sizes = write_stage(sizes, "payload-sizes")
    joined = found.join(sizes, "payload_digest", "left")
    return joined.select(
        "page_id", "record_type", F.coalesce("payload_bytes", "whole_bytes").alias("payload_bytes"), "payload_digest",
        "refers_to", "target_uri",
    )
