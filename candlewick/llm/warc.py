"""WARC archives compressed record by record with a Zstandard dictionary.

The dictionary is built from records of the collection and stands, in a skippable frame, at the head of
every file, so that a file can be read alone. Each record is a frame of its own. A payload that occurs
again is written as a revisit of the first record.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import sliced, split_by
from candlewick.sources.storage import fresh_path, stored

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100  # of a payload that may be revisited
FILE_BYTES = 16 << 20  # compressed size at which the next file begins
READ = 1 << 16
DICTIONARY_BYTES = 64 << 10
SAMPLE_ROWS = 1000  # records, and bytes of each, that the dictionary is built from
SAMPLE_BYTES = 32 << 10
NAMES = uuid.UUID("6f0e7b3a-52c1-4d0a-9b0e-3f5b1d0c7a11")

RECORD = (
    "record_type string, record_id string, page_id long, url string, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary"
)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {digest}')}>"


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """A response record, or a revisit record if it refers to another page."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    block = http.encode() if refers_to is not None else http.encode() + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _clean(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Page-ID": page_id,
        "WARC-Profile": None if refers_to is None else REVISIT,
        "WARC-Refers-To": None if refers_to is None else _record_id(refers_to, digest),
        "WARC-Refers-To-Page-ID": refers_to,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in head.items() if v is not None]
    return b"\r\n".join([*lines, b"", block, b"", b""])


def parse_record(data: bytes) -> dict:
    """The columns of RECORD from one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"no WARC record: {version[:20]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
    whole = fields["WARC-Type"] == "response"
    if whole and size != len(payload):
        raise ValueError("a payload is cut off")
    number = {k: int(fields[k]) if k in fields else None for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID")}
    return {
        "record_type": fields["WARC-Type"],
        "record_id": fields["WARC-Record-ID"],
        "page_id": number["WARC-Page-ID"],
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "refers_to": number["WARC-Refers-To-Page-ID"],
        "payload": payload if whole else None,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where the samples are too few for training, their own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def frames(data: bytes) -> Iterator[bytes]:
    """The records of a file, one after the other."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the file does not begin with a dictionary")
    at = 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:at]))
    while at < len(data):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the file is cut off")
            piece = data[at : at + READ]
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(parts)


def _planned(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, digest, refers_to); only repeated payloads are shuffled."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least_bytes)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = stored(first.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-first")
    maybe, rest = split_by(rows, first, "digest")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    maybe = maybe.join(first, "digest", "left").withColumn("refers_to", refers).drop("first")
    rest = rest.withColumn("refers_to", F.lit(None).cast("long"))
    return rest.unionByName(maybe).select("page_id", "url", "payload", "digest", "refers_to")


def _sample(rows: DataFrame, date: str) -> list[bytes]:
    """A bounded sample of records, chosen by hash, for the dictionary."""
    total = rows.count()
    draw = F.pmod(F.xxhash64("page_id", "digest"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.filter(draw <= 2 * SAMPLE_ROWS / max(total, 1)).limit(SAMPLE_ROWS)
    cut = F.expr(f"substring(payload, 1, {SAMPLE_BYTES})").alias("payload")
    return [
        record(r.page_id, r.url, bytes(r.payload), r.digest, r.refers_to, date)
        for r in some.select("page_id", "url", cut, "digest", "refers_to").collect()
    ]


def write_archives(
    pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """Write `pages` (page_id, url, html, any other columns) as .warc.zst files; returns (path, records, bytes).

    One record a row, the payload being html in UTF-8 (null: empty). Of rows with equal payloads of at least
    `least_bytes` bytes, that with the smallest page_id is a response and the others revisit it; all rows
    that repeat this page_id are responses, and so are all if none has a page_id. Null ids and urls are left
    out of the record. No rows give no files. `folder` is one that all tasks reach. A task that runs again
    writes files of other names; only files that are listed here belong to the archive.
    """
    rows = _planned(pages, least_bytes)
    dictionary = build_dictionary(_sample(rows, date))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        kind = zstandard.ZstdCompressionDict(dictionary)
        writer = zstandard.ZstdCompressor(level=3, dict_data=kind, write_checksum=True)
        out, size, count, number, done = None, 0, 0, 0, []
        for batch in sliced(batches):
            for page_id, url, payload, digest, refers_to in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if out is None:
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number}.warc.zst"
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(dictionary_frame(dictionary))
                    size, count, number = 8 + len(dictionary), 0, number + 1
                frame = writer.compress(record(page_id, url, payload, digest, refers_to, date))
                out.write(frame)
                size, count = size + len(frame), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        yield pa.RecordBatch.from_pydict(
            {
                "path": pa.array([f"{folder}/{name}" for name, _, _ in done], pa.string()),
                "records": pa.array([n for _, n, _ in done], pa.int64()),
                "bytes": pa.array([n for _, _, n in done], pa.int64()),
            }
        )

    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-files")


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the files (path, any other columns) as RECORD columns; without `payloads` these are null.

    The list of files stays a table: tasks open the files of their rows. A file is read whole by one task; its size is
    bounded by the writer. Broken files raise. No files, no rows.
    """
    schema = pa.schema([
        ("record_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = pyarrow.fs.FileSystem.from_uri(path)
                with store.open_input_stream(name, compression=None) as source:
                    content = source.read()
                rows, size = [], 0
                for data in frames(content):
                    row = parse_record(data)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > READ << 6:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # By number, as a path is far smaller than what it names.
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(parts, "path").mapInArrow(run, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to a new folder among the shared ones and read their records back, without payloads."""
    files = write_archives(pages, fresh_path(pages.sparkSession, "warc"))
    return read_archives(files, payloads=False)
