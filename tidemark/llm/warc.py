"""WARC archives in Zstandard: written by tasks, read back through Spark's file reader.

An archive begins with a skippable frame (magic 0x184D2A5D) holding the dictionary; then
each record is a frame of its own, compressed with it. Of records with equal payloads of
``REVISIT_BYTES`` or more, that of the largest page_id is the response; the others are
revisits that refer to it and hold the response's HTTP header only. The reader takes the
dictionary from the leading frame, finds frames by their block headers, and checks
versions, required headers, lengths and digests; a damaged archive raises.

Archives are written under their final names only once complete, with names and contents
that a repeated task makes again, so lost executors leave no doubles. The folder is one
all executors share; it is reached through pyarrow's file systems for writing.

Defined results: a NULL or empty html is an empty payload, a NULL url a blank one. Page_ids
may be NULL: such a record is written, and is a response unless it repeats one with an id.
Repeated rows of the largest page_id are all responses. An empty table writes no archive.
Line breaks in a url are percent-encoded. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready, shared_folder

REVISIT_BYTES = 1000
#: Compressed bytes from which the next record goes to a new archive.
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
DICTIONARY_BYTES = 32 << 10
#: Pages that the dictionary is trained on, and how much of each.
SAMPLE_PAGES = 300
SAMPLE_CHARS = 8 << 10

_SKIPPABLE = 0x184D2A5D
_FRAME = 0xFD2FB528
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "<urn:page:{}>"
_DATE = "2024-01-01T00:00:00Z"
_REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of page ``refers_to``."""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _ID.format("" if page_id is None else page_id)),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", _digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _ID.format(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, payload length and stored payload of exactly one valid record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    missing = [name for name in _REQUIRED if name not in headers]
    if missing:
        raise ValueError(f"headers missing: {missing}")
    if int(headers["Content-Length"]) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the record's length is not that of its header")
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if headers["WARC-Type"] == "response":
        if size != len(payload) or _digest(payload) != headers["WARC-Payload-Digest"]:
            raise ValueError("the payload is not that of its headers")
    elif headers["WARC-Type"] != "revisit" or payload or "WARC-Refers-To" not in headers:
        raise ValueError("not a valid revisit")
    return headers, size, payload


def frames(data: bytes) -> Iterator[tuple[int, int]]:
    """Bounds of an archive's frames, found by their block headers."""
    at = 0
    while at < len(data):
        start = at
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + size
        elif magic == _FRAME:
            at += zstandard.frame_header_size(data[at : at + 18])
            last = 0
            while not last:
                header = int.from_bytes(data[at : at + 3], "little")
                last, kind = header & 1, header >> 1 & 3
                at += 3 + (1 if kind == 1 else header >> 3)
            at += 4 * zstandard.get_frame_parameters(data[start : start + 18]).has_checksum
        else:
            raise ValueError("not a Zstandard frame")
        if at > len(data):
            raise ValueError("the archive is cut short")
        yield start, at


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """The records of an archive."""
    dictionary = None
    for number, (start, end) in enumerate(frames(data)):
        if struct.unpack_from("<I", data, start)[0] != _FRAME:
            if number == 0 and struct.unpack_from("<I", data, start)[0] == _SKIPPABLE and end - start > 8:
                dictionary = zstandard.ZstdCompressionDict(data[start + 8 : end])
            continue
        reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
        yield parse_record(reader.decompress(data[start:end]))


def _dictionary(pages: DataFrame) -> bytes:
    """A dictionary trained on a bounded sample; empty if there is too little of it."""
    chosen = (
        pages.where("html <> ''")
        .select("page_id")
        .distinct()
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(SAMPLE_PAGES)
    )
    sample = (
        pages.join(F.broadcast(chosen), "page_id")
        .select("page_id", F.substring("html", 1, SAMPLE_CHARS).alias("html"))
        .dropDuplicates(["page_id"])
        .orderBy("page_id")
        .collect()
    )
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r["html"].encode() for r in sample]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _linked(pages: DataFrame) -> DataFrame:
    """page_id, url, html and the page each one revisits."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"),
        "url",
        html.alias("html"),
        F.when(F.octet_length(html) >= REVISIT_BYTES, F.sha1(html)).alias("digest"),
    )
    repeated = (
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    return rows.join(repeated, "digest", "left").select(
        "page_id",
        "url",
        "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` to archives in ``folder`` when run; a row for each
    archive: name and records."""
    dictionary = _dictionary(pages)

    def write(frames_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        if dictionary:
            own = zstandard.ZstdCompressionDict(dictionary)
            compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=own)
        else:
            compressor = zstandard.ZstdCompressor(level=LEVEL)
        head = struct.pack("<II", _SKIPPABLE, len(dictionary)) + dictionary
        task, done = TaskContext.get(), []
        parts, held, count = [head], len(head), 0

        def close() -> None:
            nonlocal parts, held, count
            name = f"part-{task.partitionId():06d}-{len(done):04d}.warc.zst"
            passing = f"{root}/.{name}.{task.taskAttemptId()}"
            with files.open_output_stream(passing) as stream:
                for part in parts:
                    stream.write(part)
            files.move(passing, f"{root}/{name}")
            done.append((name, count))
            parts, held, count = [head], len(head), 0

        for frame in frames_:
            for page_id, url, html, refers_to in frame.itertuples(index=False):
                page_id = None if pd.isna(page_id) else int(page_id)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                parts.append(compressor.compress(record(page_id, url, html.encode(), refers_to)))
                held += len(parts[-1])
                count += 1
                if held >= ARCHIVE_BYTES:
                    close()
        if count:
            close()
        yield pd.DataFrame(done, columns=["name", "records"])

    return (
        _linked(ready(pages))
        .sortWithinPartitions("page_id", "url", "html")  # a repeated task writes the same
        .mapInPandas(write, "name string, records long")
    )


def read_archives(spark, folder: str) -> DataFrame:
    """A row for each record of the archives in ``folder``."""

    def read(frames_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_:
            for content in frame["content"]:
                rows = []
                for headers, size, payload in read_archive(content):
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    revisit = headers["WARC-Type"] == "revisit"
                    rows.append(
                        (
                            _page(headers["WARC-Record-ID"]),
                            headers.get("WARC-Target-URI"),
                            size,
                            digest,
                            headers["WARC-Type"],
                            _page(headers["WARC-Refers-To"]) if revisit else None,
                            None if revisit else payload.decode(),
                        )
                    )
                    if len(rows) >= 500:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    archives = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.zst").load(folder).select("content")
    )
    return archives.mapInPandas(
        read,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload string",
    )


_COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS).astype({"page_id": "Int64", "refers_to": "Int64"})


def _page(record_id: str) -> int | None:
    text = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to a new folder of archives, and what is read back from them."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    written = write_archives(pages, folder).agg(F.sum("records").alias("n")).first()["n"]
    if not written:
        return spark.createDataFrame(
            [],
            "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long, payload string",
        )
    return read_archives(spark, folder)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, cast(octet_length(encode(html)) AS bigint) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS latest FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM latest AND latest IS NOT NULL
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM m
"""
