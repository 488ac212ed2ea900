"""WARC archives in Zstandard: one frame per record, dictionary in front.

An archive file starts with a skippable frame that holds the dictionary of
its records (absent if there were too few records to make one). Each record
is one frame. The writer trains the dictionary on the first records of a
file, at most ``DICTIONARY_SAMPLE`` bytes of them; the reader loads it from
the leading skippable frame and decodes frame by frame, holding one record at
a time, and checks the record's version line, required headers, lengths and
digests.

Records with equal payloads (same SHA-256) of at least ``min_revisit_bytes``
are written once: the one with the largest id is the response, the others are
revisits that refer to it and carry its HTTP header, whose Content-Length is
the length of the full payload. Writers and readers are tasks; a file is
written under a temporary name and renamed, so a repeated task replaces it.

Defined cases: a null payload counts as empty; a null id is written as an
empty id, read back as null, and is a response only where no equal payload
has an id; repeated rows that share the largest id are all responses; a null
URL is left out; line breaks in a URL are percent-encoded; an empty table
gives no file and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import staged
from quayside.session import scratch_path

# Frame magic numbers of the Zstandard format and of the
# dictionary frame of the .warc.zst convention; record fields of WARC 1.1.
FRAME_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

DICTIONARY_BYTES = 16 << 10
DICTIONARY_SAMPLE = 1 << 20
FILE_BYTES = 128 << 20  # of payload; then the next file is begun
READ_BYTES = 64 << 10
RECORD_URI = "urn:page:"
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, payload binary, archive string")
MAX_READ_TASKS = 10_000  # archives are read by one task each up to this many


class ArchiveError(ValueError):
    """An archive that is not as its format says."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                 date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One record. A revisit has the HTTP header of the full payload, and no body."""
    sha = digest(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<{RECORD_URI}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_URI}{refers_to}>")]
    else:
        block += payload
    fields += [("WARC-Payload-Digest", f"sha1:{sha}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields, type, ids, length, digest and payload of one record; raises
    ArchiveError where a header, length or digest is not right."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] != VERSION:
        raise ArchiveError("no version line or no end of the header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon or not name:
            raise ArchiveError(f"not a header line: {line[:80]!r}")
        fields[name] = value
    missing = [n for n in REQUIRED if n not in fields]
    if missing:
        raise ArchiveError(f"headers are missing: {missing}")
    if not fields["Content-Length"].isdigit():
        raise ArchiveError("the length is no number")
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError(f"block of {size} bytes announced, {len(rest) - 4} found")
    block = rest[:size]
    if fields.get("WARC-Block-Digest") != f"sha1:{digest(block)}":
        raise ArchiveError("the block's digest differs")
    http, sep, payload = block.partition(b"\r\n\r\n")
    length = [v for k, v in (x.split(b": ", 1) for x in http.split(b"\r\n")[1:]) if k == b"Content-Length"]
    kind, sha = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if not sep or len(length) != 1 or not length[0].isdigit():
        raise ArchiveError("no HTTP header, or no length in it")
    if kind == "response" and (len(payload) != int(length[0]) or digest(payload) != sha):
        raise ArchiveError("the payload's length or digest differs")
    if kind == "revisit" and (payload or fields.get("WARC-Profile") != REVISIT_PROFILE or "WARC-Refers-To" not in fields):
        raise ArchiveError("not a revisit by payload digest")
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"record type {kind}")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "payload_bytes": int(length[0]), "payload_digest": sha,
            "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def _page(uri: str) -> int | None:
    if not (uri.startswith(f"<{RECORD_URI}") and uri.endswith(">")):
        raise ArchiveError(f"not a record id: {uri[:80]}")
    number = uri[len(RECORD_URI) + 1:-1]
    return int(number) if number else None


class ArchiveWriter:
    """Writes records to a binary stream."""

    def __init__(self, out, level: int = 3):
        self.out, self.level, self.waiting, self.size, self.compress = out, level, [], 0, None

    def add(self, record: bytes) -> None:
        if self.compress:
            self.out.write(self.compress(record))
            return
        self.waiting.append(record)
        self.size += len(record)
        if self.size >= DICTIONARY_SAMPLE:
            self._begin()

    def _begin(self) -> None:
        import zstandard

        dictionary = None
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:DICTIONARY_SAMPLE] for r in self.waiting])
        except zstandard.ZstdError:
            pass  # too few or too small records: frames without a dictionary
        if dictionary:
            data = dictionary.as_bytes()
            self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        self.compress = zstandard.ZstdCompressor(level=self.level, dict_data=dictionary, write_content_size=True,
                                                 write_checksum=True).compress
        for record in self.waiting:
            self.out.write(self.compress(record))
        self.waiting = []

    def close(self) -> None:
        if not self.compress:
            self._begin()


def read_records(source) -> Iterator[bytes]:
    """The decoded frames of an archive, one after the other."""
    import zstandard

    data, dictionary = source.read(8), None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", data[4:])[0]
        held = source.read(size)
        if len(held) != size:
            raise ArchiveError("the dictionary frame is cut off")
        if held[:4] == struct.pack("<I", FRAME_MAGIC):  # the convention allows a compressed dictionary
            held = zstandard.ZstdDecompressor().decompress(held)
        dictionary, data = zstandard.ZstdCompressionDict(held), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    frame, parts = None, []
    while True:
        if not data:
            data = source.read(READ_BYTES)
            if not data:
                break
        if frame is None:
            frame, parts = decompressor.decompressobj(), []
        try:
            parts.append(frame.decompress(data))
        except zstandard.ZstdError as exc:
            raise ArchiveError(f"not a valid frame: {exc}") from exc
        data = b""
        if frame.eof:
            data, frame = frame.unused_data, None
            yield b"".join(parts)
    if frame is not None:
        raise ArchiveError("the last frame is cut off")


def _open(folder: str):
    """The file system of a folder's URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _uri(folder: str) -> str:
    """file:/x, as Hadoop writes it, as file:///x."""
    return "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder


def with_revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, record_type, refers_to). Only ids and digests are
    grouped; the longest text a shuffle moves once, keyed by its own row."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    key = rows.withColumn("payload", F.sha2(F.col("html").cast("binary"), 256))
    # read back, so that the join below deals both sides anew and a hot payload can be split
    response = staged(key.groupBy("payload").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
                      .filter("n > 1"), "warc-responses").select("payload", "response_id")
    long_enough = F.octet_length("html") >= min_revisit_bytes
    revisit = long_enough & F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return key.join(response, "payload", "left").select(
        "page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write a record per page into ``folder``; returns (archive, records) of the files."""
    folder = _uri(folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        task, number = TaskContext.get(), 0
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        row = next(rows, None)
        while row is not None:
            name = f"part-{task.partitionId():06d}-{number:04d}.warc.zst"
            unfinished = f"{base}/_{name}.{task.taskAttemptId()}"
            records = size = 0
            with system.open_output_stream(unfinished, compression=None) as out:
                writer = ArchiveWriter(out)
                while row is not None and size < FILE_BYTES:
                    payload = row.html.encode()
                    writer.add(record_bytes(_int(row.page_id), row.url, payload, _int(row.refers_to),
                                            row.record_type == "revisit"))
                    records, size, row = records + 1, size + len(payload), next(rows, None)
                writer.close()
            system.move(unfinished, f"{base}/{name}")
            yield pd.DataFrame({"archive": [f"{folder}/{name}"], "records": [records]})
            number += 1

    return with_revisits(pages, min_revisit_bytes).mapInPandas(write, "archive string, records long")


def _int(value) -> int | None:
    return None if pd.isna(value) else int(value)


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """The records of the files named in column ``archive``, decoded and checked."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for archive in batch["archive"]:
                system, path = _open(archive)
                held, size = [], 0
                with system.open_input_stream(path, compression=None) as source:
                    for data in read_records(source):
                        held.append(parse_record(data) | {"archive": archive})
                        size += len(data)
                        if size >= 4 << 20:
                            yield _frame(held, names)
                            held, size = [], 0
                if held:
                    yield _frame(held, names)

    return archives.select("archive").mapInPandas(read, RECORDS)


def _frame(held: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(held, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "llm-warc")
    files = staged(write_archives(pages, folder, min_revisit_bytes), "warc-files")
    # a number given here is kept by adaptive execution: one task per archive, several only where there are very many
    tasks = max(1, min(files.count(), MAX_READ_TASKS))
    return read_archives(spark, files.repartition(tasks)).drop("payload", "archive")
