"""WARC archives of individually compressed records that share a Zstandard dictionary.

Every file starts with a skippable frame that holds its dictionary, trained on the first records archived in it (up
to ``sample_bytes``); each record is a frame of its own, so it can be read alone given the dictionary and its place.

Defined results: a null payload counts as empty; of equal payloads of at least ``min_bytes`` the row with the largest
page id is the response and the others revisit it; of rows that repeat that id too, one is the response; null ids
count as smallest; an empty table writes no file; columns other than id, url and payload are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import committed, opened
from .shared import join_groups, scratch, staged, text_or_empty

# Fixed values of the WARC and WARC-Zstandard formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "page_id long, path string, offset long, length long, record_type string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}{f':{copy}' if copy else ''}>"


def record(page_id: int | None, url: str | None, payload: bytes, date: str, revisit: bool, refers_to: int | None, copy: int) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the payload's length, and leaves out the payload."""
    digest = base32_sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=''.join(map(chr, range(0x21, 0x7F))))}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines[2:2] = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records, or None where they are too few to make one."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8) if len(samples) >= 8 else None
    except zstandard.ZstdError:
        return None


def write_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", dictionary_bytes: int = 65536, sample_bytes: int = 4_000_000, level: int = 3, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the archives and return their index, a row for each record: page_id, path, offset, length, record_type.

    Which record a payload's copies refer to is settled on digests alone; pages are shuffled once, by id and digest,
    which no group of copies makes uneven.
    """
    folder = path or scratch(pages.sparkSession, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), text_or_empty(payload_col).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("_id", F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    narrow = staged(rows.select("_id", "page_id", "digest", F.octet_length("payload").alias("size")), "payload_digests")
    groups = narrow.filter(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
    groups = staged(groups.filter("copies > 1"), "payload_groups")
    known = join_groups(narrow.filter(F.col("size") >= min_bytes).select("_id", "digest").distinct(), groups, "digest", "copies").withColumn("shared", F.lit(True)).drop("copies")
    ready = rows.repartition("_id", "digest").join(known, ["_id", "digest"], "left").sortWithinPartitions("_id", "digest")
    ready = ready.select("page_id", "url", "payload", "digest", "refers_to", F.coalesce("shared", F.lit(False)).alias("shared"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found = _records(batches, date)
        size = 0
        for item in found:
            held.append(item)
            size += len(item[2])
            if size >= sample_bytes:
                break
        if not held:
            return
        trained = train([x[2] for x in held], dictionary_bytes)
        packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
        uri = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.zst"
        index: list[tuple] = []
        with committed(uri) as out:
            at = 0
            if trained:
                at = out.write(struct.pack("<II", DICTIONARY_MAGIC, len(trained.as_bytes())) + trained.as_bytes())
            for items in (held, found):
                for page_id, kind, data in items:
                    frame = packer.compress(data)
                    out.write(frame)
                    index.append((page_id, uri, at, len(frame), kind))
                    at += len(frame)
                held.clear()
        for k in range(0, len(index), 10_000):
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index[k : k + 10_000]), kinds)], names=["page_id", "path", "offset", "length", "record_type"])

    return staged(ready.mapInArrow(write, INDEX_SCHEMA), "warc_index")


def _records(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[tuple[int | None, str, bytes]]:
    """Records in sorted order; ``copy`` counts rows that repeat id and payload."""
    last, copy = None, 0
    for batch in batches:
        for page_id, url, payload, digest, refers_to, shared in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to", "shared"))):
            page, key = page_id.as_py(), (page_id.as_py(), digest.as_py())
            copy = copy + 1 if key == last else 0
            last = key
            revisit = shared.as_py() and (copy > 0 or page != refers_to.as_py())
            yield page, "revisit" if revisit else "response", record(page, url.as_py(), payload.as_py(), date, revisit, refers_to.as_py(), copy)


def read_archive(uri: str) -> Iterator[dict]:
    """Every record of one file: page_id, url, record_type, refers_to, payload (None for a revisit), payload_bytes,
    payload_digest. A response whose payload doesn't have the digest in its header is an error."""
    system, path = opened(uri)
    with system.open_input_file(path) as file:
        magic, size = struct.unpack("<II", file.read(8))
        held = zstandard.ZstdCompressionDict(file.read(size)) if magic == DICTIONARY_MAGIC else None
        if held is None:
            file.seek(0)
        with zstandard.ZstdDecompressor(dict_data=held).stream_reader(file, read_across_frames=True, closefd=False) as plain:
            stream = io.BufferedReader(plain, 1 << 17)
            while line := stream.readline():
                if line != b"WARC/1.1\r\n":
                    raise ValueError(f"{uri}: a record starts with {line[:20]!r}")
                fields = _fields(stream)
                block = stream.read(int(fields["Content-Length"]))
                stream.read(4)
                head, _, body = block.partition(b"\r\n\r\n")
                http = _fields(io.BytesIO(head.partition(b"\r\n")[2] + b"\r\n\r\n"))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and base32_sha1(body) != digest:
                    raise ValueError(f"{uri}: a payload of {fields['WARC-Record-ID']} is damaged")
                yield {
                    "page_id": _page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
                    "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else body,
                    "payload_bytes": int(http["Content-Length"]), "payload_digest": digest,
                }


def _fields(stream: io.BufferedIOBase) -> dict[str, str]:
    out: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        out[name] = value.strip()
    return out


def _page(uri: str) -> int | None:
    name = uri.split(":")[2]
    return None if name == "none" else int(name)


def read_archives(index: DataFrame, tasks: int | None = None) -> DataFrame:
    """All records of the archives that ``index`` names; a task reads one file at a time."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["path"].to_pylist():
                held, size = [], 0
                for item in read_archive(uri):
                    held.append(item)
                    size += len(item["payload"] or b"")
                    if size > 4_000_000 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = index.select("path").distinct().repartition(tasks or max(1, index.sparkSession.sparkContext.defaultParallelism * 2), "path")
    return files.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")
