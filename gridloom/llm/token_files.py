"""Token-id files in the seekable Zstandard format.

A file holds, in ascending id order, one independent frame for each document (its ids, little-endian, two bytes each
where the vocabulary allows and four else, with the frame's own content checksum), a skippable frame with the
documents' ids, and the trailing seek table with sizes and a checksum for each frame. A reader fetches the table and
then decompresses only the frames it was asked for.

Defined results: a null text counts as empty and is stored as the end id alone; null document ids come first; rows
that repeat an id keep a frame each; an empty table writes no file. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .files import committed, opened
from .shared import scratch, staged
from .tokens import encoder

# Fixed values of the Zstandard seekable format.
SKIPPABLE, SEEK_MAGIC, TABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")]), struct.Struct("<IBI")


class FrameWriter:
    """Frames of one file, one for each document."""

    def __init__(self, out, width: int, level: int = 1):
        self.out, self.width = out, width
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: unsigned 32-bit little-endian."""
        plain = np.frombuffer(ids, "<u4").astype("<u2").tobytes() if self.width == 2 else ids
        packed = self.packer.compress(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.ids.append(doc_id)

    def close(self) -> int:
        """Write what follows the frames; the number of token ids in the file."""
        present = np.array([x is not None for x in self.ids], np.uint8)
        values = np.array([x or 0 for x in self.ids], "<i8")
        index = self.packer.compress(struct.pack("<BI", self.width, len(self.ids)) + present.tobytes() + values.tobytes())
        table = np.array([*self.entries, (len(index) + 8, 0, 0)], ENTRY)
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.out.write(struct.pack("<II", SEEK_MAGIC, table.nbytes + FOOTER.size) + table.tobytes() + FOOTER.pack(len(table), WITH_CHECKSUMS, TABLE_MAGIC))
        return int(table["plain"].sum()) // self.width


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        n, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != TABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError(f"{uri} has no seek table")
        self.table = np.frombuffer(self.file.read_at(n * ENTRY.itemsize, size - FOOTER.size - n * ENTRY.itemsize), ENTRY)
        self.offsets = np.concatenate(([0], np.cumsum(self.table["packed"].astype(np.int64))))
        self.unpacker = zstandard.ZstdDecompressor()
        index = self.unpacker.decompress(self.file.read_at(int(self.table["packed"][-1]) - 8, int(self.offsets[-2]) + 8))
        self.width, self.n = struct.unpack_from("<BI", index)
        self.present = np.frombuffer(index, np.uint8, self.n, 5).astype(bool)
        self.doc_ids = np.frombuffer(index, "<i8", self.n, 5 + self.n)
        self.starts = np.concatenate(([0], np.cumsum(self.table["plain"][:-1].astype(np.int64) // self.width)))

    def ids(self, k: int) -> bytes:
        """The ids of the file's k-th document as unsigned 32-bit integers; only its frame is fetched."""
        packed, plain, check = self.table[k]
        got = self.unpacker.decompress(self.file.read_at(int(packed), int(self.offsets[k])), max_output_size=int(plain))
        if xxhash.xxh64_intdigest(got) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(got, "<u2").astype("<u4").tobytes() if self.width == 2 else got

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` and return the manifest: part, path, n_docs, n_tokens, base (ids in earlier files).

    Documents are range-partitioned and sorted by id, and every task streams its range into one file, so memory
    holds a batch of texts and a table entry for each document of the file. The manifest has a row for each file.
    """
    spark = docs.sparkSession
    folder = path or scratch(spark, "token_files")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    by = F.col("doc_id").asc_nulls_first()
    rows = (rows.repartitionByRange(files, by) if files else rows.repartitionByRange(by)).sortWithinPartitions(by)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        width = 2 if max(encode.size, end_id + 1) <= 1 << 16 else 4
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        with committed(uri := f"{folder}/part-{part:06d}.tok.zst") as out:
            writer = FrameWriter(out, width)
            batch = first
            while batch is not None:
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode.encode_all(x.as_py() for x in batch["text"])):
                    writer.add(doc_id, ids + end)
                batch = next(batches, None)
            total = writer.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [uri], "n_docs": [len(writer.ids)], "n_tokens": [total]})

    manifest = staged(rows.mapInArrow(write, "part long, path string, n_docs long, n_tokens long"), "token_manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def read_token_files(manifest: DataFrame, wanted: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """(doc_id, start, ids binary: unsigned 32-bit little-endian) of all documents, or of the ids in ``wanted``.

    A task reads one file at a time. With ``wanted`` (doc_id) each file gets the list of its own documents, found
    by the id ranges; only their frames are decompressed.
    """
    spark: SparkSession = manifest.sparkSession
    files = manifest.select("path", "base").repartition(tasks or max(1, spark.sparkContext.defaultParallelism * 2), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = batch["keys"].to_pylist() if "keys" in batch.schema.names else [None] * batch.num_rows
            for uri, base, keys in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), picked):
                reader = FrameReader(uri)
                chosen = range(reader.n) if keys is None else np.flatnonzero(reader.present & np.isin(reader.doc_ids, keys)).tolist()
                found, held = [], 0
                for k in chosen:
                    found.append((int(reader.doc_ids[k]) if reader.present[k] else None, base + int(reader.starts[k]), reader.ids(k)))
                    held += len(found[-1][2])
                    if held > 8_000_000:
                        yield _rows(found)
                        found, held = [], 0
                if found:
                    yield _rows(found)
                reader.close()

    if wanted is not None:
        keys = wanted.select(F.col("doc_id").cast("long").alias("k")).dropna().distinct()
        spans = staged(manifest.select("path", "base").mapInArrow(_spans, "path string, base long, low long, high long"), "token_spans")
        files = spans.join(keys, F.col("k").between(F.col("low"), F.col("high"))).groupBy("path", "base").agg(F.collect_list("k").alias("keys"))
    return files.mapInArrow(read, "doc_id long, start long, ids binary")


def _rows(found: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["doc_id", "start", "ids"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for uri, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
            reader = FrameReader(uri)
            ids = reader.doc_ids[reader.present]
            if len(ids):
                out.append({"path": uri, "base": base, "low": int(ids.min()), "high": int(ids.max())})
            reader.close()
        yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("base", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))
