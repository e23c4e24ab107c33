"""Parquet files that tasks write themselves, on any file system that pyarrow opens by URI."""

from __future__ import annotations

import contextlib
import uuid

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq


class ParquetFile:
    """A file to write batches to, which appears under its name when it is closed without an error.

    An attempt that dies leaves nothing under that name, and a repeated attempt replaces it whole.
    """

    def __init__(self, uri: str, schema: pa.Schema, rows_per_group: int = 65_536):
        self.files, self.path = fs.FileSystem.from_uri(uri)
        folder, name = self.path.rsplit("/", 1)
        self.schema, self.most, self.held, self.n = schema, rows_per_group, [], 0
        self.attempt = f"{folder}/_{uuid.uuid4().hex}-{name}"

    def __enter__(self) -> ParquetFile:
        self.files.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = pq.ParquetWriter(self.attempt, self.schema, filesystem=self.files, compression="snappy")
        return self

    def write(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.n += batch.num_rows
        if self.n >= self.most:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            self.out.write_table(pa.Table.from_batches(self.held, self.schema))
            self.held, self.n = [], 0

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None:
            self._flush()
            self.out.close()
            self.files.move(self.attempt, self.path)
            return
        with contextlib.suppress(OSError):
            self.out.close()
            self.files.delete_file(self.attempt)
