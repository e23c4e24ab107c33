"""Binary files that tasks write below a shared folder, on any file system that pyarrow can open by URI."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it that a URI or an absolute path names."""
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def committed(uri: str) -> Iterator[BinaryIO]:
    """A file to write that appears under its name only when complete.

    An attempt that dies leaves nothing under that name, and a repeated attempt replaces it whole.
    """
    system, path = opened(uri)
    folder, name = path.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    attempt = f"{folder}/_{uuid.uuid4().hex}-{name}"
    try:
        with system.open_output_stream(attempt, compression=None) as out:
            yield out
        system.move(attempt, path)
    except BaseException:
        with contextlib.suppress(OSError):
            system.delete_file(attempt)
        raise
