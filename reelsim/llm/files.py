"""Raw files in any store that Arrow's file systems reach, for tasks."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager


def open_store(uri: str):
    """``(file system, path)``; ``file:/x`` and bare paths are local files."""
    from pyarrow import fs
    if re.match(r"file:/(?!//)", uri):
        uri = "file:///" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def whole_file(uri: str):
    """Write a file that appears under its name only when complete, so a
    task that runs twice leaves one whole file; a task that fails takes its
    part away."""
    store, path = open_store(uri)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    store.create_dir(path.rpartition("/")[0], recursive=True)
    try:
        with store.open_output_stream(part, compression=None) as out:
            yield out
    except BaseException:
        store.delete_file(part)
        raise
    store.move(part, path)
