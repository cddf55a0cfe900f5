"""Arrays in files of the shared folder, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def put(uri: str, array: np.ndarray) -> None:
    """Write under a name of its own, then rename, so that a task that runs again or twice does no harm."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    mine = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(mine) as out:
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"")
    system.move(mine, path)


def mapped(uri: str, kind: str) -> np.ndarray:
    """The array, mapped. A file that is not on a mounted file system is copied to an unnamed local file first."""
    system, path = fs.FileSystem.from_uri(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with system.open_input_stream(path) as source, tempfile.TemporaryFile() as local:
        while block := source.read(1 << 22):
            local.write(block)
        local.flush()
        return np.memmap(local, kind, "r") if local.tell() else np.zeros(0, kind)
