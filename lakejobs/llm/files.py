"""Arrays in files of the shared folder: tasks write them, workers map them into memory."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    """Write arrays one after the other to a new file; a task that is repeated writes another one."""
    system, at = _filesystem(folder)
    system.create_dir(at, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{at}/{name}") as out:
        for x in arrays:
            out.write(memoryview(np.ascontiguousarray(x)).cast("B") if x.size else b"")
    return f"{folder}/{name}"


@lru_cache(maxsize=4096)
def mapped(path: str) -> np.ndarray:
    """The file's bytes, mapped into memory; of a store that is not a file system, those of a copy."""
    from pyarrow import fs

    system, at = _filesystem(path)
    if not isinstance(system, fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), os.path.basename(at))
        if not os.path.exists(local):
            part = f"{local}.{os.getpid()}"
            fs.copy_files(at, part, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
            os.replace(part, local)
        at = local
    return np.memmap(at, np.uint8, "r") if os.path.getsize(at) else np.zeros(0, np.uint8)


def sections(path: str, *shapes: tuple[type, int]) -> list[np.ndarray]:
    """The arrays of a file, by kind and size."""
    data, at, out = mapped(path), 0, []
    for kind, n in shapes:
        size = np.dtype(kind).itemsize * n
        out.append(data[at : at + size].view(kind))
        at += size
    return out
