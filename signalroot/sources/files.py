"""Files opened by tasks, on whatever file system their path names."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyarrow import fs

CHUNK_BYTES = 1 << 20


def _local(path: str) -> str | None:
    """A local path without its scheme; None if another file system is meant. Paths are as Hadoop prints them, nothing is escaped."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", path) else path


@lru_cache(16)
def _system(root: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(root)[0]


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it). Connections are kept by scheme and authority."""
    local = _local(path)
    if local is not None:
        return fs.LocalFileSystem(), local
    root = re.match(r"[^:]+://[^/]*", path).group()
    return _system(root + "/"), fs.FileSystem.from_uri(path)[1]


def reachable(path: str) -> bool:
    """Whether Arrow knows the path's file system; Spark's own readers may know others."""
    try:
        resolve(path)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def read(path: str, start: int = 0, size: int | None = None) -> bytes:
    """Bytes from `start` on, `size` of them at most; the rest of the file isn't read."""
    system, inner = resolve(path)
    with system.open_input_file(inner) as f:
        f.seek(min(start, f.size()))
        return f.read(size) if size is not None else f.read()


def size(path: str) -> int:
    system, inner = resolve(path)
    found = system.get_file_info(inner)
    if found.type != fs.FileType.File:
        raise FileNotFoundError(path)
    return found.size


def chunks(path: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A file of any size, piece by piece."""
    system, inner = resolve(path)
    with system.open_input_stream(inner) as f:
        while block := f.read(chunk_bytes):
            yield block
