"""File systems by path, on the driver and in tasks."""

from __future__ import annotations

from pyarrow import fs


def filesystem_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
