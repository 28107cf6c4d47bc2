"""Paths as Spark lists them, opened in an executor."""

from __future__ import annotations

from urllib.parse import quote

# Spark names of stores -> pyarrow's
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store_uri(path: str) -> str:
    """``path`` as a URI that pyarrow parses: percent-encoded, with pyarrow's scheme name."""
    scheme, rest = path.split("://", 1)
    return f"{_SCHEMES.get(scheme, scheme)}://{quote(rest, safe='/:@')}"


def filesystem_of(path: str):
    """``(filesystem, inner path)`` of a listed path in any store that pyarrow knows."""
    from pyarrow import fs as pafs  # imported in the executor

    return pafs.FileSystem.from_uri(store_uri(path))


def local_path(path: str) -> str | None:
    """The local file name of a listed path, None for other stores.  Listed paths are not encoded."""
    if path.startswith("file:"):
        return path[len("file:"):]
    return None if "://" in path else path


def open_path(path: str, *, seek: bool = False):
    """Open a listed path for reading, for random access with ``seek``."""
    local = local_path(path)
    if local is not None:
        return open(local, "rb")
    filesystem, inner = filesystem_of(path)
    return filesystem.open_input_file(inner) if seek else filesystem.open_input_stream(inner)
