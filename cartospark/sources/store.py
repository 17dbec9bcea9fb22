"""Files that Python workers read by ranges: local ones, and those of the stores that Arrow knows."""

from __future__ import annotations


def opened(path: str):
    """A seekable file of a path or url; an error for a store that Arrow has no reader for."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(path)
    store, inner = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return store.open_input_file(inner)
