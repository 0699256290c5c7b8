"""Files that tasks write to and read from the shared folder themselves."""

from __future__ import annotations


def place(path: str):
    """File system and path in it. Folders without a scheme, or with `file:`, are those of a mounted disk."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))
