"""File systems behind paths, for readers that seek."""
from __future__ import annotations

import re

import pyarrow.fs as pafs


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address and the path there."""
    if re.match(r"file:/(?!//)", path):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
