"""Files that tasks write into and read from the shared folder, through pyarrow's file systems."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    local = re.sub(r"^file:(?://(?=/))?", "", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


def create(path: str) -> pa.NativeFile:
    system, at = located(path)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    return system.open_output_stream(at)


def contents(path: str):
    """What a file holds: memory-mapped, so never copied, if it is local to the shared folder's mount; else read once."""
    system, at = located(path)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(at)
    with system.open_input_file(at) as file:
        return pa.BufferReader(file.readall())


def remove(path: str) -> None:
    system, at = located(path)
    system.delete_file(at)
