"""Files in a store, from driver and executors: the store is told by the path's scheme."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyarrow import fs

from tidemark.errors import InputError


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain local path."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def files_below(uri: str) -> list[tuple[str, int]]:
    """(path, size) of the files in a folder, or of the one file, by name; names that begin with a dot or underscore are left out."""
    system, path = open_fs(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [(uri, info.size)]
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    base = uri.rstrip("/")
    return sorted((f"{base}/{f.base_name}", f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")


def paths_below(uri: str) -> Iterator[str]:
    """Paths of the files in a folder and its folders key=value, or of the one file, in any order; names that begin with a dot or underscore are left out.

    The names of a local or mounted folder come one at a time; other stores list a folder at once.
    """
    system, path = open_fs(uri)
    kind = system.get_file_info(path).type
    if kind == fs.FileType.NotFound:
        raise InputError(f"no such file or folder: {uri}")
    if kind == fs.FileType.File:
        yield uri
        return
    base = uri.rstrip("/")
    if isinstance(system, fs.LocalFileSystem):
        found = ((f.name, f.is_file(), f.is_dir()) for f in os.scandir(path))
    else:
        found = ((f.base_name, f.type == fs.FileType.File, f.type == fs.FileType.Directory) for f in system.get_file_info(fs.FileSelector(path)))
    for name, file, folder in found:
        if name[0] in "._":
            continue
        if file:
            yield f"{base}/{name}"
        elif folder and "=" in name:
            yield from paths_below(f"{base}/{name}")


def read_range(uri: str, start: int, size: int) -> bytes:
    system, path = open_fs(uri)
    with system.open_input_file(path) as file:
        return file.read_at(size, start)


def ranges(files: list[tuple[str, int]], size: int) -> Iterator[tuple[str, int, int]]:
    """(path, start, end) of pieces of at most ``size`` bytes; an empty file has one empty piece."""
    for path, length in files:
        for start in range(0, max(length, 1), size):
            yield path, start, min(start + size, length)
