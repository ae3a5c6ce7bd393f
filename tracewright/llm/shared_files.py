"""Files that tasks write and read in a folder all executors share, by URI."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of ``scheme://host/path``, ``file:/path`` or a plain path."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_atomically(uri: str, data: bytes, attempt: int) -> None:
    """Writes under a name of this attempt, then renames: a reader sees the whole file or none."""
    system, path = _place(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}.{attempt}"
    with system.open_output_stream(own) as out:
        out.write(data)
    system.move(own, path)


class Appender:
    """A file written bit by bit under a name of its attempt and renamed when closed."""

    def __init__(self, uri: str, attempt: int):
        self.system, self.path = _place(uri)
        folder, _, name = self.path.rpartition("/")
        self.system.create_dir(folder, recursive=True)
        self.own = f"{folder}/.{name}.{attempt}"
        self.out = self.system.open_output_stream(self.own)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.system.move(self.own, self.path)


def open_input(uri: str) -> bytes:
    system, path = _place(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def open_random(uri: str) -> pa.NativeFile:
    system, path = _place(uri)
    return system.open_input_file(path)


def listed(uri: str, suffix: str) -> list[tuple[str, int]]:
    """``(uri, bytes)`` of the finished files of a folder, by name."""
    system, path = _place(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = [(f.base_name, f.size) for f in found if f.base_name.endswith(suffix) and not f.base_name.startswith(".")]
    return sorted((f"{uri.rstrip('/')}/{name}", size) for name, size in names)
