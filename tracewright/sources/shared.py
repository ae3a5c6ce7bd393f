"""Small files in a folder that the driver and all executors share, by URI; readers see each file whole or not at all."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of ``scheme://host/path``, ``file:/path`` or a plain path."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def listed(uri: str, suffix: str = "") -> list[str]:
    """Names of the finished files of a folder, in order; none if the folder is not there."""
    system, path = place(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.endswith(suffix) and not f.base_name.startswith("."))


def remove(uri: str) -> None:
    """Removes a file, if it is there."""
    system, path = place(uri)
    if system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)


class Records:
    """Named JSON records of a folder, each written once: what is there already stays as it is."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")

    def get(self, name: str) -> dict | None:
        system, path = place(f"{self.uri}/{name}.json")
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as f:
            return json.loads(f.read())

    def add(self, name: str, record: dict) -> dict:
        """The record that stands under ``name`` from now on: this one, or the one before it."""
        there = self.get(name)
        if there is not None:
            return there
        system, path = place(f"{self.uri}/{name}.json")
        folder = path.rpartition("/")[0]
        system.create_dir(folder, recursive=True)
        own = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(own) as f:
            f.write(json.dumps(record).encode())
        system.move(own, path)
        return record

    def all(self) -> dict[str, dict]:
        names = [n.removesuffix(".json") for n in listed(self.uri, ".json")]
        return {n: self.get(n) for n in names}
