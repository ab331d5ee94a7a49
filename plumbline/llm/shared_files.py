"""Binary files in a folder that driver and executors share, through the store that its address names."""

from __future__ import annotations

import posixpath
import uuid

import pyarrow.fs as pafs

from plumbline.llm.common import shipped


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """A stream that gets its name only once it is complete, so a lost task leaves no half file under it.

    A repeated task writes the same bytes under the same name again.
    """

    def __init__(self, folder: str, name: str):
        self._fs, base = store(folder)
        self._fs.create_dir(base, recursive=True)
        self._final = posixpath.join(base, name)
        self._made = posixpath.join(base, f"_{name}.{uuid.uuid4().hex}")
        self._out = self._fs.open_output_stream(self._made)
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._made, self._final)

    def drop(self) -> None:
        self._out.close()
        self._fs.delete_file(self._made)


def open_random(uri: str) -> pafs.FileSystem:
    fs, path = store(uri)
    return fs.open_input_file(path)


shipped(__name__)
