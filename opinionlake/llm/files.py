"""Binary files that tasks write and range-read in the shared folder.

Every attempt of a task writes files under names of its own and returns them; the
table of returned names is what commits them.  A lost or repeated attempt leaves a
file that no table names.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, prefix: str, suffix: str) -> str:
    return f"{folder.rstrip('/')}/{prefix}-{uuid.uuid4().hex}{suffix}"


class Output:
    """A new file; ``write`` gives the offset of what it wrote."""

    def __init__(self, uri: str):
        system, path = filesystem(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.size = uri, 0
        self._stream = system.open_output_stream(path, compression=None)

    def write(self, data: bytes) -> int:
        at = self.size
        self._stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._stream.close()


class Ranges:
    """Range reads; keeps the last file open."""

    def __init__(self):
        self._uri, self._file = None, None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self._uri:
            self.close()
            system, path = filesystem(uri)
            self._uri, self._file = uri, system.open_input_file(path)
        data = self._file.read_at(length, offset)
        if len(data) != length:
            raise IOError(f"{uri}: {len(data)} bytes at {offset}, {length} expected")
        return data

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
            self._uri, self._file = None, None
