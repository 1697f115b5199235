"""Files in local folders and stores, opened in the executors."""

from __future__ import annotations

import io
import time
from collections.abc import Callable
from typing import TypeVar
from urllib.parse import urlsplit

from pyarrow import NativeFile
from pyarrow.fs import FileSystem, FileType, LocalFileSystem

T = TypeVar("T")
# What tells that there is nothing to read there; any other failure may pass.
FINAL = (FileNotFoundError, PermissionError, IsADirectoryError, NotADirectoryError)
ATTEMPTS, WAIT_SECS = 3, 0.5
BUFFER = 1 << 16
_STORES: dict[str, tuple[FileSystem, str]] = {}


def store_and_path(location: str) -> tuple[FileSystem, str]:
    """The store of a local path or URI, and the path in it.

    A worker keeps one client for each scheme and authority, with what its paths begin with.
    """
    if location.startswith("/"):
        return LocalFileSystem(), location
    parts = urlsplit(location)
    key = f"{parts.scheme}://{parts.netloc}"
    if key not in _STORES or "%" in location:
        store, path = FileSystem.from_uri(location)
        if "%" in location:
            return store, path
        _STORES[key] = store, path[: len(path) - len(parts.path)]
    store, lead = _STORES[key]
    return store, lead + parts.path


def attempt(work: Callable[[], T], attempts: int = ATTEMPTS, wait_secs: float = WAIT_SECS) -> T | None:
    """The result of ``work``; None where there is nothing to read.

    Any other failure of the store, such as throttling, is tried again a few
    times and then raised, so that the task fails and runs again elsewhere:
    it says nothing about the document.
    """
    for left in reversed(range(attempts)):
        try:
            return work()
        except FINAL:
            return None
        except OSError:
            if not left:
                raise
            time.sleep(wait_secs)
    return None


class RangeFile(io.RawIOBase):
    """A store's file for libraries that seek and read; nothing is read that is not asked for."""

    def __init__(self, source: NativeFile):
        self.source, self.length, self.place = source, source.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.place

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.place, io.SEEK_END: self.length}[whence]
        if place < 0:
            raise OSError("a place before the start of the file")
        self.place = place
        return place

    def readinto(self, buffer: memoryview) -> int:
        size = max(0, min(len(buffer), self.length - self.place))
        if size:
            self.source.seek(self.place)
            data = self.source.read(size)
            size = len(data)
            buffer[:size] = data
            self.place += size
        return size

    def close(self) -> None:
        if not self.closed:
            self.source.close()
        super().close()


def open_ranges(location: str) -> io.BufferedReader | None:
    """A file to seek in; None where there is nothing to read."""
    store, path = store_and_path(location)
    source = attempt(lambda: store.open_input_file(path))
    return None if source is None else io.BufferedReader(RangeFile(source), BUFFER)


def file_length(location: str) -> int | None:
    """Bytes of a regular file; None for anything else."""
    store, path = store_and_path(location)
    info = attempt(lambda: store.get_file_info(path))
    return info.size if info is not None and info.type == FileType.File else None
