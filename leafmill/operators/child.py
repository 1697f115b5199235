"""The process a user's converter runs in.  Started by ``isolation``; reads frames from one pipe and answers on another."""

from __future__ import annotations

import ctypes
import json
import os
import pickle
import resource
import signal
import struct
import sys
from typing import Any, BinaryIO

PR_SET_PDEATHSIG = 1


def read_frame(source: BinaryIO) -> Any:
    """The next object; None at the end."""
    head = source.read(8)
    if len(head) < 8:
        return None
    return pickle.loads(source.read(struct.unpack("<Q", head)[0]))


def write_frame(target: BinaryIO, value: Any) -> None:
    data = pickle.dumps(value, protocol=pickle.HIGHEST_PROTOCOL)
    target.write(struct.pack("<Q", len(data)))
    target.write(data)
    target.flush()


def _failed(exc: BaseException) -> tuple[str, Any]:
    kind = "missing" if isinstance(exc, ImportError) else "dependency" if hasattr(exc, "missing") else "error"
    return kind, (type(exc).__name__, str(exc), list(getattr(exc, "missing", [])))


def main(read_fd: int, write_fd: int, max_bytes: int, parent: int) -> None:
    try:  # whatever hangs here ends with the worker that started it
        ctypes.CDLL(None).prctl(PR_SET_PDEATHSIG, signal.SIGKILL)
    except (OSError, AttributeError):  # another system than Linux
        pass
    if os.getppid() != parent:
        return
    source, target = os.fdopen(read_fd, "rb"), os.fdopen(write_fd, "wb")
    from pyspark import cloudpickle

    write_frame(target, ("ready", None))
    first = read_frame(source)
    if first is None:
        return
    factory, key = first
    if max_bytes:
        resource.setrlimit(resource.RLIMIT_DATA, (max_bytes, max_bytes))
    try:
        converter = cloudpickle.loads(factory)(json.loads(key))
    except BaseException as exc:  # told to the worker, which decides
        write_frame(target, _failed(exc))
        return
    write_frame(target, ("built", None))
    while (asked := read_frame(source)) is not None:
        name, content = asked
        try:
            made = converter(name, content)
            answer = ("made", dict(made))
        except MemoryError:
            os._exit(MEMORY_EXIT)  # what is left of the heap is of no use
        except Exception as exc:
            answer = _failed(exc)
        write_frame(target, answer)


MEMORY_EXIT = 75

if __name__ == "__main__":
    main(*map(int, sys.argv[1:5]))
