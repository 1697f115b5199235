"""Archives in a binary column to member rows.

Python only opens the container and reads bytes here.  Which members, and
which archives, are acceptable is decided on the rows (``operators.archives``).
"""

from __future__ import annotations

import io
import stat
import tarfile
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from leafmill.limits import Limits
from leafmill.session import ship_package

MEMBERS = (
    "format string, member_count int, ordinal int, name string, kind string, "
    "declared_size bigint, content binary, problem string"
)
_COLUMNS = ["format", "member_count", "ordinal", "name", "kind", "declared_size", "content", "problem"]
_FLUSH_BYTES, _FLUSH_ROWS = 8 << 20, 4096  # held in a worker at a time, as rows and once more as columns


def portions(rows: Iterable[tuple], most_bytes: int = _FLUSH_BYTES, most_rows: int = _FLUSH_ROWS) -> Iterator[list[tuple]]:
    """Member rows in lists of bounded bytes and count: members of a line or less cost far more as rows than their bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-2] or b"")
        if size >= most_bytes or len(held) >= most_rows:
            yield held
            held, size = [], 0
    if held:
        yield held


def explode_archives(archives: DataFrame, limits: Limits, *carry: str) -> DataFrame:
    """``(archive_id, filename, content)`` to ``MEMBERS``, in stored order, ordinals from 0.

    ``carry`` names text columns of the archive that each member row repeats.
    The format is found from the bytes: zip first, then tar in any
    compression.  A container that is neither gives one row of kind
    ``unreadable``, one without members a row of kind ``empty``.  Reading stops one member after the count limit, and
    contents stop once the declared sizes pass the byte limit: such an archive
    is refused whatever follows.
    """
    heads = ["archive_id", *carry]
    columns = [*heads, *_COLUMNS]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (
            (*head, *row)
            for batch in batches
            for head, filename, content in zip(batch[heads].itertuples(index=False, name=None), batch["filename"], batch["content"])
            for row in _members(filename, content, limits)
        )
        for part in portions(rows):
            yield pd.DataFrame(part, columns=columns)

    ship_package(archives.sparkSession)
    schema = ", ".join(f"{column} string" for column in heads) + ", " + MEMBERS
    needed = dict.fromkeys([*heads, "filename", "content"])
    return archives.select(*needed).mapInPandas(read, schema)


def _container_row(kind: str, problem: str | None = None) -> tuple:
    """A row about an archive as a whole."""
    return (None, None, 0, None, kind, 0, None, problem)


def _members(name: str, content: bytes, limits: Limits) -> Iterator[tuple]:
    """Rows of one archive: its members, or one row that says why there are none."""
    found = False
    for row in _stored(name, content, limits):
        found = True
        yield row
    if not found:
        yield _container_row("empty")


def _stored(name: str, content: bytes, limits: Limits) -> Iterator[tuple]:
    source = io.BytesIO(content)
    if zipfile.is_zipfile(source):
        yield from _zip_members(source, limits)
        return
    source.seek(0)
    try:
        with tarfile.open(fileobj=source, mode="r:*") as tar:
            yield from _tar_members(tar, limits)
    except tarfile.ReadError:
        yield _container_row("unreadable", f"`{name}` cannot be read as a zip or tar archive")


def _zip_members(source: io.BytesIO, limits: Limits) -> Iterator[tuple]:
    try:
        archive = zipfile.ZipFile(source)
    except Exception as exc:  # any damage in the directory
        yield _container_row("damaged", f"{type(exc).__name__}: {exc}")
        return
    with archive:
        infos = archive.infolist()
        declared = 0
        for ordinal, info in enumerate(infos[: limits.max_archive_members + 1]):
            mode = stat.S_IFMT(info.external_attr >> 16)
            if info.is_dir():
                kind = "directory"
            elif mode == stat.S_IFLNK:
                kind = "symlink"
            else:
                kind = "file" if mode in (0, stat.S_IFREG) else "special"
            content, problem = None, None
            if kind == "file":
                declared += info.file_size
                if declared <= limits.max_archive_bytes:
                    try:
                        with archive.open(info) as member:
                            content = member.read(limits.max_archive_bytes + 1)
                    except Exception as exc:  # bad checksum, encryption, unknown method
                        problem = f"{type(exc).__name__}: {exc}"
            yield ("zip", len(infos), ordinal, info.filename, kind, info.file_size, content, problem)


TAR_KINDS = (("isdir", "directory"), ("issym", "symlink"), ("islnk", "hardlink"), ("isfile", "file"))


def _tar_members(tar: tarfile.TarFile, limits: Limits) -> Iterator[tuple]:
    declared, ordinal = 0, 0
    try:
        for ordinal, info in enumerate(tar):
            if ordinal > limits.max_archive_members:
                return
            kind = next((label for test, label in TAR_KINDS if getattr(info, test)()), "special")
            content = None
            if kind == "file":
                declared += info.size
                if declared <= limits.max_archive_bytes:
                    content = tar.extractfile(info).read(limits.max_archive_bytes + 1)
            yield ("tar", None, ordinal, info.name, kind, info.size, content, None)
    except (OSError, tarfile.TarError, EOFError) as exc:
        yield ("tar", None, ordinal + 1, None, "unreadable", 0, None, f"the archive cannot be read to its end: {exc}")
