"""Archives in files, read by ranges: first the directory, then the members that are wanted.

1. *Index*: of a zip only the tail with its central directory is read, of a plain
   tar only the headers (contents are skipped by seeking).  Each member becomes a
   light row with the place and length of its bytes.
2. *Verdict* on these rows: an archive that its names, kinds, count or declared
   sizes refuse is not opened again.
3. *Contents*: the members that stay are dealt to all tasks in runs of a few
   megabytes, and each member is read by its own range.  So an archive may be far larger than a worker's memory,
   and one large archive is read by many tasks.

A compressed tar has no places to seek to.  One task walks it as a stream, for
the index and again for the contents, and holds a member at a time.
"""

from __future__ import annotations

import bz2
import io
import stat
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from types import SimpleNamespace
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.limits import Limits
from leafmill.operators.archives import judge_members
from leafmill.session import ship_package
from leafmill.sources.archives import MEMBERS, TAR_KINDS
from leafmill.sources.stores import open_ranges

# Place, stored length, method (0 stored, 8 deflate, 12 bzip2, 14 lzma; -1 a compressed tar), checksum and flags of a member's bytes.
INDEX = (
    "format string, member_count int, ordinal int, name string, kind string, declared_size bigint, problem string, "
    "place bigint, stored bigint, method int, crc bigint, flags int"
)
_NAMES = [part.split()[0] for part in INDEX.split(", ")]
_NOWHERE = (None, None, None, None, None)
STREAM = -1
STEP = 1 << 20  # compressed bytes read at a time
FLUSH_BYTES, FLUSH_ROWS = 8 << 20, 4096
RUN_BYTES = 8 << 20  # stored bytes of an archive that are read together
ENCRYPTED = 1


def _container(kind: str, problem: str | None = None) -> tuple:
    return (None, None, 0, None, kind, 0, problem, *_NOWHERE)


def zip_kind(info: zipfile.ZipInfo) -> str:
    mode = stat.S_IFMT(info.external_attr >> 16)
    if info.is_dir():
        return "directory"
    if mode == stat.S_IFLNK:
        return "symlink"
    return "file" if mode in (0, stat.S_IFREG) else "special"


def _zip_index(file: Any, limits: Limits) -> Iterator[tuple]:
    try:
        archive = zipfile.ZipFile(file)
    except Exception as exc:  # any damage in the directory
        yield _container("damaged", f"{type(exc).__name__}: {exc}")
        return
    infos = archive.infolist()
    for ordinal, info in enumerate(infos[: limits.max_archive_members + 1]):
        yield ("zip", len(infos), ordinal, info.filename, zip_kind(info), info.file_size, None,
               info.header_offset, info.compress_size, info.compress_type, info.CRC, info.flag_bits)


def _tar_index(tar: tarfile.TarFile, limits: Limits, method: int) -> Iterator[tuple]:
    ordinal, declared = -1, 0
    try:
        for ordinal, info in enumerate(tar):
            if ordinal > limits.max_archive_members:
                return
            kind = next((label for test, label in TAR_KINDS if getattr(info, test)()), "special")
            declared += info.size if kind == "file" else 0
            yield ("tar", None, ordinal, info.name, kind, info.size, None, info.offset_data, info.size, method, None, None)
            if declared > limits.max_archive_bytes and method == STREAM:
                return  # refused already; no need to unpack the rest
            tar.members = []  # a long archive's headers are not kept
    except (OSError, tarfile.TarError, EOFError, zlib.error) as exc:
        yield ("tar", None, ordinal + 1, None, "unreadable", 0, f"the archive cannot be read to its end: {exc}", *_NOWHERE)


def _streamed(file: Any) -> tarfile.TarFile | None:
    """A compressed tar, opened as a stream."""
    for mode in ("r|gz", "r|bz2", "r|xz"):
        file.seek(0)
        try:
            return tarfile.open(fileobj=file, mode=mode)
        except (tarfile.ReadError, tarfile.CompressionError, EOFError, OSError):
            continue
    return None


def index_rows(location: str, name: str, limits: Limits) -> Iterator[tuple]:
    """The members of one archive, or one row that says why there are none."""
    file = open_ranges(location)
    if file is None:
        yield _container("unreadable", f"cannot open `{location}`")
        return
    with file:
        found = False
        if zipfile.is_zipfile(file):
            rows = _zip_index(file, limits)
        else:
            file.seek(0)
            try:
                rows = _tar_index(tarfile.open(fileobj=file, mode="r:"), limits, 0)
            except tarfile.ReadError:
                tar = _streamed(file)
                rows = iter([_container("unreadable", f"`{name}` cannot be read as a zip or tar archive")]) if tar is None else _tar_index(tar, limits, STREAM)
        for row in rows:
            found = True
            yield row
        if not found:
            yield _container("empty")


def archive_index(archives: DataFrame, limits: Limits, *carry: str) -> DataFrame:
    """``(archive_id, filename, location)`` to a light row for each member, ``INDEX`` with ``carry`` and the location."""
    heads = list(dict.fromkeys(["archive_id", "location", *carry]))
    columns = [*heads, *_NAMES]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def portion(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in ("member_count", "place", "stored", "method", "crc", "flags")})

        rows: list[tuple] = []  # of many archives: making a frame costs more than reading a directory
        for batch in batches:
            for head, location, name in zip(batch[heads].itertuples(index=False, name=None), batch["location"], batch["filename"]):
                for row in index_rows(location, name, limits):
                    rows.append((*head, *row))
                    if len(rows) >= FLUSH_ROWS:
                        yield portion(rows)
                        rows = []
        if rows:
            yield portion(rows)

    ship_package(archives.sparkSession)
    schema = ", ".join(f"{c} string" for c in heads) + ", " + INDEX
    return archives.select(*dict.fromkeys([*heads, "filename"])).mapInPandas(read, schema)


def _unpacker(method: int):
    if method == zipfile.ZIP_STORED:
        return None
    if method == zipfile.ZIP_DEFLATED:
        return zlib.decompressobj(-15)
    if method == zipfile.ZIP_BZIP2:
        return bz2.BZ2Decompressor()
    if method == zipfile.ZIP_LZMA:
        return zipfile.LZMADecompressor()
    raise NotImplementedError(f"compression method {method} is not supported")


def zip_member(file: Any, place: int, stored: int, method: int, crc: int, flags: int, most: int) -> bytes:
    """The bytes of a member, at most ``most`` + 1 of them, from its own range only."""
    if flags & ENCRYPTED:
        raise RuntimeError("the member is encrypted")
    unpack = _unpacker(method)
    file.seek(place)
    head = file.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member header where the directory says")
    name, extra = struct.unpack("<HH", head[26:30])
    file.seek(place + 30 + name + extra)
    out, size, left = [], 0, stored
    while left > 0 and size <= most:
        data = file.read(min(STEP, left))
        if not data:
            raise EOFError("the member ends early")
        left -= len(data)
        if unpack is None:
            parts = [data]
        elif method == zipfile.ZIP_DEFLATED:
            parts = [unpack.decompress(data, most + 1 - size)]
            while unpack.unconsumed_tail and size + sum(map(len, parts)) <= most:
                parts.append(unpack.decompress(unpack.unconsumed_tail, most + 1 - size))
        else:
            parts = [unpack.decompress(data)]
        out += parts
        size += sum(map(len, parts))
    content = b"".join(out)
    if size <= most and zlib.crc32(content) != crc:
        raise zipfile.BadZipFile("Bad CRC-32 of the member")
    return content[: most + 1]


class _Reader:
    """Reads members in the order in which rows come; keeps the file of the last one open."""

    def __init__(self, most: int):
        self.most, self.location = most, None
        self.file: Any = None
        self.tar: tarfile.TarFile | None = None
        self.next = 0

    def _open(self, location: str) -> None:
        if self.file is not None:
            self.file.close()
        self.location, self.tar, self.next = location, None, 0
        self.file = open_ranges(location)

    def __call__(self, row: Any) -> bytes:
        if row.location != self.location or (self.tar is not None and row.ordinal < self.next):
            self._open(row.location)
        if self.file is None:
            raise FileNotFoundError(f"cannot open `{row.location}`")
        if row.method == STREAM:
            self.tar = self.tar or _streamed(self.file)
            for info in self.tar:
                self.next += 1
                if self.next > row.ordinal:
                    content = self.tar.extractfile(info).read(self.most + 1)
                    self.tar.members = []
                    return content
            raise EOFError("the archive ends early")
        if row.format == "tar":
            self.file.seek(row.place)
            content = self.file.read(min(row.stored, self.most + 1))
            if len(content) < min(row.stored, self.most + 1):
                raise EOFError("the member ends early")
            return content
        return zip_member(self.file, row.place, row.stored, row.method, row.crc, row.flags, self.most)


def read_members(index: DataFrame, limits: Limits) -> DataFrame:
    """Add ``content`` to the index rows that are ``wanted``, from each one's own range; what fails leaves its ``problem``."""
    columns = [c for c in index.columns if c not in ("problem", "wanted")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(limits.max_archive_bytes)
        for batch in batches:
            start, held, problems, size = 0, [], [], 0
            rows = batch.select(["location", "format", "ordinal", "place", "stored", "method", "crc", "flags", "wanted", "problem"]).to_pylist()
            for i, row in enumerate(rows):
                content, problem = None, row["problem"]
                try:
                    content = reader(SimpleNamespace(**row)) if row["wanted"] else None
                except FileNotFoundError as exc:
                    problem = str(exc)
                except (zipfile.BadZipFile, tarfile.TarError, EOFError, RuntimeError, NotImplementedError, ValueError, zlib.error) as exc:
                    problem = f"{type(exc).__name__}: {exc}"
                held.append(content)
                problems.append(problem)
                size += len(content or b"")
                if size >= FLUSH_BYTES or len(held) >= FLUSH_ROWS or i + 1 == len(rows):
                    part = batch.select(columns).slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(problems, pa.string()), pa.array(held, pa.binary())],
                                                     names=[*columns, "problem", "content"])
                    start, held, problems, size = i + 1, [], [], 0

    kinds = {f.name: f for f in index.schema.fields}
    made = StructType([*[kinds[c] for c in columns], *StructType.fromDDL("problem string, content binary").fields])
    return index.select(*columns, "wanted", "problem").mapInArrow(read, made)


def explode_located(archives: DataFrame, limits: Limits, *carry: str) -> DataFrame:
    """``(archive_id, filename, location)`` to ``MEMBERS`` as ``explode_archives`` gives them.

    Members of archives that are refused without their bytes have no content.
    """
    sized = archive_index(archives, limits, *carry).withColumn("content_length", F.lit(None).cast("int"))
    judged = judge_members(sized, limits).drop("content_length")
    wanted = F.col("refusal").isNull() & (F.col("kind") == "file")
    light = judged.withColumn("wanted", F.coalesce(wanted, F.lit(False))).drop("refusal")
    # Members are dealt by runs of stored bytes, so a small archive is opened once and a large one by many tasks;
    # those of a compressed tar stay together, in stored order.
    so_far = W.partitionBy("archive_id").orderBy("ordinal").rowsBetween(W.unboundedPreceding, W.currentRow)
    alone = F.when(F.col("method") != STREAM, (F.sum("stored").over(so_far) / RUN_BYTES).cast("long"))
    dealt = light.withColumn("_alone", alone).repartition("archive_id", "_alone").sortWithinPartitions("archive_id", "ordinal").drop("_alone")
    every = read_members(dealt, limits)
    return every.select("archive_id", *carry, *[part.split()[0] for part in MEMBERS.split(", ")])
