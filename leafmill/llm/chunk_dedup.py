"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes (each step doubles the hash and adds a random
word of the byte, so the top bits depend on the last 32 bytes); where its top
bits are zero a chunk ends, within a least and a greatest length.  As borders
follow content, an insertion shifts no border behind the next common one.
Chunks are compared by 128-bit digest; of equal chunks the first in order of
(doc_id, place) stays and the others go.

A chunk shorter than the least length (the end of a text) is never a repeat.
Null text is empty.  Rows that repeat an id and a text count as further copies;
their spans are the same, so such a row keeps what its twin keeps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.hashing import byte_table, pieces, texts_as_bytes
from leafmill.session import ship_package, through_table

LEAST, MOST, BORDER_BITS = 32, 256, 5  # about 64 bytes a chunk
ROLL = 32  # bytes the hash remembers
SEGMENT = 1 << 22
SIZE_BITS = 16  # a chunk's place and size go in one number


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash behind every byte, modulo 2**32, by doubling the remembered length."""
    total = (byte_table(9)[data] >> np.uint64(32)).astype(np.uint32)
    reach = 1
    while reach < ROLL:
        longer = total.copy()
        longer[reach:] += total[:-reach] << np.uint32(reach)
        total, reach = longer, reach * 2
    return total


def borders(data: np.ndarray, bits: int = BORDER_BITS) -> np.ndarray:
    """Places behind which a chunk may end."""
    found = []
    for base in range(0, len(data), SEGMENT):
        back = min(base, ROLL)
        part = gear(data[base - back : base + SEGMENT])[back:]
        found.append(np.flatnonzero(part >> np.uint32(32 - bits) == 0) + base + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_stops(candidates: list[int], start: int, end: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of the text in [start, end); the first border beyond the least length ends a chunk."""
    stops, i = [], 0
    while end - start > least:
        while i < len(candidates) and candidates[i] < start + least:
            i += 1
        stop = min(candidates[i] if i < len(candidates) else end, start + most, end)
        stops.append(stop)
        start = stop
    if start < end:
        stops.append(end)
    return stops


def _chunks(least: int, most: int, bits: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                data, ends = texts_as_bytes(piece.column("text"))
                data, ends = data[ends[0] : ends[-1]], ends - ends[0]
                found = borders(data, bits)
                cuts = np.searchsorted(found, ends, side="right").tolist()
                found, raw, whole = found.tolist(), data.tobytes(), ends.tolist()
                rows, place, digests = [], [], []
                for i, (start, end) in enumerate(zip(whole[:-1], whole[1:])):
                    begin = start
                    for stop in chunk_stops(found[cuts[i] : cuts[i + 1]], start, end, least, most):
                        if stop - begin >= least:
                            rows.append(i)
                            place.append((begin - start) << SIZE_BITS | stop - begin)
                            digests.append(hashlib.blake2b(raw[begin:stop], digest_size=16).digest())
                        begin = stop
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                at = pa.array(rows, pa.int64())
                yield pa.record_batch(
                    [piece.column("doc").take(at), piece.column("doc_id").take(at), pa.array(place, pa.int64()),
                     pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["doc", "doc_id", "place", "digest", "digest2"])

    return make


def _cut(least: int, most: int, bits: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most=1 << 22):
                data, ends = texts_as_bytes(piece.column("text"))
                counts, removed, digests, kept_texts = [], [], [], []
                for i, spans in enumerate(piece.column("spans").to_pylist()):
                    text = data[ends[i] : ends[i + 1]]
                    counts.append(len(chunk_stops(borders(text, bits).tolist(), 0, len(text), least, most)))
                    raw = text.tobytes()
                    edges = [0, *(x for s in spans for x in (s["start"], s["stop"])), len(raw)]
                    kept_texts.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    removed.append(len(raw) - len(kept_texts[-1]))
                    digests.append(hashlib.sha256(kept_texts[-1]).hexdigest())
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(np.diff(ends)), pa.array(counts, pa.int64()), piece.column("n_repeated"),
                     pa.array(removed, pa.int64()), piece.column("spans"), pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary())],
                    names=["doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", "spans", "kept_sha256", "kept"])

    return make


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, most: int = MOST,
                   bits: int = BORDER_BITS) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_chunks, n_repeated, n_removed, spans, kept_sha256, kept (bytes).

    ``n_repeated`` counts chunks that stand elsewhere too, ``n_removed`` bytes
    of chunks that stand earlier; the spans (start, stop) are those chunks.
    """
    if not ROLL <= least <= most < 1 << SIZE_BITS:
        raise ValueError(f"{ROLL} <= least <= most < {1 << SIZE_BITS}")
    ship_package(docs.sparkSession)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(docs[id_col], text).alias("doc"), docs[id_col].alias("doc_id"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    chunks = rows.mapInArrow(_chunks(least, most, bits), f"doc long, doc_id {kind}, place long, digest long, digest2 long")
    key = ["digest", "digest2"]
    # Only digests and counts meet to find repeats; each digest stands once on
    # the right of both joins, so a chunk of very many texts splits on the left.
    # The right sides are tables, as a join right above an aggregation on its key cannot split.
    again = through_table(chunks.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key), "digests")
    repeats = through_table(chunks.join(again, key), "repeated-chunks")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc", "place")
    firsts = through_table(repeats.groupBy(key).agg(F.min(order).alias("first")).select(
        *key, F.col("first.doc").alias("first_doc"), F.col("first.place").alias("first_place")), "first-chunks")
    start, size = F.shiftright("place", SIZE_BITS), F.col("place") % (1 << SIZE_BITS)
    gone = (F.col("first_doc") != F.col("doc")) | (F.col("first_place") != F.col("place"))
    per_doc = repeats.join(firsts, key).select(
        "doc", "place", F.when(gone, F.struct(start.alias("start"), (start + size).alias("stop"))).alias("span")
    ).groupBy("doc").agg(F.count_distinct("place").alias("n_repeated"), F.sort_array(F.collect_set("span")).alias("spans"))
    spans = "array<struct<start: long, stop: long>>"
    joined = rows.join(per_doc, "doc", "left").select(
        "doc_id", "text", F.coalesce("n_repeated", F.lit(0)).alias("n_repeated"), F.coalesce("spans", F.array().cast(spans)).alias("spans"))
    return joined.mapInArrow(
        _cut(least, most, bits),
        f"doc_id {kind}, n_bytes long, n_chunks long, n_repeated long, n_removed long, spans {spans}, kept_sha256 string, kept binary")
