"""Repeated byte strings of a minimum length, by a distributed difference-cover suffix method.

A difference cover lets a few sampled suffixes stand for all: any two equal
strings have samples at the same distance from their starts.  Sampling by
position modulo 3 would make two rows out of three bytes, more than a corpus
can sort; here the cover is chosen by content (a string synchronising set): the
sample of start p is the place of the least k-gram hash in a window after p.
Equal strings then choose equally, and about one byte in a hundred is sampled.

1. *Sampled triples.*  The suffix at a sample is named by the triple of its next
   three blocks.  Triples are sorted and counted by name; a name that occurs
   once cannot begin a repeat, and goes.
2. *Range-hash names*, in place of the recursion on names: suffixes are never
   ranked, and a triple is renamed at most twice.  A sample with the starts that chose it is named again
   by the whole stretch that their strings cover.  If all suffixes of one triple
   have one such name, all those starts repeat and no more is to be done; so
   copies and the inside of long repeats end here.
   Where the stretches of a triple lie alike around it, they are named a third
   time by the part that all their strings share; alone there, they end too.
3. *Remaining suffixes.*  What is left are the ends of repeats: one stretch of
   each name is expanded to all its suffixes, cut at the minimum length; this and
   the next step stand in place of the merge of ranked suffixes.
4. *Adjacent prefixes.*  Those are sorted, and equal neighbours compared.

Sorting is by two 64-bit digests of the bytes instead of the bytes, as only
equality with a neighbour matters.  Every step combines within map tasks before
it sends, so a string that a third of all rows share is sent a few times a task.

Null text is empty.  Strings never cross texts.  Rows that repeat an id and a
text are two rows, which repeat each other; ids may be null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import shuffle_width
from leafmill.llm.hashing import RangeHash, mix, pieces, texts_as_bytes
from leafmill.session import ship_package, through_table

K_GRAM = 16
SEGMENT = 1 << 21  # starts of one text that are worked on at a time
HOLD_BYTES = 1 << 21  # of stretches that are expanded at a time
INDEX_BITS = np.uint64(24)
SUFFIX = np.dtype([("one", "<u8"), ("two", "<u4"), ("doc", "<i8"), ("at", "<i4"), ("open", "?")])
START = np.dtype([("doc", "<i8"), ("at", "<i4")])


def window_of(length: int) -> int:
    """Starts that may choose one sample; what is left of the length is the triple."""
    return max(1, length * 16 // 25 - K_GRAM)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, in two running passes over blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int):
    """Runs of starts with one sample: text number, first start, count, names of triple, stretch and shared part, and the shape."""
    width = window_of(length)
    none = np.zeros(0, np.int64)
    texts = np.flatnonzero(ends - begins >= length)
    if not len(texts):
        return (none,) * 7
    hashed = RangeHash(data)
    grams = hashed.every(K_GRAM)
    index = np.arange(len(grams), dtype=np.uint64)
    sample = sliding_least((grams >> INDEX_BITS << INDEX_BITS) | index, width) & np.uint64((1 << int(INDEX_BITS)) - 1)
    counts = ends[texts] - begins[texts] - length + 1
    starts = np.repeat(begins[texts] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    owner = np.repeat(texts, counts)
    chosen = sample[starts].astype(np.int64)
    border = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])]))
    many = np.diff(np.append(border, len(starts)))
    first, at, who = starts[border], chosen[border], owner[border]
    block = (length - width + 1) // 3
    triple = sum(mix(hashed(at + j * block, at + (j + 1) * block) + np.uint64(j)) for j in range(3))
    second, before = RangeHash(data, 1), mix((at - first).astype(np.uint64))
    whole = second(first, first + many - 1 + length) ^ before
    shared = second(first + many - 1, first + length) ^ before
    shape = (at - first) * length + many
    return who, first - begins[who], many, mix(triple).view(np.int64), whole.view(np.int64), shared.view(np.int64), shape


def _stretch_rows(length: int):
    def one(docs: pa.Array, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int) -> pa.RecordBatch:
        who, first, many, triple, whole, shared, shape = stretches(data, begins, ends, length)
        small = [pa.array(x, pa.int32()) for x in (first + base, many, shape)]
        return pa.record_batch([docs.take(pa.array(who)), *small, pa.array(triple), pa.array(whole), pa.array(shared)],
                               names=["doc", "at", "starts", "shape", "triple", "whole", "shared"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                data, ends = texts_as_bytes(piece.column("text"))
                data, ends = data[ends[0] : ends[-1]], ends - ends[0]
                if piece.num_rows > 1 or len(data) <= SEGMENT + length:
                    yield one(piece.column("doc"), data, ends[:-1], ends[1:], 0)
                    continue
                for base in range(0, len(data) - length + 1, SEGMENT):  # a cut stretch is one more name, no more
                    part = data[base : base + SEGMENT + length - 1]
                    yield one(piece.column("doc"), part, np.array([0]), np.array([len(part)]), base)

    return make


def _runs(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(fresh)
    return begins, np.diff(np.append(begins, len(fresh)))


def _equal_neighbours(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted by prefix; where each prefix begins and how many share it (a closed one counts as shared)."""
    rows = rows[np.lexsort((rows["two"], rows["one"]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows["one"][1:] != rows["one"][:-1]) | (rows["two"][1:] != rows["two"][:-1])
    begins, lengths = _runs(fresh)
    closed = np.add.reduceat((~rows["open"]).astype(np.int64), begins) if len(rows) else np.zeros(0, np.int64)
    return rows, np.where((lengths > 1) | (closed > 0), 2, 1), lengths


def _in_buckets(rows: np.ndarray, keys: np.ndarray, width: int, kind: str):
    buckets = (mix(keys) % np.uint64(width)).astype(np.int32)
    order = np.argsort(buckets, kind="stable")
    rows, buckets = rows[order], buckets[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = buckets[1:] != buckets[:-1]
    for a, m in zip(*_runs(fresh)):
        yield int(buckets[a]), kind, rows[a : a + m].tobytes()


def _blobs(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
                            pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "data"])


def _starts_of(rows: np.ndarray) -> np.ndarray:
    found = np.empty(len(rows), START)
    found["doc"], found["at"] = rows["doc"], rows["at"]
    return found


def _expand(length: int, width: int):
    """All suffixes of the given stretches; what a task finds repeated itself it answers, and sends one witness."""
    def send(parts: list[np.ndarray], marks: list[tuple[int, int, int, bool]]) -> pa.RecordBatch:
        data = np.concatenate(parts)
        counts = np.array([m[2] for m in marks])
        offsets = np.cumsum([0, *(len(p) for p in parts[:-1])])
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = np.repeat(offsets, counts) + inner
        rows = np.empty(len(places), SUFFIX)
        rows["one"], rows["two"] = RangeHash(data, 2)(places, places + length), RangeHash(data, 3)(places, places + length) >> np.uint64(32)
        rows["doc"] = np.repeat([m[0] for m in marks], counts)
        rows["at"] = np.repeat([m[1] for m in marks], counts) + inner
        rows["open"] = np.repeat([m[3] for m in marks], counts)
        rows, shared, lengths = _equal_neighbours(rows)
        known = np.repeat(shared > 1, lengths)
        answers = _starts_of(rows[known & rows["open"]])
        witness = rows[np.cumsum(lengths) - lengths]
        witness["open"] = shared == 1
        out = list(_in_buckets(witness, witness["one"], width, "suffixes"))
        out += _in_buckets(answers, answers["doc"].astype(np.uint64), width, "starts")
        return _blobs(out)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, marks, size = [], [], 0
        for batch in batches:
            data, ends = texts_as_bytes(batch.column("text"))
            for i, (doc, found) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("open_runs").to_pylist())):
                text = data[ends[i] : ends[i + 1]]
                for run in found:
                    parts.append(text[run["at"] : run["at"] + run["starts"] + length - 1])
                    marks.append((doc, run["at"], run["starts"], run["open"]))
                    size += len(parts[-1])
                    if size >= HOLD_BYTES:
                        yield send(parts, marks)
                        parts, marks, size = [], [], 0
        if parts:
            yield send(parts, marks)

    return make


def _compare(width: int):
    """Adjacent prefixes of one bucket; starts that repeat go to the bucket of their document."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for bucket, kind, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "data"))):
                if kind == "starts":
                    yield _blobs([(bucket, kind, data)])
                else:
                    held.append(data)
        rows, shared, lengths = _equal_neighbours(np.frombuffer(b"".join(held), SUFFIX))
        answers = _starts_of(rows[np.repeat(shared > 1, lengths) & rows["open"]])
        found = list(_in_buckets(answers, answers["doc"].astype(np.uint64), width, "starts"))
        if found:
            yield _blobs(found)

    return make


def _as_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts of one bucket of documents as runs."""
    held = [x for batch in batches for x in batch.column("data").to_pylist()]
    starts = np.unique(np.frombuffer(b"".join(held), START))
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (starts["doc"][1:] != starts["doc"][:-1]) | (starts["at"][1:] != starts["at"][:-1] + 1)
    begins, lengths = _runs(fresh)
    yield pa.record_batch([pa.array(starts["doc"][begins]), pa.array(starts["at"][begins]), pa.array(lengths, pa.int32())], names=["doc", "at", "starts"])


def merged_spans(at: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans that runs of starts cover, touching ones joined."""
    order = np.argsort(at, kind="stable")
    begin, end = at[order], np.maximum.accumulate((at + starts - 1 + length)[order])
    fresh = np.ones(len(begin), bool)
    fresh[1:] = begin[1:] > end[:-1]
    firsts = np.flatnonzero(fresh)
    return begin[firsts], end[np.append(firsts[1:] - 1, len(end) - 1)]


def _cut(length: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most=1 << 22):
                data, ends = texts_as_bytes(piece.column("text"))
                sizes, removed, spans, digests, kept_texts = [], [], [], [], []
                for i, runs in enumerate(piece.column("runs")):
                    text = data[ends[i] : ends[i + 1]]
                    spans_of = []
                    kept = text.tobytes()
                    if runs.is_valid and len(runs):
                        fields = runs.values
                        begin, end = merged_spans(*(fields.field(c).to_numpy().astype(np.int64) for c in ("at", "starts")), length)
                        edges = [0, *np.column_stack([begin, end]).ravel().tolist(), len(text)]
                        kept = b"".join(kept[a:b] for a, b in zip(edges[::2], edges[1::2]))
                        spans_of = [{"start": a, "stop": b} for a, b in zip(begin.tolist(), end.tolist())]
                    sizes.append(len(text))
                    removed.append(len(text) - len(kept))
                    spans.append(spans_of)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    kept_texts.append(kept)
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                     pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])

    return make


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, spans (start, stop), kept_sha256, kept (bytes).

    Each byte goes that is covered by a string of ``length`` bytes which also
    starts elsewhere, in any document; the spans are maximal.
    """
    if length < 64:
        raise ValueError("strings of at least 64 bytes")
    spark = docs.sparkSession
    ship_package(spark)
    width = shuffle_width(spark)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(docs[id_col], text).alias("doc"), docs[id_col].alias("doc_id"), text.alias("text"))

    runs = rows.select("doc", "text").mapInArrow(_stretch_rows(length), "doc long, at int, starts int, shape int, triple long, whole long, shared long")
    # Small sides go through tables: a join right above an aggregation on its key
    # cannot split a key that a third of all rows have, a join of two shuffles can.
    triples = through_table(runs.groupBy("triple").agg(
        F.count("*").alias("n"), F.min("whole").alias("least"), F.max("whole").alias("most")).filter("n > 1"), "triples")
    same = F.col("least") == F.col("most")
    mixed = [F.when(~same, F.col(c)).alias(c) for c in ("triple", "whole", "shared", "shape")]
    hits = through_table(runs.join(triples, "triple").select("doc", "at", "starts", same.alias("same"), *mixed), "repeats")

    names = through_table(hits.filter("not same").groupBy("triple", "whole").agg(
        F.count("*").alias("n"), F.min("shared").alias("shared"), F.min("shape").alias("shape"),
        F.min(F.struct("doc", "at", "starts")).alias("one")), "names")
    again = hits.filter("not same").join(names.filter("n > 1").select("triple", "whole"), ["triple", "whole"]).select("doc", "at", "starts")
    alike = through_table(names.groupBy("triple").agg((F.min("shape") == F.max("shape")).alias("alike")), "alike")
    partners = through_table(names.groupBy("triple", "shared").agg(F.count("*").alias("partners")), "partners")
    ends = names.join(alike, "triple").join(partners, ["triple", "shared"]).filter("not alike or partners > 1")
    to_expand = ends.select("one.doc", F.struct("one.at", "one.starts", (F.col("n") == 1).alias("open")).alias("run"))
    by_doc = to_expand.groupBy("doc").agg(F.collect_list("run").alias("open_runs"))
    blob = "bucket int, kind string, data binary"
    # The same columns as in the last join, so that one shuffle of the texts serves both.
    suffixes = rows.join(by_doc, "doc").select("doc", "doc_id", "text", "open_runs").mapInArrow(_expand(length, width), blob)
    starts = suffixes.repartitionById(width, "bucket").mapInArrow(_compare(width), blob).repartitionById(width, "bucket")
    last = starts.mapInArrow(_as_runs, "doc long, at int, starts int")

    found = hits.filter("same").select("doc", "at", "starts").unionAll(again).unionAll(last)
    per_doc = found.groupBy("doc").agg(F.collect_set(F.struct("at", "starts")).alias("runs"))
    schema = ("n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept_sha256 string, kept binary")
    return rows.join(per_doc, "doc", "left").select("doc", "doc_id", "text", "runs").mapInArrow(
        _cut(length), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}")
