"""Exact Jaccard self-join of documents on word n-grams, by T-occurrence search.

Two sets of sizes x and y have Jaccard t or more exactly if they share
T = t / (1 + t) * (x + y) elements.  The inverted lists of a document are split
as in DivideSkip: lists of its first x - ceil(t x) + 1 elements in one global
order are short enough to merge, and a partner must stand in one of them at
least; the rest are long lists, which only candidates are probed in.

1. *Sets.*  A text becomes 64-bit hashes of its distinct n-grams.  Equal sets
   (copies) are one item from here on.
2. *Occurrence filter.*  Of each item the lists of a longer head are merged: a
   partner shares at least k elements within the first x - ceil(t x) + k, with k
   the tenth of the smaller size.  So an item needs that many head elements that
   some other item has too.  Map tasks merge
   what they hold; of an element that many items share they send two witnesses,
   so a frequent line, or a text in a third of all rows, costs no more than
   another.  Items that only share a passage end here.
3. *Order.*  Elements that more than HOT of the remaining items share move to the
   end of the global order, so lists of a head are short unless an item consists
   of such elements.  Items go that have fewer shared elements than T with the smallest item of
   matching size that any list of their heads holds.
4. *Merge.*  Lists of the heads give candidates: each item with a few pivots of
   its list, in rounds with other pivots; what is linked leaves the next round.  Then,
   in lists that still hold several components, items are compared by their differences
   from a centre of the list.  Those that are close enough together meet one item, the
   closest to the centre.  The few that are far count their differences in the merged lists
   of the others', which is an exact overlap, so no link between components is lost and no
   pair leaves a task but those that connect.  A family of thousands of near copies costs one
   probe a member, list and round, not all pairs; only its outliers meet the others' differences.
5. *Components* of all links.

Probing is a search of one sorted set in the other.  Else the global order is
that of the hashes.  All counts are exact up to equality of 64-bit hashes.

Null texts and texts without words have an empty set and link with nothing.
Rows that repeat an id are all returned.  Ids are integers; a row without one
joins no others but those of an equal set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import ids_and_text, shuffle_width
from leafmill.llm.components import components
from leafmill.llm.hashing import BASE, RangeHash, byte_table, mix, pieces, texts_as_bytes
from leafmill.session import bound_batches, ship_package, through_table

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
HOLD_ROWS = 1 << 19  # list entries a map task holds before it sends them; sorting takes several times their 16 to 40 bytes
PIECE_BYTES = 1 << 17  # of text whose shingles are made at a time
MANY = 8  # local items from which an element counts as shared by many
HOT = 16  # items an element of a short list has at most
CELL_ITEMS = 4096  # of a ring that meet in one task
ROUNDS, PIVOTS = 2, 3  # rounds of pivots, and pivots of a list in each
MARK_BITS = 26  # of the bit map of chosen documents: 8 MB whatever their number
PAIR = np.dtype([("gram", "<u8"), ("item", "<i8")])


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in ``data``, and the row each word is in."""
    base, stop = int(ends[0]), int(ends[-1])
    text = LOWER[data[base:stop]]
    ends = ends - base
    inside = ~IS_SPACE[text]
    # A word starts after white space or at a text's start.
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < ends[1:]]
    starts_here[first] |= inside[first]
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    last = ends[1:][ends[:-1] < ends[1:]] - 1
    ends_here[last] |= inside[last]
    starts, stops = np.flatnonzero(starts_here), np.flatnonzero(ends_here) + 1
    rows = np.searchsorted(ends, starts, side="right") - 1
    return RangeHash(text)(starts, stops), rows


def gram_sets(data: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each row, sorted by row and hash, and where each row's begin.

    A row with fewer than n words has its whole sequence as its only gram.
    """
    words, rows = word_hashes(data, ends)
    count = len(ends) - 1
    per_row = np.bincount(rows, minlength=count)
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    factors = byte_table(5)[:n] | np.uint64(1)
    grams_in = np.where(per_row >= n, per_row - n + 1, np.minimum(per_row, 1))
    owner = np.repeat(np.arange(count), grams_in)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(grams_in) - grams_in, grams_in)
    at = bounds[:-1][owner] + offset
    room = bounds[1:][owner]
    total = np.zeros(len(owner), np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    for j in range(n):
        total += np.where(at + j < room, padded[at + j], np.uint64(0)) * factors[j]
    short = np.minimum(per_row, n).astype(np.uint64)[owner]
    grams = mix(total + short * BASE)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[fresh], owner[fresh]
    return grams, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))])


def set_ids(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 63-bit number for each set, the same for equal sets; of the empty set -1."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams ^ BASE), out=sums[1:])
    sizes = np.diff(bounds)
    found = mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64) * BASE) >> np.uint64(1)
    return np.where(sizes > 0, found.astype(np.int64), -1)


def _need(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Elements that a partner of a set of this size must share at least."""
    return -(-sizes * percent // 100)


def _head(sizes: np.ndarray, percent: int, extra: np.ndarray | int) -> np.ndarray:
    return np.minimum(sizes, sizes - _need(sizes, percent) + extra)


def extra_of(sizes: np.ndarray) -> np.ndarray:
    """k of the occurrence filter."""
    return np.maximum(1, sizes // 10)


def _take_heads(bounds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the first ``lengths`` grams of each set."""
    return np.repeat(bounds[:-1] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _sizes(n: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most=PIECE_BYTES):
                grams, bounds = gram_sets(*texts_as_bytes(piece.column("text")), n)
                yield pa.record_batch([piece.column("doc_id"), pa.array(set_ids(grams, bounds)), pa.array(np.diff(bounds))],
                                      names=["doc_id", "item", "n_shingles"])

    return make


def _sets(n: int, marks):
    """Sets of the documents in a bit map; a few others pass, which changes no result."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((marks.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
            for piece in pieces(batch, most=PIECE_BYTES):
                grams, bounds = gram_sets(*texts_as_bytes(piece.column("text")), n)
                filled = np.flatnonzero(np.diff(bounds))
                blobs = pa.array([grams[bounds[i] : bounds[i + 1]].tobytes() for i in filled], pa.binary())
                yield pa.record_batch([pa.array(set_ids(grams, bounds)[filled]), blobs], names=["item", "grams"])

    return make


def bit_map(ids: DataFrame) -> np.ndarray:
    """Hashed ids as a bit map of fixed size, put together in blocks of 4 KB."""
    place = ids.select(_place("doc_id").alias("place"))
    blocks = place.groupBy((F.col("place") / 32768).cast("int").alias("block")).agg(
        F.bitmap_construct_agg((F.col("place") % 32768).cast("long")).alias("bits")).collect()
    found = np.zeros(1 << MARK_BITS - 3, np.uint8)
    for block in blocks:
        found[block["block"] * 4096 : (block["block"] + 1) * 4096] = np.frombuffer(bytes(block["bits"]), np.uint8)
    return found


def _place(column: str):
    return F.pmod(F.xxhash64(column), F.lit(1 << MARK_BITS))


def _unique_pairs(pairs: np.ndarray) -> np.ndarray:
    pairs = pairs[np.lexsort((pairs["item"], pairs["gram"]))]
    if not len(pairs):
        return pairs
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (pairs["gram"][1:] != pairs["gram"][:-1]) | (pairs["item"][1:] != pairs["item"][:-1])
    return pairs[fresh]


def _runs(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(grams)))


def _by_bucket(values: np.ndarray, buckets: np.ndarray, kind: str) -> Iterator[tuple[int, str, bytes]]:
    order = np.argsort(buckets, kind="stable")
    values, buckets = values[order], buckets[order]
    starts, lengths = _runs(buckets)
    for a, m in zip(starts, lengths):
        yield int(buckets[a]), kind, values[a : a + m].tobytes()


def _counted(items: np.ndarray) -> np.ndarray:
    found, times = np.unique(items, return_counts=True)
    return np.column_stack([found, times]).astype("<i8")


def _bucket_of(values: np.ndarray, width: int) -> np.ndarray:
    return (mix(values ^ np.uint64(77)) % np.uint64(width)).astype(np.int32)


def _blob_batch(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.binary())],
                           names=["bucket", "kind", "data"])


def _send_heads(n: int, percent: int, width: int):
    """Merge the lists of heads within a task; send pairs, witnesses of frequent elements, and finished counts."""
    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs = _unique_pairs(np.concatenate(held))
        _, lengths = _runs(pairs["gram"])
        many = np.repeat(lengths >= MANY, lengths)
        known = np.unique(pairs["gram"][many])
        counts = _counted(pairs["item"][many])
        pairs = pairs[~many]
        rows = list(_by_bucket(pairs, _bucket_of(pairs["gram"], width), "pairs"))
        rows += _by_bucket(known, _bucket_of(known, width), "shared")
        rows += _by_bucket(counts, _bucket_of(counts[:, 0].astype(np.uint64), width), "counts")
        return _blob_batch(rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch, most=PIECE_BYTES):
                grams, bounds = gram_sets(*texts_as_bytes(piece.column("text")), n)
                sizes = np.diff(bounds)
                lengths = _head(sizes, percent, extra_of(sizes))
                pairs = np.empty(lengths.sum(), PAIR)
                pairs["gram"] = grams[_take_heads(bounds, lengths)]
                pairs["item"] = np.repeat(set_ids(grams, bounds), lengths)
                held.append(pairs)
                size += len(pairs)
                if size >= HOLD_ROWS:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    return make


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket of lists: how many elements of each item another item has too."""
    parts: dict[str, list[bytes]] = {"pairs": [], "shared": [], "counts": []}
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
            parts[kind].append(data)
    pairs = _unique_pairs(np.frombuffer(b"".join(parts["pairs"]), PAIR))
    known = np.unique(np.frombuffer(b"".join(parts["shared"]), "<u8"))
    _, lengths = _runs(pairs["gram"])
    shared = np.repeat(lengths > 1, lengths) | np.isin(pairs["gram"], known)
    counts = np.concatenate([_counted(pairs["item"][shared]), np.frombuffer(b"".join(parts["counts"]), "<i8").reshape(-1, 2)])
    yield pa.record_batch([pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["item", "times"])


def _send_all(width: int):
    """All elements of the remaining sets, to count them; those hot within a task are known at once."""
    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs = _unique_pairs(np.concatenate(held))
        _, lengths = _runs(pairs["gram"])
        hot = np.repeat(lengths > HOT, lengths)
        known = np.unique(pairs["gram"][hot])
        rows = list(_by_bucket(pairs[~hot], _bucket_of(pairs["gram"][~hot], width), "pairs"))
        rows += _by_bucket(known, _bucket_of(known, width), "shared")
        rows += _by_bucket(pairs[hot], _bucket_of(pairs["item"][hot].astype(np.uint64), width), "hot")
        return _blob_batch(rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sets = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column("grams")]
            if not sets:
                continue
            pairs = np.empty(sum(map(len, sets)), PAIR)
            pairs["gram"] = np.concatenate(sets)
            pairs["item"] = np.repeat(batch.column("item").to_numpy(), [len(x) for x in sets])
            held.append(pairs)
            size += len(pairs)
            if size >= HOLD_ROWS:
                yield send(held)
                held, size = [], 0
        if held:
            yield send(held)

    return make


def _mark_hot(width: int):
    """Of one bucket of elements: the shared and the hot ones, sent to the bucket of their item."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, shared, done = _kinds(batches, PAIR, "<u8", PAIR)
        pairs = _unique_pairs(pairs)
        _, lengths = _runs(pairs["gram"])
        length = np.repeat(lengths, lengths)
        hot = (length > HOT) | np.isin(pairs["gram"], np.unique(shared))
        found = np.concatenate([pairs[hot], done])
        cold = _counted(pairs["item"][~hot & (length > 1)])
        rows = list(_by_bucket(found, _bucket_of(found["item"].astype(np.uint64), width), "hot"))
        rows += _by_bucket(cold, _bucket_of(cold[:, 0].astype(np.uint64), width), "counts")
        yield _blob_batch(rows)

    return make


def _kinds(batches: Iterator[pa.RecordBatch], *types) -> list[np.ndarray]:
    parts: dict[str, list[bytes]] = {"pairs": [], "shared": [], "hot": []}
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
            parts[kind].append(data)
    return [np.frombuffer(b"".join(parts[k]), t) for k, t in zip(parts, types)]


def _marks_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each item of a bucket: how many shared elements it has, and its hot ones."""
    parts: dict[str, list[bytes]] = {"hot": [], "counts": []}
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
            parts[kind].append(data)
    found = np.frombuffer(b"".join(parts["hot"]), PAIR)
    found = found[np.argsort(found["item"], kind="stable")]
    starts, sizes = _runs(found["item"])
    cold = np.frombuffer(b"".join(parts["counts"]), "<i8").reshape(-1, 2)
    items, place = np.unique(np.concatenate([found["item"], cold[:, 0]]), return_inverse=True)
    times = np.bincount(place, weights=np.concatenate([np.ones(len(found)), cold[:, 1]]), minlength=len(items)).astype(np.int64)
    blobs: list[bytes] = [b""] * len(items)
    for at, a, m in zip(np.searchsorted(items, found["item"][starts]), starts, sizes):
        blobs[at] = found["gram"][a : a + m].tobytes()
    yield pa.record_batch([pa.array(items), pa.array(times), pa.array(blobs, pa.binary())], names=["item", "times", "hot"])


def _heads(percent: int):
    """The head of each set, hot elements last; items with too few shared elements go."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sizes, shared, heads = [], [], [], []
            for item, blob, times, hot in zip(*(batch.column(c).to_pylist() for c in ("item", "grams", "times", "hot"))):
                grams = np.frombuffer(blob, "<u8")
                size = np.array([len(grams)])
                if times < _need(size, percent)[0]:
                    continue
                late = np.isin(grams, np.frombuffer(hot, "<u8"))
                items.append(item)
                sizes.append(len(grams))
                shared.append(times)
                heads.append(np.concatenate([grams[~late], grams[late]])[: _head(size, percent, 1)[0]].tobytes())
            yield pa.record_batch([pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64()), pa.array(heads, pa.binary())],
                                  names=["item", "size", "times", "head"])

    return make


ENTRY = np.dtype([("gram", "<u8"), ("size", "<i8"), ("item", "<i8"), ("root", "<i8")])
MEMBER = np.dtype([*ENTRY.descr, ("degree", "<i8")])
RING = ("centre", "class", "item", "size", "root")
CELL = ("centre", "class", "part", "turn")


def _rank(items: np.ndarray, turn: int, pivot: int = 0) -> np.ndarray:
    return mix(items.astype(np.uint64) ^ np.uint64(turn * PIVOTS + pivot + 1) * BASE)


def _sorted_runs(entries: np.ndarray, rank: np.ndarray) -> Iterator[np.ndarray]:
    """Each list that holds several components, sorted by rank."""
    entries = entries[np.lexsort((rank, entries["gram"]))]
    starts, lengths = _runs(entries["gram"])
    for a, m in zip(starts[lengths > 1], lengths[lengths > 1]):
        found = entries[a : a + m]
        if (found["root"] != found["root"][0]).any():
            yield found


MATE = np.dtype([("item", "<i8"), ("least", "<i8")])


def _least_by_item(mates: np.ndarray) -> np.ndarray:
    mates = mates[np.lexsort((mates["least"], mates["item"]))]
    return mates[_runs(mates["item"])[0]]


def _mates(percent: int, width: int):
    """For each item of a list the least size of another one that matches its own; sent to the item's bucket."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, _ = _received(batches)
        held = [np.zeros(0, MATE)]
        for run in _sorted_runs(entries, entries["size"]):
            sizes = run["size"]
            at = np.searchsorted(sizes, _need(sizes, percent))
            at += at == np.arange(len(sizes))  # not the item itself
            least = sizes[np.minimum(at, len(sizes) - 1)]
            fits = (at < len(sizes)) & (least * percent <= sizes * 100)
            mates = np.empty(fits.sum(), MATE)
            mates["item"], mates["least"] = run["item"][fits], least[fits]
            held.append(mates)
        found = _least_by_item(np.concatenate(held))
        yield _blob_batch(list(_by_bucket(found, _bucket_of(found["item"].astype(np.uint64), width), "mates")))

    return make


def _least_mates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = _least_by_item(np.frombuffer(b"".join(x for batch in batches for x in batch.column("data").to_pylist()), MATE))
    yield pa.record_batch([pa.array(found["item"]), pa.array(found["least"])], names=["item", "least"])


def with_partners(heads: DataFrame, percent: int, width: int) -> DataFrame:
    """Items whose shared elements suffice for the smallest partner that their lists hold.

    All elements two items have in common are shared ones, so an item with fewer
    than T of them links with none.
    """
    blob = "bucket int, kind string, data binary"
    lists = heads.select("item", "size", "head", F.col("item").alias("root")).mapInArrow(_send_lists(percent, width, None), blob)
    mates = lists.repartitionById(width, "bucket").mapInArrow(_mates(percent, width), blob)
    least = mates.repartitionById(width, "bucket").mapInArrow(_least_mates, "item long, least long")
    need = F.expr(f"({percent} * (size + least) + {99 + percent}) div {100 + percent}")
    return heads.join(least, "item").filter(F.col("times") >= need).select("item", "size", "head")


def _with_pivots(entries: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a ranked list with its first entry, and a mask of the entries whose size that one can match."""
    sizes, pivot = entries["size"], entries[0]
    fits = (sizes * percent <= pivot["size"] * 100) & (pivot["size"] * percent <= sizes * 100)
    others = entries["item"][fits & (entries["root"] != pivot["root"])]
    return np.column_stack([np.minimum(others, pivot["item"]), np.maximum(others, pivot["item"])]), fits


def _send_lists(percent: int, width: int, turn: int | None, kind: np.dtype = ENTRY):
    """Entries of the heads' lists.  In a round of pivots a long list meets its own pivot here and sends that one only."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column("head")]
            if not heads:
                continue
            lengths = [len(h) for h in heads]
            entries = np.empty(sum(lengths), kind)
            entries["gram"] = np.concatenate(heads)
            for name in kind.names[1:]:
                entries[name] = np.repeat(batch.column(name).to_numpy(), lengths)
            rows = []
            if turn is not None:
                entries = entries[np.lexsort((_rank(entries["item"], turn), entries["gram"]))]
                starts, sizes = _runs(entries["gram"])
                sent, pairs = np.ones(len(entries), bool), [np.zeros((0, 2), np.int64)]
                for a, m in zip(starts[sizes >= MANY], sizes[sizes >= MANY]):
                    found, fits = _with_pivots(entries[a : a + m], percent)
                    pairs.append(found)
                    sent[a + 1 : a + m] = ~fits[1:]
                entries = entries[sent]
                pairs = np.unique(np.concatenate(pairs), axis=0)
                rows += _by_bucket(pairs, _bucket_of(pairs[:, 0].astype(np.uint64), width), "pairs")
            rows += _by_bucket(entries, _bucket_of(entries["gram"], width), "lists")
            yield _blob_batch(rows)

    return make


def _received(batches: Iterator[pa.RecordBatch], entry: np.dtype = ENTRY) -> tuple[np.ndarray, np.ndarray]:
    parts: dict[str, list[bytes]] = {"lists": [], "pairs": []}
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
            parts[kind].append(data)
    return np.frombuffer(b"".join(parts["lists"]), entry), np.frombuffer(b"".join(parts["pairs"]), "<i8").reshape(-1, 2)


def _pair_batches(found: Iterator[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    """Pairs on their way to the bucket of their first item, where they meet those found in other lists."""
    for pairs in found:
        if len(pairs):
            yield _blob_batch(list(_by_bucket(pairs, _bucket_of(pairs[:, 0].astype(np.uint64), width), "pairs")))


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    data = b"".join(x for batch in batches for x in batch.column("data").to_pylist())
    pairs = np.unique(np.frombuffer(data, "<i8").reshape(-1, 2), axis=0)
    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _collected(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Distinct pairs, in portions."""
    held, size = [], 0
    for pairs in parts:
        held.append(pairs)
        size += len(pairs)
        if size >= HOLD_ROWS:
            yield np.unique(np.concatenate(held), axis=0)
            held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), axis=0)


def _pivot_pairs(percent: int, turn: int, width: int):
    """Entries of a list with the entry of least rank in this round."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, pairs = _received(batches)

        def found() -> Iterator[np.ndarray]:
            yield pairs
            for pivot in range(PIVOTS):
                for run in _sorted_runs(entries, _rank(entries["item"], turn, pivot)):
                    yield _with_pivots(run, percent)[0]

        return _pair_batches(_collected(found()), width)

    return make


def _size_class(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that match are in the same class or in neighbouring ones."""
    return np.floor(np.log(sizes) / np.log(101 / percent)).astype(np.int64)  # a little wider than 100 / percent, for the rounding


def _rings(percent: int):
    """Of each list that holds several components: its entries with a centre of about their size, the one with the most links."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, _ = _received(batches, MEMBER)

        def found() -> Iterator[np.ndarray]:
            for run in _sorted_runs(entries, entries["item"]):
                own = _size_class(run["size"], percent)
                run, size = np.concatenate([run, run]), np.concatenate([own, own + 1])
                order = np.lexsort((run["item"], -run["degree"], size))
                run, size = run[order], size[order]
                starts, lengths = _runs(size)
                several = np.minimum.reduceat(run["root"], starts) != np.maximum.reduceat(run["root"], starts)
                keep = np.repeat(several, lengths)
                yield np.column_stack([np.repeat(run["item"][starts], lengths), size, run["item"], run["size"], run["root"]])[keep]

        for rows in _collected(found()):
            yield pa.record_batch([pa.array(rows[:, k]) for k in range(5)], names=["centre", "class", "item", "size", "root"])

    return make


def _differences(percent: int):
    """The elements that an item and its centre do not share, and the item's score: two items of scores that add up to 0 or less link."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = [np.setxor1d(np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8"), assume_unique=True).view(np.int64)
                     for a, b in zip(batch.column("grams"), batch.column("centre_grams"))]
            n = np.array([len(x) for x in apart], np.int64)
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            score = (100 + percent) * n - (100 - percent) * batch.column("size").to_numpy()
            yield pa.record_batch(
                [*(batch.column(c) for c in RING), pa.array(n), pa.array(score),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *apart])))],
                names=[*RING, "n", "score", "apart"])

    return make


def _meet(percent: int):
    """Of rows sorted by cell, its members before those that ask: links that join groups, found by merging the lists of the members' differences."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, lists, alias = None, [], None, {}

        def group_of(group: int) -> int:
            while group in alias:
                group = alias[group]
            return group

        for batch in batches:
            ends, grams = batch.column("apart").offsets.to_numpy(), batch.column("apart").values.to_numpy()
            cells = zip(*(batch.column(c).to_pylist() for c in CELL))
            found: list[tuple[int, int]] = []
            for k, (cell, asks, item, group, score) in enumerate(zip(cells, *(batch.column(c).to_pylist() for c in ("asks", "item", "group", "score")))):
                if cell != at:
                    at, held, lists, alias = cell, [], None, {}
                apart = grams[ends[k] : ends[k + 1]]
                if not asks:
                    held.append((item, group, score, apart.copy()))
                    continue
                if not held:
                    continue
                if lists is None:
                    items, groups, scores = (np.array([h[c] for h in held], np.int64) for c in range(3))
                    values, owner = np.concatenate([h[3] for h in held]), np.repeat(np.arange(len(held)), [len(h[3]) for h in held])
                    order = np.argsort(values, kind="stable")
                    lists = values[order], owner[order]
                first = np.searchsorted(lists[0], apart)
                lengths = np.searchsorted(lists[0], apart, side="right") - first
                common = np.bincount(lists[1][_take_heads(np.append(first, 0), lengths)], minlength=len(items))
                own = group_of(group)
                links = (2 * (100 + percent) * common >= scores + score) & (groups != own)
                others, one = np.unique(groups[links], return_index=True)
                if len(others):
                    found += [(item, b) for b in items[links][one].tolist()]
                    alias.update((other, own) for other in others.tolist())
                    groups[np.isin(groups, others)] = own
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"])

    return make


def open_links(entries: DataFrame, sets: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) that connect what the items of different components have in common, if any two of them link.

    Two items of a list are compared by their differences from the list's centre: with
    n and m of these, r of them common, they differ in n + m - 2 r elements, and link if
    (100 + percent) times that is at most (100 - percent) times the sum of their sizes.
    For r = 0 this is a sum of two scores, so whoever links with anyone in this way
    links with the item of the least score, and meets that one only.  The others are far:
    they count their differences in the merged lists of the ring's, in cells of at most
    about CELL_ITEMS of each, and of the links only those that join groups leave a cell.
    """
    blob = "bucket int, kind string, data binary"
    lists = entries.mapInArrow(_send_lists(percent, width, None, MEMBER), blob).repartitionById(width, "bucket")
    rings = lists.mapInArrow(_rings(percent), ", ".join(f"{c} long" for c in RING)).distinct()
    grams = sets.dropDuplicates(["item"])
    both = rings.join(grams, "item").join(grams.select(F.col("item").alias("centre"), F.col("grams").alias("centre_grams")), "centre")
    members = through_table(both.mapInArrow(
        _differences(percent), ", ".join(f"{c} long" for c in (*RING, "n", "score")) + ", apart array<long>"), "differences")

    ring, cells = ["centre", "class"], lambda items: F.ceil(F.count("*") / CELL_ITEMS).cast("int").alias(items)
    nearest = through_table(members.groupBy(*ring).agg(F.min(F.struct("score", "item", "root")).alias("nearest"), cells("parts")), "nearest")
    far = F.col("score") + F.col("nearest.score") > 0
    scored = members.join(nearest, ring).withColumn("asks", far).withColumn("group", F.when(far, F.col("root")).otherwise(F.col("nearest.root")))
    near = scored.filter(~F.col("asks") & (F.col("root") != F.col("nearest.root"))).select(
        F.least("item", "nearest.item").alias("a"), F.greatest("item", "nearest.item").alias("b"))
    # Any of the ring's items may link with one that is far, if it has differences enough.
    least = through_table(scored.filter("asks").groupBy(*ring).agg(F.min("score").alias("least"), cells("turns")), "far")
    mixed = scored.join(least, ring)
    one, all_of = lambda count: F.pmod(F.xxhash64("item"), F.col(count)).cast("int"), lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    kept = ("item", "group", "score", "apart")
    partners = mixed.filter(f"score + least <= {2 * (100 + percent)} * n").select(
        *ring, one("parts").alias("part"), all_of("turns").alias("turn"), F.lit(False).alias("asks"), *kept)
    askers = mixed.filter("asks").select(*ring, all_of("parts").alias("part"), one("turns").alias("turn"), "asks", *kept)
    dealt = partners.unionAll(askers).repartition(width, *CELL).sortWithinPartitions(*CELL, "asks")
    return near.unionAll(dealt.mapInArrow(_meet(percent), "a long, b long")).distinct()


def _probe(percent: int):
    """Search the smaller set in the larger one; keep pairs that reach the required overlap."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("grams_a"), batch.column("grams_b")):
                x, y = sorted((np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")), key=len)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return make


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("item").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("item").alias("b"), F.col("grams").alias("grams_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b")
    return both.mapInArrow(_probe(percent), "a long, b long")


def similar_sets(docs: DataFrame, sizes: DataFrame, n: int, percent: int) -> DataFrame:
    """(item, root): components of items that link with another; ``sizes`` is the table of (doc_id, item, n_shingles)."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    blobs = docs.mapInArrow(_send_heads(n, percent, width), "bucket int, kind string, data binary")
    shared = blobs.repartitionById(width, "bucket").mapInArrow(_count_shared, "item long, times long")
    shared = shared.groupBy("item").agg(F.sum("times").alias("times"))
    one_each = sizes.filter("item >= 0").groupBy("item").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("size"))
    remaining = one_each.join(shared, "item").filter(
        F.col("times") >= F.greatest(F.lit(1), F.expr(f"(size * {percent} + 99) div 100 div 10")))  # the smallest partner's k
    marks = spark.sparkContext.broadcast(bit_map(remaining.select("doc_id")))
    marked = docs.select("text", _place("doc_id").alias("place"))
    # An item may come twice or one too many; neither changes a link.
    sets = through_table(marked.mapInArrow(_sets(n, marks), "item long, grams binary"), "gram-sets")

    blob = "bucket int, kind string, data binary"
    marks_of = sets.mapInArrow(_send_all(width), blob).repartitionById(width, "bucket").mapInArrow(_mark_hot(width), blob)
    hot = marks_of.repartitionById(width, "bucket").mapInArrow(_marks_of_items, "item long, times long, hot binary")
    heads = through_table(sets.join(hot, "item").mapInArrow(_heads(percent), "item long, size long, times long, head binary"), "gram-heads")
    heads = through_table(with_partners(heads, percent, width), "open-heads")

    links = roots = None
    for turn in (*range(ROUNDS), None):
        root = F.lit(None).cast("long") if roots is None else F.col("root")
        known = heads if roots is None else heads.join(roots, heads["item"] == roots["node"], "left")
        entries = known.select("item", "size", "head", F.coalesce(root, "item").alias("root"))
        if turn is None:
            ends = links.select(F.explode(F.array("a", "b")).alias("item")).groupBy("item").agg(F.count("*").alias("degree"))
            ranked = entries.join(ends, "item", "left").select(*entries.columns, F.coalesce("degree", F.lit(0)).alias("degree"))
            found = open_links(ranked, sets, percent, width)
        else:
            lists = entries.mapInArrow(_send_lists(percent, width, turn), blob).repartitionById(width, "bucket")
            met = lists.mapInArrow(_pivot_pairs(percent, turn, width), blob)
            pairs = met.repartitionById(width, "bucket").mapInArrow(_distinct_pairs, "a long, b long")
            found = _linked(pairs, sets, percent)
        links = through_table(found if links is None else found.unionAll(links), "links")
        roots = through_table(components(links), "roots")
    return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest doc_id its links reach)."""
    bound_batches(docs.sparkSession)
    ship_package(docs.sparkSession)
    rows = ids_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    sizes = through_table(rows.mapInArrow(_sizes(n), "doc_id long, item long, n_shingles long"), "gram-counts")
    roots = similar_sets(rows, sizes, n, percent)
    labelled = through_table(
        sizes.join(roots, sizes["item"] == roots["node"], "left").select(
            "doc_id", "n_shingles", "item", F.coalesce("root", "item").alias("root")), "labels")
    # A table, so that the join has a shuffle on both sides and can split a large component.
    least = through_table(labelled.filter("item >= 0").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return labelled.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each component, that of the smallest id, with all their columns.

    Rows that repeat an id share one fate; rows without an id stay.
    """
    found = near_duplicates(docs, id_col, text_col, n, percent)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
