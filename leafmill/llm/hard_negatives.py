"""Hard negatives of anchors by bounds along a spanning tree of the anchors.

Scores are inner products of integer vectors.  Anchors a and p with
e = |a - p| have, for every candidate c,

    score(p, c) - e |c|  <=  score(a, c)  <=  score(p, c) + e |c|.

So anchors are put into blocks of one label and near ones (a parent of another
label has scored other candidates), each block with a minimum spanning tree.  A task takes its candidates in chunks and walks every tree from its
root: the root's scores are computed, a child gets an interval for each
candidate from its parent's interval, and only candidates whose interval meets
the window that is asked for are scored exactly (their interval is then a
point).  Two jobs use this for a batch of anchors:

1. *Positives*: rows of the same label whose upper bound reaches the
   ``positives``-th best score known so far; at first that among the anchors of the block.
2. *Negatives*: rows of another label whose interval meets the windows
   low * positive <= 100 * score <= high * positive, raised to the
   ``negatives``-th best score in the window known so far.

A task sends its best rows only, and a ranking by anchor and positive follows.
All candidates meet all anchors of a batch (a stated query set, in blocks);
nothing is dealt by label, so a label with a third of all rows is no hot key.
Batches hold about ``BATCH`` anchors, so what a task holds and what is sent to
tasks is bounded however many anchors there are.

Rows with a null label or id, or a vector that ``integer_vectors`` refuses, take
no part.  Rows that repeat an id each count, but the anchor's own id never;
anchor rows that repeat an id are one anchor, the least by label and vector.
Ties go to the smaller id.  An empty table gives no row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.vectors import integer_vectors, matrix
from leafmill.session import ship_package, through_table, work_dir

BLOCK = 256  # anchors of a tree
BATCH = 1 << 14  # anchors that tasks hold at a time
CHUNK = 1 << 12  # candidates that are scored together
FIRST = 32  # of them scored first
FOUND = "anchor_id long, positive_id long, positive_score long, place int, row_id long, score long"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@dataclass
class Block:
    """Anchors in an order in which parents come before children."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    parent: np.ndarray  # -1 at the root
    edge: np.ndarray  # distance to the parent
    # Positives of each anchor, in order: their ids and scores; empty until they are known.
    positive_ids: list[np.ndarray]
    positive_scores: list[np.ndarray]


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x y' exactly: in doubles or longs where these hold every sum, else as Python's integers."""
    bound = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0)) * x.shape[1]
    if bound < 1 << 53:
        return (x.astype(float) @ y.T.astype(float)).astype(np.int64)
    if bound < 1 << 63:
        return x @ y.T
    found = x.astype(object) @ y.T.astype(object)
    if np.abs(found).max(initial=0) >= 1 << 63:
        raise OverflowError("a score does not fit a long")
    return found.astype(np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents (places in that order) and edge lengths of a minimum spanning tree, by Prim's method."""
    y = x.astype(float)
    norms = (y * y).sum(axis=1)
    n = len(x)
    near, link = np.full(n, np.inf), np.full(n, -1)
    place, left = np.full(n, -1), np.ones(n, bool)
    order, at = [], 0
    for k in range(n):
        place[at], left[at] = k, False
        order.append(at)
        gap = np.maximum(norms + norms[at] - 2 * (y @ y[at]), 0)
        closer = left & (gap < near)
        near[closer], link[closer] = gap[closer], at
        if left.any():
            at = int(np.where(left, near, np.inf).argmin())
    order = np.array(order)
    parent = np.where(link[order] >= 0, place[link[order]], -1)
    edge = np.array([0.0 if p < 0 else float(np.linalg.norm(y[o] - y[order[p]])) for o, p in zip(order, parent)])
    return order, parent, edge


def _trees(block: int):
    """Anchors of a partition, sorted by place, as blocks with their trees."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def built(table: pa.Table) -> pa.RecordBatch:
            (batch,) = table.combine_chunks().to_batches()
            x = matrix(batch)
            order, parent, edge = spanning_tree(x)
            none = [np.zeros(0, np.int64)] * len(order)
            found = Block(batch.column("anchor").to_numpy()[order], batch.column("label").to_numpy()[order], x[order], parent, edge, none, none)
            return pa.record_batch([pa.array([len(order)], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], names=["size", "block"])

        for batch in batches:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            while rest.num_rows >= 2 * block:
                yield built(rest.slice(0, block))
                rest = rest.slice(block)
        if rest is not None and rest.num_rows:
            half = rest.num_rows if rest.num_rows <= block else rest.num_rows // 2
            for start in range(0, rest.num_rows, half):
                yield built(rest.slice(start, half))

    return make


def _near_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A code of 16 fixed random half-spaces: near vectors agree in most of it."""
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch).astype(float)
            planes = np.random.default_rng(12).standard_normal((x.shape[1], 16))
            code = ((x @ planes > 0) @ (1 << np.arange(15, -1, -1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])


def anchor_blocks(anchors: DataFrame, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """(part, size, block): trees over all anchors (anchor, label, x); several parts, of near anchors each, make a batch."""
    count = anchors.count()
    coded = anchors.mapInArrow(_near_first, "anchor long, label long, x array<long>, code int")
    parts = max(1, -(-2 * count // batch))
    ranged = coded.repartitionByRange(parts, "label", "code", "anchor").sortWithinPartitions("label", "code", "anchor")
    numbered = ranged.select("anchor", "label", "x").mapInArrow(_trees(block), "size int, block binary")
    return through_table(numbered.withColumn("part", F.spark_partition_id()), "anchor-blocks")


def batches_of(blocks: DataFrame, batch: int) -> list[tuple[int, int]]:
    """First and last part of each batch: neighbours together until they would hold more than ``batch`` anchors."""
    found: list[tuple[int, int]] = []
    held = 0
    for part, size in blocks.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").collect():
        if found and held + size <= batch:
            found[-1], held = (found[-1][0], part), held + size
        else:
            found.append((part, part))
            held = size
    return found


class Best:
    """The ``most`` best (score, id) pairs seen, higher scores first, ties by smaller id, and the least score that can still enter."""

    def __init__(self, most: int, least: int | None = None):
        self.most, self.floor = most, least
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.floor is not None:
            keep = scores >= self.floor
            scores, ids = scores[keep], ids[keep]
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.most]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.most:
            self.floor = int(self.scores[-1]) if self.floor is None else max(self.floor, int(self.scores[-1]))


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score with low * positive <= 100 * score <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


class Wanted:
    """What an anchor still asks for: windows of scores and the best rows in each."""

    def __init__(self, block: Block, k: int, positives: int, negatives: int, low: int, high: int, negative: bool):
        self.negative, self.label, self.own = negative, block.labels[k], block.ids[k]
        scores = block.positive_scores[k] if negative else np.zeros(1)
        self.windows = [window(int(s), low, high) if negative else (None, None) for s in scores]
        self.best = [Best(negatives if negative else positives, lo) for lo, _ in self.windows]

    def learn(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Floors from some rows that will come again; they are not kept."""
        use = ((labels != self.label) if self.negative else (labels == self.label)) & (ids != self.own)
        for best, (_, hi) in zip(self.best, self.windows):
            found = scores[use] if hi is None else scores[use & (scores <= hi)]
            found = np.sort(found)[::-1]
            if len(found) >= best.most:
                floor = int(found[best.most - 1])
                best.floor = floor if best.floor is None else max(best.floor, floor)

    def range(self) -> tuple[float, float]:
        """Scores that can still matter."""
        least = min((-np.inf if b.floor is None else b.floor for b in self.best), default=np.inf)
        most = max((np.inf if hi is None else hi for _, hi in self.windows), default=-np.inf)
        return least, most

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for best, (_, hi) in zip(self.best, self.windows):
            keep = slice(None) if hi is None else scores <= hi
            best.add(scores[keep], ids[keep])


def walk(block: Block, wanted: list[Wanted], ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> int:
    """Give every anchor of a tree the candidates it may want, with exact scores; returns how many were scored."""
    norms = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    children = np.bincount(block.parent[block.parent >= 0], minlength=len(block.ids))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scored = 0
    for k, want in enumerate(wanted):
        allowed = ((labels != want.label) if want.negative else (labels == want.label)) & (ids != want.own)
        parent = block.parent[k]
        if parent < 0:
            exact = products(x, block.x[k : k + 1])[:, 0]
            scored += len(x)
            low = high = exact.astype(float)
            least, most = want.range()
            hits = np.flatnonzero(allowed & (exact >= least) & (exact <= most))
            found = exact[hits]
        else:
            up_low, up_high = bounds[parent]
            reach = block.edge[k] * norms
            reach = reach * (1 + 1e-9) + 1e-9 * np.maximum(np.abs(up_low), np.abs(up_high)) + 1
            low, high = up_low - reach, up_high + reach
            least, most = want.range()
            hits = np.flatnonzero(allowed & (high >= least) & (low <= most))
            if len(hits) > 4 * FIRST:  # the most promising ones first: they raise the floor for the others
                middle = (up_low + up_high)[hits] / 2
                far = -middle if np.isinf(most) else np.abs(middle - most)
                early = hits[np.argpartition(far, FIRST)[:FIRST]]
                found = products(x[early], block.x[k : k + 1])[:, 0]
                low[early] = high[early] = found
                want.add(found, ids[early])
                scored += FIRST
                least, most = want.range()
                allowed[early] = False
                hits = hits[allowed[hits] & (high[hits] >= least) & (low[hits] <= most)]
            found = products(x[hits], block.x[k : k + 1])[:, 0]
            scored += len(hits)
            low[hits] = high[hits] = found
            children[parent] -= 1
            if not children[parent]:
                del bounds[parent]
        if children[k]:
            bounds[k] = low, high
        want.add(found, ids[hits])
    return scored


def _mine(blocks, negative: bool, positives: int, negatives: int, low: int, high: int):
    """A task's best rows for each anchor (and positive)."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: list[Block] = [pickle.loads(b) for b in blocks.value]
        wanted = [[Wanted(t, k, positives, negatives, low, high, negative) for k in range(len(t.ids))] for t in trees]
        for tree, own in zip(trees, wanted):
            among = products(tree.x, tree.x)
            for k, want in enumerate(own):
                want.learn(among[k], tree.ids, tree.labels)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                chunk = batch.slice(start, CHUNK)
                ids, labels, x = chunk.column("row_id").to_numpy(), chunk.column("label").to_numpy(), matrix(chunk)
                for tree, own in zip(trees, wanted):
                    walk(tree, own, ids, labels, x)
        for tree, own in zip(trees, wanted):
            parts: list[list[np.ndarray]] = [[] for _ in range(6)]
            for k, want in enumerate(own):
                for place, best in enumerate(want.best):
                    m = len(best.ids)
                    positive = (tree.positive_ids[k][place], tree.positive_scores[k][place]) if negative else (0, 0)
                    for column, value in zip(parts, (tree.ids[k], *positive, place)):
                        column.append(np.full(m, value, np.int64))
                    parts[4].append(best.ids)
                    parts[5].append(best.scores)
            columns = [np.concatenate(p) for p in parts]
            columns[3] = columns[3].astype(np.int32)
            yield pa.record_batch([pa.array(c) for c in columns], names=["anchor_id", "positive_id", "positive_score", "place", "row_id", "score"])

    return make


def _best_of_all(found: DataFrame, most: int) -> DataFrame:
    """The best rows of each anchor and place, ranked from 1; each task sends at most ``most`` of a group to the shuffle."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(df: DataFrame, vec_id: Column, label: Column, vector: Column, is_anchor: Column, scale: int = 256, positives: int = 5,
         negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """``RESULT``: for each anchor and positive the best negatives in the window of ``low`` to ``high`` per cent of the positive's score."""
    spark = df.sparkSession
    ship_package(spark)
    clean = integer_vectors(df, vector, scale, row_id=vec_id.cast("long"), label=label.cast("long"), anchor=is_anchor)
    rows = through_table(clean.filter("row_id is not null and label is not null"), "candidates")
    anchors = rows.filter("anchor").groupBy(F.col("row_id").alias("anchor")).agg(F.min(F.struct("label", "x")).alias("own"))
    blocks = anchor_blocks(anchors.select("anchor", "own.label", "own.x"), block, batch)
    out = work_dir(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    candidates = rows.select("row_id", "label", "x")
    for from_, to in batches_of(blocks, batch):
        trees = [pickle.loads(bytes(r["block"])) for r in blocks.filter(F.col("part").between(from_, to)).select("block").collect()]  # about BATCH anchors
        sent = spark.sparkContext.broadcast([pickle.dumps(t) for t in trees])
        found = _best_of_all(candidates.mapInArrow(_mine(sent, False, positives, negatives, low, high), FOUND), positives)
        near: dict[int, list[tuple[int, int, int]]] = {}
        for r in found.select("anchor_id", "rank", "row_id", "score").collect():  # ``positives`` an anchor of the batch
            near.setdefault(r["anchor_id"], []).append((r["rank"], r["row_id"], r["score"]))
        for tree in trees:
            ranked = [sorted(near.get(int(i), [])) for i in tree.ids]
            tree.positive_ids = [np.array([p[1] for p in own], np.int64) for own in ranked]
            tree.positive_scores = [np.array([p[2] for p in own], np.int64) for own in ranked]
        known = spark.sparkContext.broadcast([pickle.dumps(t) for t in trees])
        best = _best_of_all(candidates.mapInArrow(_mine(known, True, positives, negatives, low, high), FOUND), negatives)
        best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")).write.mode("append").parquet(out)
        sent.unpersist()
        known.unpersist()
    return spark.read.schema(schema).parquet(out)
