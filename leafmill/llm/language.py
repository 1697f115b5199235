"""Language identification with language-bitmask n-gram filters.

Letter trigrams that are frequent in a language are put into one Bloom filter
whose slots hold a bit for each language (the filters of all languages, bit-
sliced).  A look-up ANDs the slots of a trigram and so returns all languages
that have it at once.  Of a document, set bits are counted for each language,
the count that false positives explain is taken off, and the largest decides.

Learning counts the trigrams of all labelled texts: map tasks fold them, one
aggregation sums them.  A trigram is kept where it makes up ``least_share`` of
its language, so a language has at most 1 / least_share of them and the filter
has a size that does not grow with the corpus.

Trigrams stand within words, which are runs of letters in lower case with a
space on both sides; so every letter is the middle of one.  A text that is null
or has no letter is ``und`` with score 0.  With no labelled text all is ``und``.
Rows that repeat an id are predicted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.hashing import mix, pieces
from leafmill.session import bound_batches, ship_package

UNKNOWN = "und"
HASHES = 3
SLOTS_A_GRAM = 16
HOLD = 1 << 19  # trigrams that a task holds before it folds them; sorting takes several times their 8 bytes
PIECE_BYTES = 1 << 17  # of text whose trigrams are made at a time
SPACE = np.uint64(32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all texts as numbers (21 bits a character), and the text each is in."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    codes = np.where(_letters()[codes], codes, SPACE)
    gap = codes == SPACE
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    places = np.flatnonzero(keep)
    codes = codes[keep]
    grams = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    inside = codes[1:-1] != SPACE
    return grams[inside], np.searchsorted(ends, places[1:-1][inside] - 1, side="right")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def fold() -> pa.RecordBatch:
        langs, grams, times = [], [], []
        for lang, parts in held.items():
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            langs += [lang] * len(found)
            grams.append(found.view(np.int64))
            times.append(n)
        none = np.zeros(0, np.int64)
        return pa.record_batch([pa.array(langs, pa.string()), pa.array(np.concatenate([none, *grams])), pa.array(np.concatenate([none, *times]))],
                               names=["lang", "gram", "n"])

    for batch in batches:
        for piece in pieces(batch, most=PIECE_BYTES):
            names = np.array(piece.column("lang").to_pylist(), dtype=object)
            grams, rows = trigrams(piece.column("text").to_pylist())
            for lang in set(names):
                held.setdefault(lang, []).append(grams[(names == lang)[rows]])
            size += len(grams)
            if size >= HOLD:
                yield fold()
                held.clear()
                size = 0
    yield fold()


@dataclass
class Filters:
    """The bit-sliced filters: ``slots`` has one column of words for each 64 languages."""

    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(grams: dict[str, list[int]]) -> Filters:
        langs = list(grams)
        total = sum(map(len, grams.values()))
        size = 1 << max(10, (SLOTS_A_GRAM * total - 1).bit_length())
        slots = np.zeros((size, -(-len(langs) // 64)), np.uint64)
        fill = []
        for i, lang in enumerate(langs):
            bit = np.uint64(1 << i % 64)
            for at in places(np.array(grams[lang], np.int64).view(np.uint64), size):
                slots[at, i // 64] |= bit
            fill.append(((slots[:, i // 64] & bit) != 0).mean())
        return Filters(langs, slots, np.array(fill) ** HASHES)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """All languages that contain each trigram, as bit masks."""
        found = None
        for at in places(grams, len(self.slots)):
            found = self.slots[at] if found is None else found & self.slots[at]
        return found

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (its share of all corrected counts) and number of trigrams of each text."""
        grams, rows = trigrams(texts)
        total = np.bincount(rows, minlength=len(texts))
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), total
        masks = self.masks(grams)
        hits = np.empty((len(self.langs), len(texts)))
        for i in range(len(self.langs)):
            bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits[i] = np.bincount(rows, weights=bit, minlength=len(texts))
        rate = self.false_rate[:, None]
        true = np.maximum((hits - total * rate) / np.maximum(1 - rate, 1e-9), 0)
        best = np.argmax(true, axis=0)
        every = true.sum(axis=0)
        score = np.where(every > 0, true[best, np.arange(len(texts))] / np.maximum(every, 1e-9), 1 / len(self.langs))
        langs = [self.langs[b] if n else UNKNOWN for b, n in zip(best, total)]
        return langs, np.where(total > 0, score, 0.0), total


def places(grams: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Slots of each trigram, one array for each hash."""
    h = mix(grams)
    for j in range(HASHES):
        yield ((h >> np.uint64(21 * j)) & np.uint64(size - 1)).astype(np.int64) if size <= 1 << 21 else (
            mix(h + np.uint64(j)) & np.uint64(size - 1)).astype(np.int64)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", least_share: float = 1e-4) -> Filters:
    """Filters from all rows with a text and a language.

    At most 1 / least_share trigrams of each language reach the driver.
    """
    bound_batches(labelled.sparkSession)
    ship_package(labelled.sparkSession)
    rows = labelled.select(labelled[lang_col].cast("string").alias("lang"), labelled[text_col].cast("string").alias("text"))
    counts = rows.filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(_count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # Languages are few: one row each.
    common = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * least_share)
    found = common.select("lang", "gram", "total").collect()
    order, grams = {}, {}
    for r in found:
        order[r.lang] = r.total
        grams.setdefault(r.lang, []).append(r.gram)
    return Filters.build({lang: sorted(grams[lang]) for lang in sorted(order, key=lambda x: (-order[x], x))})


def _predict(model):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most=PIECE_BYTES):
                langs, score, total = model.value.decide(piece.column("text").to_pylist())
                out = piece.drop_columns(["text"])
                yield out.append_column("lang_pred", pa.array(langs, pa.string())).append_column(
                    "score", pa.array(score)).append_column("n_grams", pa.array(total))

    return make


def identify(docs: DataFrame, model: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, lang_pred, score, n_grams."""
    bound_batches(docs.sparkSession)
    ship_package(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by least_share, not by the corpus
    return rows.mapInArrow(_predict(shared), f"doc_id {kind}, lang_pred string, score double, n_grams long")


def keep_known(docs: DataFrame, model: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose language is known, with all their columns; the others have no letter."""
    out = docs.filter(F.col(text_col).isNotNull())
    fields = [c for c in out.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)
    ship_package(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col, PIECE_BYTES):
                langs, _, _ = shared.value.decide(piece.column(text_col).to_pylist())
                yield piece.filter(pa.array([x != UNKNOWN for x in langs], pa.bool_()))

    return out.mapInArrow(make, out.schema) if fields else out
