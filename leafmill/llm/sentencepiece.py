"""Encoding and decoding with the pieces of a SentencePiece model, as Spark jobs.

A text takes the segmentation of greatest total log score (unigram Viterbi).
Pieces are found by a double-array trie over UTF-8 bytes.  White space is
written as the marker U+2581 and a text gets one in front; as no piece has a
marker behind another character, a text falls into words that are segmented
alone, and each distinct word of a batch once, all words side by side.

A character that no piece has becomes its byte pieces (byte fallback), with the
score of the worst piece less 10.  So does a marker that stands in the text
itself, which keeps decoding exact for every text.

Log scores follow Zipf's law over the model's own order of pieces, or are the
model's stored scores.  The vocabulary file is a parameter and never changed.
Null text gives null ids, empty text an empty list; rows are worked on one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm.common import extended
from leafmill.llm.hashing import pieces
from leafmill.session import bound_batches, ship_package

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 1 << 17
CACHE_CHARS = 256  # longest word that stays in the cache, which bounds its bytes
SIDE_BY_SIDE = 64  # longest word in bytes that is segmented beside others
NOWHERE = -np.inf
SEARCH = 1 << 10  # places of the double array that are looked at together


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a trie: the child of state s by byte c is t = base[s] + c + 1 where check[t] = s."""
    keys = sorted(keys)
    size = 1 << 16
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[0] = True
    first = {True: 0, False: 0}  # where to look for room, for one child and for several
    todo = [(0, 0, len(keys), 0)]  # state, keys from, to, depth
    while todo:
        state, start, stop, depth = todo.pop()
        if len(keys[start][0]) == depth:
            value[state] = keys[start][1]
            start += 1
        groups, i = [], start
        while i < stop:
            c, j = keys[i][0][depth], i
            while j < stop and keys[j][0][depth] == c:
                j += 1
            groups.append((c, i, j))
            i = j
        if not groups:
            continue
        labels = np.array([g[0] for g in groups]) + 1
        single = len(labels) == 1
        while True:
            if first[single] + SEARCH + 257 > len(used):
                base, check, value = (np.concatenate([x, np.full(len(x), fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
                used = np.concatenate([used, np.zeros(len(used), bool)])
            room = ~used[first[single] + int(labels[0]) : first[single] + int(labels[0]) + SEARCH]
            for label in labels[1:].tolist():
                room &= ~used[first[single] + label : first[single] + label + SEARCH]
            offset = int(room.argmax())
            if room[offset]:
                break
            first[single] += SEARCH
        at = first[single] + offset
        base[state] = at
        for label, (_, i, j) in zip(labels.tolist(), groups):
            used[at + label], check[at + label] = True, state
            todo.append((at + label, i, j, depth + 1))
    end = int(np.flatnonzero(used).max()) + 258  # any byte may be looked up at any state
    room = max(0, end - len(used))
    return tuple(np.concatenate([x[:end], np.full(room, fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))


@dataclass
class Model:
    pieces: list[bytes]  # as text: markers are spaces, byte pieces their byte
    scores: np.ndarray
    byte_ids: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    unknown: float
    cache: dict[str, bytes] = field(default_factory=dict)

    @staticmethod
    def load(path: str = MODEL_FILE, scores: str = "zipf") -> Model:
        """Read on the driver; tasks get arrays of the vocabulary's size."""
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        return Model.of([(own.id_to_piece(i), own.get_score(i), own.is_byte(i), own.is_control(i) or own.is_unknown(i) or own.is_unused(i))
                         for i in range(own.vocab_size())], scores)

    @staticmethod
    def of(vocabulary: list[tuple[str, float, bool, bool]], scores: str = "zipf") -> Model:
        """From (piece, score, is it a byte, is it special)."""
        if scores not in ("zipf", "stored"):
            raise ValueError(f"scores are zipf or stored, not {scores}")
        table = np.zeros(len(vocabulary))
        byte_ids, keys, shown, rank = np.full(256, -1, np.int32), [], [], 0
        for i, (piece, stored, is_byte, special) in enumerate(vocabulary):
            if is_byte:
                byte = int(piece[3:5], 16)
                byte_ids[byte] = i
                shown.append(bytes([byte]))
            elif special:
                shown.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"a marker within a piece: {piece!r}")
                rank += 1
                table[i] = stored if scores == "stored" else -np.log(rank + 1)
                shown.append(piece.replace(MARK, " ").encode())
                keys.append((shown[-1], i))
        if (byte_ids < 0).any():
            raise ValueError("byte fallback needs all 256 byte pieces")
        worst = min(table[i] for _, i in keys)
        return Model(shown, table, byte_ids, *double_array(keys), worst - UNKNOWN_PENALTY)

    def segment(self, word: bytes) -> list[int]:
        """Best segmentation of one word, marker written as a space."""
        best, back, used = [0.0] + [NOWHERE] * len(word), [0] * (len(word) + 1), [-1] * (len(word) + 1)
        base, check, value = self.base, self.check, self.value
        for s in range(len(word)):
            if best[s] == NOWHERE:
                continue
            width = char_width(word[s])
            state, alone = 0, False
            for e in range(s, len(word)):
                step = int(base[state]) + word[e] + 1
                if check[step] != state:
                    break
                state = step
                found = int(value[state])
                if found >= 0:
                    alone |= e + 1 - s == width
                    score = best[s] + float(self.scores[found])
                    if score > best[e + 1]:
                        best[e + 1], back[e + 1], used[e + 1] = score, s, found
            if not alone and best[s] + self.unknown > best[s + width]:
                best[s + width], back[s + width], used[s + width] = best[s] + self.unknown, s, -1
        ids: list[int] = []
        e = len(word)
        while e:
            s = back[e]
            ids += [used[e]] if used[e] >= 0 else [int(self.byte_ids[b]) for b in reversed(word[s:e])]
            e = s
        return ids[::-1]

    def segment_all(self, words: list[bytes]) -> list[bytes]:
        """Best segmentations as packed int32, many words side by side."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words])
        for i in np.flatnonzero(lengths > SIDE_BY_SIDE):
            out[i] = np.array(self.segment(words[i]), np.int32).tobytes()
        for low, high in ((0, 8), (8, 16), (16, 32), (32, SIDE_BY_SIDE)):
            group = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(group):
                for i, packed in zip(group, self._side_by_side([words[i] for i in group], high)):
                    out[i] = packed
        return out

    def _side_by_side(self, words: list[bytes], most: int) -> list[bytes]:
        count = len(words)
        text = np.frombuffer(b"".join(w.ljust(most, b"\0") for w in words), np.uint8).reshape(count, most)
        lengths = np.array([len(w) for w in words])
        best = np.full((count, most + 1), NOWHERE)
        best[:, 0] = 0.0
        back, used = np.zeros((count, most + 1), np.int16), np.full((count, most + 1), -1, np.int32)
        for s in range(most):
            rows = np.flatnonzero((lengths > s) & (best[:, s] > NOWHERE))
            if not len(rows):
                continue
            width = CHAR_WIDTH[text[rows, s]]
            alone = np.zeros(count, bool)
            live, state = rows, np.zeros(len(rows), np.int32)
            for e in range(s, most):
                step = self.base[state] + text[live, e] + 1
                on = (self.check[step] == state) & (lengths[live] > e)
                live, state = live[on], step[on]
                if not len(live):
                    break
                found = self.value[state]
                hit = found >= 0
                at, piece = live[hit], found[hit]
                alone[at[CHAR_WIDTH[text[at, s]] == e + 1 - s]] = True
                score = best[at, s] + self.scores[piece]
                better = score > best[at, e + 1]
                at = at[better]
                best[at, e + 1], back[at, e + 1], used[at, e + 1] = score[better], s, piece[better]
            lone = rows[~alone[rows]]
            to = s + width[~alone[rows]]
            score = best[lone, s] + self.unknown
            better = score > best[lone, to]
            lone, to = lone[better], to[better]
            best[lone, to], back[lone, to], used[lone, to] = score[better], s, -1
        found = []
        for i, word in enumerate(words):
            ids, e, marks, ways = [], len(word), used[i].tolist(), back[i].tolist()
            while e:
                s = ways[e]
                ids += [marks[e]] if marks[e] >= 0 else [int(self.byte_ids[b]) for b in reversed(word[s:e])]
                e = s
            found.append(np.array(ids[::-1], np.int32).tobytes())
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as packed int32."""
        split = [None if t is None else words_of(t) for t in texts]
        missing = {w for words in split if words for w in words if w not in self.cache}
        if len(self.cache) + len(missing) > CACHE_WORDS:
            self.cache.clear()
            missing = {w for words in split if words for w in words}
        todo = list(missing)
        plain = [w for w in todo if MARK not in w]
        self.cache.update(zip(plain, self.segment_all([w.encode() for w in plain])))
        literal = self.byte_ids[list(MARK.encode())].tobytes()
        for word in set(todo).difference(plain):
            self.cache[word] = literal.join(self.segment_all([part.encode() for part in word.split(MARK)]))
        ids = [None if words is None else b"".join(map(self.cache.__getitem__, words)) for words in split]
        for word in todo:
            if len(word) > CACHE_CHARS:
                del self.cache[word]
        return ids

    def decode(self, ids: list[int]) -> str:
        whole = b"".join(map(self.pieces.__getitem__, ids))
        return (whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace")


CHAR_WIDTH = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16)  # of UTF-8, by lead byte


def char_width(lead: int) -> int:
    return int(CHAR_WIDTH[lead])


def words_of(text: str) -> list[str]:
    """Words with the spaces in front of them, the text's own marker included; none of an empty text."""
    if not text:
        return []
    words = text.split(" ")
    return re.findall(" +[^ ]*", " " + text) if "" in words else [" " + w for w in words]


def _encode(model, text_col: str):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                packed = model.value.encode_all(piece.column(text_col).to_pylist())
                values = np.frombuffer(b"".join(p or b"" for p in packed), np.int32)
                ends = np.cumsum([0, *(len(p or b"") // 4 for p in packed)])
                missing = pa.array([p is None for p in packed] + [False])
                offsets = pa.array(ends, pa.int32(), mask=missing.to_numpy(zero_copy_only=False))
                yield piece.append_column("ids", pa.ListArray.from_arrays(offsets, pa.array(values)))

    return make


def encode(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with a column ``ids`` (array of int) behind; a column of that name is replaced."""
    spark = docs.sparkSession
    bound_batches(spark)
    ship_package(spark)
    rows = docs.drop("ids").withColumn(text_col, docs[text_col].cast("string"))
    return rows.mapInArrow(_encode(spark.sparkContext.broadcast(model), text_col), extended(rows, "ids array<int>"))


def decode(docs: DataFrame, model: Model, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with a text column ``to`` behind, read back from the ids; null ids give null."""
    spark = docs.sparkSession
    bound_batches(spark)
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.drop(to)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One text's ids at a time as Python numbers; those of a batch would take hundreds of MB.
            column = batch.column(ids_col)
            ends, ids, known = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False), column.is_valid().to_pylist()
            texts = [shared.value.decode(ids[a:b].tolist()) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], known)]
            yield batch.append_column(to, pa.array(texts, pa.string()))

    return rows.mapInArrow(make, extended(rows, f"{to} string"))
