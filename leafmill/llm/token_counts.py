"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where both encodings provably agree.

A text of at most ``chunk`` characters is encoded as it is.  A longer one is
cut into windows of ``chunk`` characters and an overlap on either side, which
any task may encode, with offsets.  Two neighbours share the text around their
seam; the seam is spliced at a boundary p of tokens that both have and that is

* *context-free*: before p stands a letter or digit and at p a character of
  another class, or before p anything but white space and at p white space.
  No pre-token of the byte-level pattern holds both, whatever stands around;
* or *inside one pre-token in every context* (all digits, all other signs, all
  white space with one more behind, or letters from the third before p on, as
  contractions end by then), with the same token on either side.  A sequence
  of byte-pair tokens is the encoding if each adjacent pair is the encoding of
  its own bytes.  Within either window all pairs are, and the pair at p stands
  in both, so the spliced sequence is the encoding of the whole.

A place that an added token covers or touches, or that is near the cut end of
a window, proves nothing.  The sum over the seams then is

    tokens of the last window + sum of (tokens before p, left window - right window).

Where a seam has no such boundary, the text is cut again with windows four
times as long and overlaps four times as wide, in the end into one window.

Null text counts as empty and has no token.  Rows are worked on one by one, so
ties, repeated ids and null ids change nothing; equal long texts are encoded
once.  Special strings in a text are tokens, as the library's default has it.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import ids_and_text, shuffle_width, utf8_length
from leafmill.llm.hashing import pieces
from leafmill.session import ship_package, through_table

CHUNK = 1 << 16
OVERLAP = 1 << 11
WIDER = 4
ENCODE_BYTES = 1 << 18  # text that is encoded at once; its tokens are held as objects
LETTER, DIGIT, SPACE, OTHER = range(4)
FREE = -1  # stands for the tokens beside a context-free boundary
SEAM = "array<struct<place:long, before_id:int, after_id:int, tokens:long>>"
_TOKENIZERS: dict[str, object] = {}


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str | None = None) -> str:
    """The tokenizer file's text; refuses those whose splits the proof does not cover."""
    with open(path or default_file(), encoding="utf-8") as file:
        text = file.read()
    own = json.loads(text)
    split, model = own.get("pre_tokenizer") or {}, own["model"]
    if split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space") or own.get("normalizer"):
        raise ValueError("chunks are proven for byte-level splits without a normaliser or a space in front only")
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("chunks are proven for plain byte-pair merges only")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in own.get("added_tokens", [])):
        raise ValueError("chunks are proven for added tokens that keep to their own characters only")
    return text


def _tokenizer(text: str):
    """One a worker process."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import tokenizers

        own = tokenizers.Tokenizer.from_str(text)
        own.no_truncation()
        own.no_padding()
        own.post_processor = tokenizers.processors.ByteLevel(trim_offsets=False)  # offsets as they are; adds no token
        _TOKENIZERS[key] = own
    return _TOKENIZERS[key]


def _kinds(text: str) -> np.ndarray:
    """The class of each character in the byte-level pattern."""
    import regex

    found = np.full(len(text), OTHER, np.int8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, text):
            found[m.start() : m.end()] = kind
    return found


def stable_places(text: str, added: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places in a window that are context-free boundaries, and those inside one pre-token in every context."""
    kinds = _kinds(text)
    free, inner = np.zeros(len(text), bool), np.zeros(len(text), bool)
    if len(text) > 4:
        before, at = kinds[2:-2], kinds[3:-1]
        behind, two, three = kinds[4:], kinds[1:-3], kinds[:-4]
        free[3:-1] = (np.isin(before, (LETTER, DIGIT)) & (at != before)) | ((before != SPACE) & (at == SPACE))
        same = before == at
        inner[3:-1] = same & (
            np.isin(at, (DIGIT, OTHER)) | ((at == SPACE) & (behind == SPACE)) | ((at == LETTER) & (two == LETTER) & (three == LETTER)))
    for token in added:
        at = text.find(token)
        while at >= 0:
            free[at : at + len(token) + 1] = inner[at : at + len(token) + 1] = False
            at = text.find(token, at + 1)
    return free, inner


def window_seams(own, text: str, overlap: int, first: bool, last: bool) -> tuple[int, list[tuple], list[tuple]]:
    """Tokens of a window, and the proven boundaries of its left and right overlap as (place, token before, token behind, tokens before).

    Places of the left seam count from the window's start, those of the right
    one from where that overlap begins, so that neighbours count alike.
    """
    added = [t.content for t in own.get_added_tokens_decoder().values()]
    margin = max([8, *map(len, added)])
    (encoded,) = own.encode_batch([text], add_special_tokens=False)
    ids = np.array(encoded.ids, np.int64)
    if not len(ids):
        return 0, [], []
    offsets = np.array(encoded.offsets, np.int64)
    starts, ends = offsets[1:, 0], offsets[:-1, 1]
    seams = []
    for used, low in ((not first, 0), (not last, len(text) - 2 * overlap)):
        if not used:
            seams.append([])
            continue
        part = text[low : low + 2 * overlap]
        free, inner = stable_places(part, added)
        clean = np.flatnonzero((starts == ends) & (starts >= low + margin) & (starts <= low + len(part) - margin))
        found = []
        for k in clean:
            place = int(starts[k]) - low
            if free[place]:
                found.append((place, FREE, FREE, int(k) + 1))
            elif inner[place]:
                found.append((place, int(ids[k]), int(ids[k + 1]), int(k) + 1))
        seams.append(found)
    return len(ids), seams[0], seams[1]


def _short(model, chunk: int):
    """Counts of the texts that are encoded as they are; null for longer ones."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(model.value)
        for batch in batches:
            for piece in pieces(batch, most=ENCODE_BYTES):
                texts = piece.column("text").to_pylist()
                counts: list[int | None] = [0 if not t else None for t in texts]
                todo = [i for i, t in enumerate(texts) if t and len(t) <= chunk]
                for i, found in zip(todo, own.encode_batch_fast([texts[i] for i in todo], add_special_tokens=False)):
                    counts[i] = len(found)
                yield pa.record_batch([piece.column("doc_id"), piece.column("n_bytes"), piece.column("sha256"), pa.array(counts, pa.int64())],
                                      names=["doc_id", "n_bytes", "sha256", "n_tokens"])

    return make


def _cut(chunk: int, overlap: int):
    """A long text as windows; a last one shorter than the overlap joins its neighbour."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("sha256").to_pylist(), batch.column("text")):
                text = text.as_py()
                n = max(1, (len(text) - overlap) // chunk + ((len(text) - overlap) % chunk > overlap))
                for seq in range(n):
                    start = max(0, seq * chunk - overlap)
                    stop = (seq + 1) * chunk + overlap if seq + 1 < n else len(text)
                    yield pa.record_batch([pa.array([key]), pa.array([seq]), pa.array([seq + 1 == n]), pa.array([text[start:stop]], pa.large_string())],
                                          names=["sha256", "seq", "last", "text"])

    return make


def _encode(model, overlap: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(model.value)
        names = ["place", "before_id", "after_id", "tokens"]
        for batch in batches:
            for key, seq, last, text in zip(*(batch.column(c) for c in ("sha256", "seq", "last", "text"))):
                total, left, right = window_seams(own, text.as_py(), overlap, seq.as_py() == 0, last.as_py())
                rows = [(seq.as_py() - 1, "R", left)] * (seq.as_py() > 0) + [(seq.as_py(), "L", right)] * (not last.as_py())
                yield pa.RecordBatch.from_pylist(
                    [{"sha256": key.as_py(), "seam": seam, "side": side, "total": 0, "found": [dict(zip(names, f)) for f in found]}
                     for seam, side, found in rows]
                    + [{"sha256": key.as_py(), "seam": -1, "side": "T", "total": total if last.as_py() else 0, "found": []}],
                    schema=_WINDOW)

    return make


_WINDOW = pa.schema([
    ("sha256", pa.string()), ("seam", pa.int64()), ("side", pa.string()), ("total", pa.int64()),
    ("found", pa.list_(pa.struct([("place", pa.int64()), ("before_id", pa.int32()), ("after_id", pa.int32()), ("tokens", pa.int64())])))])


def spliced(windows: DataFrame) -> DataFrame:
    """(sha256, n_tokens): null where a seam has no proven common boundary."""
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("found")))
    seams = windows.groupBy("sha256", "seam").agg(side("L").alias("left"), side("R").alias("right"), F.sum("total").alias("total"))
    mark = lambda x: F.struct(x["place"], x["before_id"], x["after_id"])
    common = F.array_intersect(F.transform("left", mark), F.transform("right", mark))
    chosen = seams.withColumn("_common", common).withColumn(  # the middle one; any would do
        "_at", F.when(F.size("_common") > 0, F.element_at("_common", (F.size("_common") / 2).cast("int") + 1)))
    tokens = lambda c: F.element_at(F.filter(c, lambda x: x["place"] == F.col("_at")["place"]), 1)["tokens"]
    part = F.when(F.col("seam") < 0, F.col("total")).when(F.col("_at").isNotNull(), tokens("left") - tokens("right"))
    parts = chosen.select("sha256", part.alias("part"))
    return parts.groupBy("sha256").agg(F.when(F.count_if(F.col("part").isNull()) == 0, F.sum("part")).alias("n_tokens"))


def count_long(texts: DataFrame, model, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(sha256, n_tokens) of distinct long texts (sha256, text); rounds until all seams are spliced."""
    if not 32 <= 2 * overlap <= chunk:
        raise ValueError("two overlaps are at least 32 characters and at most a chunk")
    spark, done, waiting = texts.sparkSession, None, texts
    while True:
        # Windows of one text may be encoded anywhere; the key spreads them evenly.
        windows = waiting.mapInArrow(_cut(chunk, overlap), "sha256 string, seq long, last boolean, text string")
        windows = windows.repartition(shuffle_width(spark), "sha256", "seq")
        counted = spliced(windows.mapInArrow(_encode(model, overlap), f"sha256 string, seam long, side string, total long, found {SEAM}"))
        counted = through_table(counted, "token-windows")
        found = counted.filter("n_tokens is not null")
        done = found if done is None else done.unionAll(found)
        open_ = counted.filter("n_tokens is null").select("sha256")
        if open_.isEmpty():
            return done
        waiting = texts.join(open_, "sha256", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 1024,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(load(path))  # a file of vocabulary size
    rows = ids_and_text(docs, id_col, text_col)
    long_ = F.length("text") > chunk
    keyed = rows.select("doc_id", utf8_length(F.col("text")).alias("n_bytes"), F.when(long_, F.sha2("text", 256)).alias("sha256"), "text")
    kind = dict(keyed.dtypes)["doc_id"]
    counts = through_table(keyed.mapInArrow(_short(model, chunk), f"doc_id {kind}, n_bytes long, sha256 string, n_tokens long"), "token-counts")
    if not counts.filter("sha256 is not null").isEmpty():
        distinct = through_table(keyed.filter(long_).groupBy("sha256").agg(F.first("text").alias("text")), "long-texts")
        found = count_long(distinct, model, chunk, overlap).withColumnRenamed("n_tokens", "_spliced")
        counts = counts.join(found, "sha256", "left").withColumn("n_tokens", F.coalesce("n_tokens", "_spliced"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
