"""Quality by hierarchical empirical Bayes: a document's own evidence beside that of its host and path.

1. *Document evidence.*  A logistic model over shape features of the whole text
   gives each document a probability.  It is fitted on a bounded sample of
   labelled rows (``max_labelled``, those of least hashed id).
2. *Sites.*  Probabilities are summed by path and by host with map-side combine.
   A host's posterior mean shrinks toward the global mean, a path's toward its
   host's; the prior's weight is estimated from the spread of the site means (the
   method of moments), so a site with few documents says little.
3. *Decision.*  The log odds of the document and how far the odds of its path,
   without the document itself, depart from the global ones add up.

A host that holds a third of all rows leaves one row a map task before the
shuffle; sites return to documents by an equi-join in which each stands once.

Null text is empty text: all features 0.  Null host or path are sites of their
own.  Rows that repeat an id are documents of their own.  With no labels, or of
one class only, every document gets the prior share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.hashing import pieces, texts_as_bytes
from leafmill.llm.jaccard_join import word_hashes
from leafmill.session import ship_package, through_table

FEATURES = ("length", "upper", "digit", "symbol", "space", "line", "word", "repeat", "bar", "loud", "twin")
EDGE = 1e-4  # probabilities stay this far from 0 and 1


def _table(rule) -> np.ndarray:
    return np.array([rule(b) for b in range(256)], np.float64)


CLASSES = {
    "upper": _table(lambda b: 65 <= b <= 90),
    "digit": _table(lambda b: 48 <= b <= 57),
    "symbol": _table(lambda b: 33 <= b <= 126 and not chr(b).isalnum() and chr(b) not in ".,'-"),
    "space": _table(lambda b: b in (9, 10, 13, 32)),
    "line": _table(lambda b: b == 10),
    "bar": _table(lambda b: b in b"|<>{}[]=_\\"),
    "loud": _table(lambda b: b in b"!?*%$&#"),
}


def features(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shape of each text: shares of byte classes, length, word length, doubled bytes and words."""
    begins, sizes = ends[:-1] - ends[0], np.diff(ends)
    text = data[ends[0] : ends[-1]]
    safe = np.maximum(sizes, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(flags)])
        return (sums[begins + sizes] - sums[begins]) / safe

    found = {name: share(table[text]) for name, table in CLASSES.items()}
    same = np.zeros(len(text))
    same[1:] = text[1:] == text[:-1]
    found["repeat"] = share(same)
    words, rows = word_hashes(data, ends)
    twin = np.zeros(len(words))
    for back in (1, 2):
        twin[back:] += (words[back:] == words[:-back]) & (rows[back:] == rows[:-back])
    found["twin"] = np.bincount(rows, weights=np.minimum(twin, 1), minlength=len(sizes)) / np.maximum(np.bincount(rows, minlength=len(sizes)), 1)
    found["length"] = np.log1p(sizes) / 10
    found["word"] = np.log1p(np.where(sizes > 0, 1 / np.maximum(found["space"], 1 / safe), 0.0)) / 5
    return np.column_stack([found[name] for name in FEATURES])


def _scaled(x: np.ndarray) -> np.ndarray:
    """Features and their square roots, which tell small shares apart, with a constant."""
    return np.column_stack([np.ones(len(x)), x, np.sqrt(x)])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; of one class only, its smoothed share."""
    design = _scaled(x)
    weights = np.zeros(design.shape[1])
    share = (y.sum() + 1) / (len(y) + 2)
    weights[0] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return weights
    penalty = np.full(design.shape[1], ridge)
    penalty[0] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - penalty * weights
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty + 1e-9), gradient)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            found = features(*texts_as_bytes(piece.column("text")))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield piece.drop_columns(["text"]).append_column("features", lists)


def _judged(weights: np.ndarray):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
            p = 1 / (1 + np.exp(-np.clip(_scaled(x) @ weights, -30, 30)))
            yield batch.drop_columns(["features"]).append_column("evidence", pa.array(np.clip(p, EDGE, 1 - EDGE)))

    return make


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def prior_weight(sites: DataFrame, within: float, mean: float) -> float:
    """Documents a prior counts as: mean variance within sites over variance between their true means."""
    row = sites.agg(F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count("*"), F.sum(F.col("n") * F.pow(F.col("total") / F.col("n") - mean, 2))).first()
    docs, squares, count, spread = (float(x or 0) for x in row)
    room = docs - squares / docs if docs else 0.0
    between = (spread - (count - 1) * within) / room if room > 0 else 0.0
    return within / between if between > within / 1e6 else 1e6


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = 20_000) -> DataFrame:
    """One row a document: doc_id, evidence, host_posterior, path_posterior, quality (0 to 1) and good.

    ``host`` and ``path`` are columns of ``docs``; a path belongs to its host.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
                       docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    described = through_table(rows.mapInArrow(_described, f"doc_id {kind}, host string, path string, features array<double>"), "features")
    told = labels.select(labels[label_id_col].alias("_id"), labels[label_col].cast("double").alias("label")).filter("label IS NOT NULL")
    sample = described.join(told, described["doc_id"] == told["_id"]).select("doc_id", "features", "label").orderBy(
        F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled).collect()
    weights = fit_logistic(np.array([r.features for r in sample]).reshape(-1, len(FEATURES)), np.array([r.label for r in sample]))

    judged = through_table(described.mapInArrow(_judged(weights), f"doc_id {kind}, host string, path string, evidence double"), "evidence")
    paths = through_table(judged.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("evidence").alias("total"), F.sum(F.pow("evidence", F.lit(2))).alias("squares")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    row = paths.agg(F.sum("n"), F.sum("total"), F.sum(F.col("squares") - F.pow("total", F.lit(2)) / F.col("n"))).first()
    n, total, rest = (float(x or 0) for x in row)
    mean = total / n if n else 0.5
    within = max(rest / n if n else 0.0, EDGE)
    of_host, of_path = prior_weight(hosts, within, mean), prior_weight(paths, within, mean)

    above = hosts.select(F.col("host").alias("_host"), ((F.col("total") + of_host * mean) / (F.col("n") + of_host)).alias("host_posterior"))
    sites = paths.join(above, F.col("host").eqNullSafe(F.col("_host"))).select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "total", "host_posterior")
    joined = judged.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    others = (F.col("total") - F.col("evidence") + of_path * F.col("host_posterior")) / (F.col("n") - 1 + of_path)
    bounded = F.greatest(F.least(others, F.lit(1 - EDGE)), F.lit(EDGE))
    middle = min(max(mean, EDGE), 1 - EDGE)
    odds = log_odds(F.col("evidence")) + log_odds(bounded) - float(np.log(middle / (1 - middle)))
    quality = 1 / (1 + F.exp(-odds))
    return joined.select("doc_id", "evidence", "host_posterior", ((F.col("total") + of_path * F.col("host_posterior")) / (F.col("n") + of_path)).alias("path_posterior"),
                         quality.alias("quality"), (quality >= 0.5).alias("good"))
