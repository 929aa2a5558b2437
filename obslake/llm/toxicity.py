"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes
log-count ratios.

Features are hashed 3- to 5-grams of the lower-cased text, present or not. On a bounded sample of
labelled rows, r = log of the ratio of their smoothed shares in toxic and other documents; a
logistic regression is fitted on the features times r. Every document is scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import small_batches
from obslake.llm.sketch import mixed

BITS = 18
SIZES = (3, 4, 5)
PIECE = 1 << 20


def present(text: str | None) -> np.ndarray:
    """Which hashed n-grams a text has (one flag for each); long texts are read piece by piece."""
    seen = np.zeros(1 << BITS, bool)
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(points), PIECE):
        c = points[at:at + PIECE + SIZES[-1] - 1].astype(np.uint64)
        h = c
        for n in range(2, SIZES[-1] + 1):
            h = h[:-1] * np.uint64(0x100000001B3) + c[n - 1:]
            if n in SIZES:
                seen[mixed(h + np.uint64(n)) >> np.uint64(64 - BITS)] = True
    return seen


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield pa.RecordBatch.from_pydict({"label": pa.array([label], pa.int32()), "features": pa.array(
                [np.flatnonzero(present(text)).astype(np.int32).tobytes()], pa.binary())})


def fit(rows: list[tuple[int, np.ndarray]], steps: int = 120, rate: float = 0.3, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of the features, naive Bayes ratios included, and the intercept.

    Logistic regression by full gradients with momentum, both classes of equal weight. With one
    class only, or no rows, all weights are 0 and the score is that class's side of 1/2.
    """
    size = 1 << BITS
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return np.zeros(size, np.float32), 0.0 if not len(y) else (1.0 if y[0] else -1.0)
    idx = np.concatenate([r[1] for r in rows])
    lengths = np.array([len(r[1]) for r in rows])
    toxic = np.repeat(y, lengths)
    pos, n_pos = np.bincount(idx, toxic, size), y.sum()
    neg, n_neg = np.bincount(idx, 1 - toxic, size), len(y) - y.sum()
    ratio = np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))
    ratio[pos + neg < 2] = 0
    useful = ratio[idx] != 0
    doc = np.repeat(np.arange(len(y)), lengths)[useful]
    idx = idx[useful]
    x = ratio[idx]
    norm = np.sqrt(np.bincount(doc, x * x, len(y)).mean()) or 1.0
    x = x / norm
    share = np.where(y == 1, 0.5 / n_pos, 0.5 / n_neg)
    w, move, bias, bias_move = np.zeros(size), np.zeros(size), 0.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, w[idx] * x, len(y)) + bias, -30, 30)))
        error = (p - y) * share
        move = 0.9 * move - rate * (np.bincount(idx, error[doc] * x, size) + penalty * w)
        bias_move = 0.9 * bias_move - rate * error.sum()
        w, bias = w + move, bias + bias_move
    return (w * ratio / norm).astype(np.float32), float(bias)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 600) -> tuple[np.ndarray, float]:
    """Fit on at most max_rows labelled rows of each class, those of least hash; rows whose
    crc32(doc_id as text) mod 5 is 0 are held out. max_rows bounds what the driver gets."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")) \
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("label")) \
        .where(F.crc32(F.col("_id").cast("string")) % 5 != 0)
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("_id")), "_id", "left_semi")
    order = F.xxhash64("_id", F.lit(7))
    sample = known.where("label = 1").orderBy(order, "_id").limit(max_rows) \
        .unionByName(known.where("label = 0").orderBy(order, "_id").limit(max_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text") \
        .join(F.broadcast(sample), "_id")  # 2 * max_rows ids at most
    # a repeated id keeps one of its texts, so the sample's bound holds
    rows = rows.groupBy("_id").agg(F.first("label").alias("label"), F.min("text").alias("text")).select("label", "text")
    got = rows.mapInArrow(_features, "label int, features binary").collect()
    return fit(sorted(((r.label, np.frombuffer(r.features, np.int32)) for r in got),
                      key=lambda r: (r[0], len(r[1]), r[1].tobytes())))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 600) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out (crc32 of the doc_id's text mod 5
    is 0), score (0 to 1), predicted (1 from a score of 0.5).

    labels: doc_id, toxic (0/1; any positive label of a repeated id counts). Null and empty texts
    have no features and score the intercept; a null doc_id is not held out; without labels of
    both classes no feature counts. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    weights, bias = train(docs, labels, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            z = np.array([w[present(t)].sum(dtype=np.float64) + bias for t in b.column(1).to_pylist()])
            score = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()),
                                              pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")
