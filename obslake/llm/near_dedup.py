"""MinHash near-deduplication of documents by fast similarity sketching, banding and exact
verification of word shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import cut, small_batches
from obslake.llm.linking import similar_components
from obslake.llm.sketch import Hashes, band_keys, set_id, shingle_set

BANDS, ROWS = 40, 5


def longs(parts: list[np.ndarray]) -> pa.Array:
    """A list column of longs."""
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _sketches(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for b in batches:
            n, cls, keys = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, hashes)
                n.append(len(s))
                cls.append(set_id(s) if len(s) else None)
                keys.append(band_keys(s, bands, rows) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), longs(keys)],
                ["doc_id", "n", "cls", "bands"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for b in batches:
        node, items = [], []
        for v, cls, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            s = shingle_set(text, hashes)
            if set_id(s) == cls:  # else another text under the same id
                node.append(v)
                items.append(s)
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), longs(items)], ["node", "items"])


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs (doc_id long, text): doc_id, n_shingles, component_id, kept.

    Documents are linked from a Jaccard similarity of 3/4 of their sets of distinct 5-word
    shingles on (A-Z lower-cased; fewer words: the whole sequence). component_id is the smallest
    doc_id reachable over links, kept tells doc_id = component_id. Texts that are null or have
    no words have no shingles and stay alone; so do rows without a doc_id (component_id null, kept).
    Rows that repeat a doc_id are documents of their own, linked if their texts are similar.
    Other columns of docs are ignored.

    With 40 bands of 5 coordinates, a pair at the threshold meets in a band with probability
    1 - 2e-5, and a more similar one with more. Equal sets are one node, however many copies.
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = cut(d.mapInArrow(_sketches(bands, rows), "doc_id long, n long, cls binary, bands array<long>"), "sketches")
    linkable = sketched.where("cls is not null and doc_id is not null")
    nodes = linkable.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                        F.first("bands").alias("bands"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def load_sets(seen: DataFrame) -> DataFrame:
        wanted = nodes.join(seen, "node", "left_semi").select("node", "cls", F.col("rep").alias("doc_id"))
        return wanted.join(d, "doc_id").select("node", "cls", "text").mapInArrow(_sets, "node long, items array<long>") \
            .dropDuplicates(["node"])

    labels = similar_components(nodes.select("node", "n", "bands"), load_sets)
    labelled = nodes.select("node", "cls", "rep").join(labels, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    least = labelled.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_class = labelled.join(least, "comp").select("cls", "component_id")
    out = sketched.select("doc_id", "n", "cls").join(by_class, "cls", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one document of each group of near copies, all columns; a kept document whose row
    is repeated with the same text stays once. Rows without a doc_id all stay."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    d = docs.withColumn("_id", F.col("doc_id").cast("long")).join(kept, "_id", "left_semi")
    once = d.dropDuplicates(["_id", "text"]).drop("_id")
    return once.unionByName(docs.where("doc_id is null"))
