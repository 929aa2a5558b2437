"""Token-id output: best-fit-decreasing packing of documents into rows of a fixed length.

Documents longer than a row are split, losslessly, into full rows and a rest. Segments are dealt to
shards by hash and packed shard by shard: in order of falling length each goes to the open row with
the least room that suffices, which a segment tree over rooms finds in log(length) steps.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.llm.common import read_file, small_batches

LENGTH = 2048
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how a byte-level BPE of this kind parts a text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
SHARD_CHARS = 8_000_000


class RoomTree:
    """Open rows by room: a tree whose leaf r tells whether a row with room r is open."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.open = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        k = room + self.size
        while k and not self.open[k]:
            self.open[k] = 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """An open row of the least room from `need` on, with its room; it is open no longer."""
        k = need + self.size
        while not self.open[k]:  # up to a left child whose right sibling has an open row
            while k & 1:
                k >>= 1
            if not k:
                return None
            k |= 1
        while k < self.size:
            k = 2 * k if self.open[2 * k] else 2 * k + 1
        room = k - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.open[k] = 0
            k >>= 1
            while k and not (self.open[2 * k] or self.open[2 * k + 1]):
                self.open[k] = 0
                k >>= 1
        return row, room


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of item numbers; items of equal length keep their order."""
    tree, rows = RoomTree(length), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            rows.append([i])
            row, room = len(rows) - 1, length
        else:
            row, room = found
            rows[row].append(i)
        if room > lengths[i]:
            tree.put(row, room - lengths[i])
    return rows


def _segments(length: int, shards: int, dtype):
    """Split each document's ids (32-bit, as bytes) into segments of `length` and a rest."""
    def run(batches: Iterator[tuple[list, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        for docs, ids in batches:
            cols = [[] for _ in range(5)]
            for doc, raw in zip(docs, ids):
                x = np.frombuffer(raw, np.int32).astype(dtype)
                for part, at in enumerate(range(0, len(x), length)):
                    piece = x[at:at + length]
                    # segments of one document go to different shards
                    shard = xxhash.xxh32_intdigest(f"{doc}:{part}".encode()) % shards
                    for c, v in zip(cols, (shard, doc, part, len(piece), piece.tobytes())):
                        c.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["shard", "doc_id", "part", "n", "ids"])
    return run


def _packer(length: int, pad: int, dtype):
    def pack(t: pa.Table) -> pa.Table:
        # ids settle the order of rows that repeat a doc_id
        t = t.sort_by([("n", "descending"), ("doc_id", "ascending"), ("part", "ascending"), ("ids", "ascending")])
        shard, doc, part, n, ids = (t.column(c).to_pylist() for c in ("shard", "doc_id", "part", "n", "ids"))
        out = {k: [] for k in ("row", "n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "parts")}
        for row, items in enumerate(best_fit_decreasing(n, length)):
            sizes = [n[i] for i in items]
            used = sum(sizes)
            matrix = np.full(length, pad, dtype)
            matrix[:used] = np.frombuffer(b"".join(ids[i] for i in items), dtype)
            places = np.zeros(length, dtype)
            places[:used] = np.concatenate([np.arange(s) for s in sizes])
            for k, v in zip(out, (row, used, matrix.tobytes(), [0, *np.cumsum(sizes).tolist()], places.tobytes(),
                                  [doc[i] for i in items], [part[i] for i in items])):
                out[k].append(v)
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()),
                 pa.list_(pa.int32()))
        cols = [pa.array([shard[0]] * len(out["row"]), pa.int32()), *(pa.array(v, k) for v, k in zip(out.values(), kinds))]
        return pa.Table.from_arrays(cols, ["shard", *out])
    return pack


def encoder(ranks: bytes) -> tiktoken.Encoding:
    """Byte-level BPE from lines of a base64 token and its id."""
    merges = {base64.b64decode(token): int(i) for token, i in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def packed(docs: DataFrame, length: int = LENGTH, shard_chars: int = SHARD_CHARS, ranks: str = RANKS,
           pad: int = END) -> DataFrame:
    """Rows of `length` token ids packed from docs (doc_id long, text): shard, row, n_tokens, ids
    and positions (little-endian, 16 bits each, or 32 for a vocabulary or length over 65,535; past
    n_tokens the pad id and 0), cu_seqlens (0 and each segment's end), doc_ids and parts (of each segment).

    Positions count from 0 in every segment. A segment never crosses rows; a document's parts,
    in order, hold all its ids. Texts that are null or empty have no segment; a null doc_id is
    carried as null; repeated rows are packed each; other columns are ignored. A shard holds the
    segments of about shard_chars characters, so the number of shards follows the corpus.
    """
    spark = docs.sparkSession
    small_batches(spark)
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    shards = int(chars // shard_chars) + 1
    held = read_file(spark, ranks)
    shared = spark.sparkContext.broadcast(held)  # a vocabulary file: some 50,000 lines
    dtype = np.dtype("<u2" if max(held.count(b"\n") + 1, pad, length) <= 65_535 else "<u4")
    cut_up = _segments(length, shards, dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode_ordinary
        yield from cut_up((b.column(0).to_pylist(), [np.array(encode(t or ""), np.int32).tobytes()
                                                     for t in b.column(1).to_pylist()]) for b in batches)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    segments = d.mapInArrow(run, "shard int, doc_id long, part int, n int, ids binary")
    return segments.groupBy("shard").applyInArrow(
        _packer(length, pad, dtype),
        "shard int, row int, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<long>, parts array<int>")


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows as Parquet under path, a folder for each shard."""
    packed(docs, **options).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("shard").parquet(path)
