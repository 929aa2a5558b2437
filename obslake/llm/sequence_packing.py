"""Packing documents into sequences of token ids by first-fit decreasing in randomised groups.

A document's ids are cut at multiples of the sequence length; whole slices are sequences already, and
the rests are dealt at random to groups of a bounded size. Within a group the rests go, longest first,
each to the first sequence with room for it, which a tournament tree over the rooms finds in log(n)
steps. What first-fit leaves open is then closed by cutting: rests of the emptiest sequences fill the
gaps of the others, and the one sequence left open is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import cut, read_file, small_batches

LENGTH = 4096
TOKENIZER = "word_bpe_49k.json"  # of the folder of public tokenizers
END = 2
GROUP = 2048
WORD = re.compile(r"([a-zß-öø-ÿ]+)([!#$%&*+,./:;=?@^~-]*)").fullmatch
# byte-level vocabularies write the bytes of these words that do not print as code points from 256 on
LETTERS = {x: 256 + k for k, x in enumerate([*range(33), *range(127, 161), 173])}


class RoomTournament:
    """First place with room enough: each inner node keeps the most room below it."""

    def __init__(self, places: int, room: int):
        self.size = 1 << max(0, places - 1).bit_length()
        self.most = [room] * (2 * self.size)

    def take(self, need: int) -> int:
        """The first place whose room is `need` or more; its room shrinks by that."""
        most, k = self.most, 1
        if most[1] < need:
            raise ValueError("no place has that much room")
        while k < self.size:
            k *= 2
            if most[k] < need:
                k += 1
        place = k - self.size
        most[k] -= need
        while k > 1:
            k >>= 1
            best = max(most[2 * k], most[2 * k + 1])
            if most[k] == best:
                break
            most[k] = best
        return place


def first_fit_decreasing(lengths: list[int], room: int) -> list[list[int]]:
    """Places of item numbers; items of equal length keep their order, none exceeds `room`."""
    tree, out = RoomTournament(max(1, len(lengths)), room), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        place = tree.take(lengths[i])
        if place == len(out):  # the first fit is the first empty place at the latest
            out.append([])
        out[place].append(i)
    return out


def filled(places: list[list[int]], lengths: list[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Places of slices (item, from, length) without a gap: items of the emptiest places are cut to
    fill the others; the last open place becomes places whose sizes are powers of two."""
    held = [[(i, 0, lengths[i]) for i in p] for p in sorted(places, key=lambda p: -sum(lengths[i] for i in p))]
    load = [sum(n for _, _, n in p) for p in held]
    lo, hi = 0, len(held) - 1
    while lo < hi:
        gap = room - load[lo]
        if not gap:
            lo += 1
            continue
        i, at, n = held[hi].pop()
        take = min(gap, n)
        held[lo].append((i, at, take))
        load[lo] += take
        load[hi] -= take
        if take < n:
            held[hi].append((i, at + take, n - take))
        elif not held[hi]:
            held.pop()
            hi -= 1
    if held and load[hi] < room:
        rest, left = held.pop(), load[hi]
        while left:
            size = 1 << (left.bit_length() - 1)
            place, open_ = [], size
            while open_:
                i, at, n = rest.pop(0)
                take = min(open_, n)
                place.append((i, at, take))
                open_ -= take
                if take < n:
                    rest.insert(0, (i, at + take, n - take))
            held.append(place)
            left -= size
    return held


class Ids(dict):
    """Token ids (as bytes) of texts, and of the parts met so far, up to `most` of them.

    The tokenizer drops white space and merges nothing across it, so the ids of a text are those of
    its parts between spaces and line feeds. Texts of Latin-1 characters are in normal form once in
    lower case. There a part of letters is one word, as it is in the merges' vocabulary; one of
    letters and ASCII marks behind them is a word and a run of marks. All others go through the whole
    tokenizer.
    """

    def __init__(self, file: bytes, dtype, most: int = 1 << 19):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.whole, self.dtype, self.most = Tokenizer.from_str(file.decode()), dtype, most
        self.words = self.whole.model.tokenize
        self.code = struct.Struct("<H" if dtype.itemsize == 2 else "<I").pack

    def __missing__(self, part: str) -> bytes:
        m = WORD(part)
        if not m:
            ids = np.array(self.whole.encode(part, add_special_tokens=False).ids, self.dtype).tobytes()
        elif m[2]:
            ids = self[m[1]] + self[m[2]]
        else:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(LETTERS)
            ids = b"".join([self.code(t.id) for t in self.words(letters)])
        self[part] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self) > self.most:
            self.clear()
        text = text.replace("\n", " ")
        if "<|" not in text:  # special tokens are found before case is dropped
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.__getitem__, text.split(" ")))


def _rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in kinds.items()], list(kinds))


SLICES = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "doc_tokens": pa.int64(), "ids": pa.binary()}
PIECES = SLICES | {"sequence_id": pa.int64(), "offset": pa.int64()}


def _wide(ids: bytes, dtype) -> bytes:
    return np.frombuffer(ids, dtype).astype("<u4").tobytes()


def _widened(dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("ids")
            yield b.set_column(at, "ids", pa.array([_wide(x, dtype) for x in b.column(at).to_pylist()], pa.binary()))
    return run


def _group(room: int, dtype):
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("row")
        rows = {c: t.column(c).to_pylist() for c in (*SLICES, "grp")}
        out = {c: [] for c in PIECES}
        places = filled(first_fit_decreasing(rows["length"], room), rows["length"], room)
        for place, slices in enumerate(places):
            offset = 0
            for i, at, n in slices:
                ids = rows["ids"][i][at * dtype.itemsize:(at + n) * dtype.itemsize]
                # odd: sequences of groups; even: those that one document fills
                for c, v in zip(out, (rows["doc_id"][i], rows["start"][i] + at, n, rows["doc_tokens"][i],
                                      _wide(ids, dtype), (rows["grp"][i] << 24 | place) * 2 + 1, offset)):
                    out[c].append(v)
                offset += n
        return pa.Table.from_batches([_rows(out, PIECES)])
    return pack


def packed_pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END,
                  group: int = GROUP) -> DataFrame:
    """Pieces of docs (doc_id long, text) packed into sequences of `length` ids at most: doc_id, start
    (ids of its document before it), length, doc_tokens, ids (little-endian unsigned 32-bit),
    sequence_id, offset (in its sequence, gapless from 0).

    A document's ids are those of the tokenizer (path of its file), without special tokens added, and
    `end`; those of a null or empty text are `end` alone. Every id is in one piece. A sequence is
    either full or as long as a power of two, so none needs padding where these are free of it. A null
    doc_id is carried as null; rows that repeat a doc_id are documents of their own; other columns are
    ignored. A group has about `group` rests, dealt by a hash of their place in the table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    file = read_file(spark, tokenizer)
    shared = spark.sparkContext.broadcast(file)  # a vocabulary file: some 50,000 entries
    most = max(end, *json.loads(file)["model"]["vocab"].values(), *(t["id"] for t in json.loads(file)["added_tokens"]))
    dtype = np.dtype("<u2" if most < 1 << 16 else "<u4")  # of ids on their way

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(shared.value, dtype)
        last = np.array([end], dtype).tobytes()
        for b in batches:
            out = {c: [] for c in SLICES}
            for doc, raw in zip(b.column(0).to_pylist(), map(ids.of, b.column(1).to_pylist())):
                raw += last
                n = len(raw) // dtype.itemsize
                for at in range(0, n, length):
                    piece = raw[at * dtype.itemsize:(at + length) * dtype.itemsize]
                    for c, v in zip(out, (doc, at, len(piece) // dtype.itemsize, n, piece)):
                        out[c].append(v)
            yield _rows(out, SLICES)

    kinds = "doc_id long, start long, length long, doc_tokens long, ids binary"
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = cut(d.mapInArrow(slices, kinds).withColumn("row", F.monotonically_increasing_id()), "slices")
    pieces = f"{kinds}, sequence_id long, offset long"
    whole = cuts.where(F.col("length") == length).select(
        *SLICES, (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).mapInArrow(_widened(dtype), pieces)
    rests = cuts.where(F.col("length") < length)
    groups = rests.count() // group + 1
    rests = rests.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = rests.groupBy("grp").applyInArrow(_group(length, dtype), pieces)
    return whole.unionByName(packed)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of packed_pieces: sequence_id, n_tokens, ids (its pieces' in order),
    cu_seqlens (0 and each piece's end), doc_ids and starts (of each piece)."""
    each = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))  # a sequence's ids at most
    p = pieces.groupBy("sequence_id").agg(each.alias("p"))
    return p.select(
        "sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.aggregate("p", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"),
        F.concat(F.array(F.lit(0).cast("long")), F.transform("p", lambda x: x["offset"] + x["length"])).alias("cu_seqlens"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("p", lambda x: x["start"]).alias("starts"))
