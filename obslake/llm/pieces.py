"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a
single-pass Viterbi search for the segmentation of highest total score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.llm.common import read_file, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # kinds of pieces, as the file format numbers them


class Pieces(NamedTuple):
    """What a model file holds: pieces by id, with score and kind; whether a space is put in front."""
    piece: list[str]
    score: list[float]
    kind: list[int]
    prefix: bool


def load(spark: SparkSession, path: str = MODEL) -> Pieces:
    """Read a model file, under a megabyte."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(read_file(spark, path))
    if m.normalizer_spec.name != "identity" or m.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models that keep the text as it is can be decoded exactly")
    return Pieces([p.piece for p in m.pieces], [p.score for p in m.pieces], [p.type for p in m.pieces],
                  m.normalizer_spec.add_dummy_prefix)


class Codec:
    """Encoder and decoder of one task.

    No piece has the space mark after another character, and none has a line feed, so the best
    segmentation of a text is the sequence of the best ones of its chunks: a run of spaces with what
    follows, or a line feed. Short chunks are remembered, up to `most` of them.
    """

    def __init__(self, pieces: Pieces, most: int = 1 << 18):
        self.pieces, self.most, self.known = pieces, most, {}
        self.automaton = ahocorasick.Automaton()
        usable = [(p, i) for i, (p, k) in enumerate(zip(pieces.piece, pieces.kind)) if k in (NORMAL, USER)]
        for p, i in usable:
            self.automaton.add_word(p, (len(p), i, pieces.score[i]))
        self.automaton.make_automaton()
        self.single = {p for p, _ in usable if len(p) == 1}
        self.unknown = min(pieces.score[i] for _, i in usable) - 10.0
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(pieces.piece, pieces.kind)) if k == BYTE}
        self.unk = pieces.kind.index(UNKNOWN)
        whole = any(SPACE in p.lstrip(SPACE) for p, _ in usable)
        line = any("\n" in p for p, _ in usable)
        self.chunk = re.compile("(?s).+" if whole or line else f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.text = [bytes([int(p[1:-1], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else p.replace(SPACE, " ").encode()
                     for p, k in zip(pieces.piece, pieces.kind)]

    def best(self, s: str) -> list[int]:
        """Ids of the segmentation of s with the highest total score; of equal ones, that with the
        longest last piece. A character that is no piece scores less than any; it becomes the
        pieces of its bytes.

        The automaton reports at each position the pieces that end there, longest first, following
        its output links; each may improve the position's best score.
        """
        n = len(s)
        if self.single.issuperset(s):  # every position is the end of some piece
            score, back, piece = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1)
            for last, (size, i, value) in self.automaton.iter(s):
                total = score[last + 1 - size] + value
                if total > score[last + 1]:
                    score[last + 1], back[last + 1], piece[last + 1] = total, last + 1 - size, i
            return self._path(s, back, piece)
        score, back, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        score[0], settled = 0.0, 0

        def settle(end: int) -> None:
            """Let characters that are no piece bridge the positions before `end`."""
            nonlocal settled
            for at in range(settled + 1, end + 1):
                if s[at - 1] not in self.single:
                    total = score[at - 1] + self.unknown
                    if score[at] is None or total > score[at]:
                        score[at], back[at], piece[at] = total, at - 1, -1
            settled = max(settled, end)

        for last, (size, i, value) in self.automaton.iter(s):
            end = last + 1
            settle(last)
            total = score[end - size] + value
            if score[end] is None or total > score[end]:
                score[end], back[end], piece[end] = total, end - size, i
        settle(n)
        return self._path(s, back, piece)

    def _path(self, s: str, back: list[int], piece: list[int]) -> list[int]:
        """Ids along the best path, from its end to its start and turned round."""
        out, at = [], len(s)
        while at:
            if piece[at] < 0:
                out.extend(reversed([self.bytes.get(x, self.unk) for x in s[back[at]:at].encode("utf-8", "surrogatepass")]))
            else:
                out.append(piece[at])
            at = back[at]
        return out[::-1]

    def ids(self, text: str | None) -> bytes:
        """Ids of a text as 32-bit integers. A space mark in the text itself becomes the pieces of its
        bytes, so that it is told from a space."""
        if not text:
            return b""
        if SPACE in text:
            mark = np.array([self.bytes.get(x, self.unk) for x in SPACE.encode()], np.int32).tobytes()
            first, *rest = text.split(SPACE)
            return mark.join([self._ids(SPACE + first if self.pieces.prefix else first), *map(self._ids, rest)])
        return self._ids(SPACE + text if self.pieces.prefix else text)

    def _ids(self, text: str) -> bytes:
        s = text.replace(" ", SPACE)
        known, out = self.known, []
        for c in self.chunk.findall(s):
            got = known.get(c)
            if got is None:
                got = np.array(self.best(c), np.int32).tobytes()
                if len(c) < 64:
                    if len(known) >= self.most:
                        known.clear()
                    known[c] = got
            out.append(got)
        return b"".join(out)

    def decode(self, ids) -> str:
        """The text of ids; the exact text that was encoded. Lone surrogates do not occur in Spark's
        strings."""
        s = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return s[1:] if self.pieces.prefix and s.startswith(" ") else s


def _batch(ids: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, ids (array of int). A null or empty text has
    no ids; repeated rows are encoded each; other columns are ignored."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(load(spark, model)))  # a model file: some 32,000 pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Pieces(*shared.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _batch([codec.ids(t) for t in b.column(1).to_pylist()])], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per row of encoded (doc_id, ids): doc_id, text; null ids give an empty text, ids
    that the model lacks fail the job."""
    spark = encoded.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(load(spark, model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Pieces(*shared.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([codec.decode(x or ()) for x in b.column(1).to_pylist()], pa.string())],
                ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def encoded_and_checked(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids, exact (the ids decode to the text); a null text counts as empty."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(load(spark, model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Pieces(*shared.value))
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = [codec.ids(t) for t in texts]
            exact = [codec.decode(np.frombuffer(x, np.int32).tolist()) == (t or "")
                     for x, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), _batch(ids), pa.array(exact)],
                ["doc_id", "n_ids", "ids", "exact"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_ids long, ids array<int>, exact boolean")
