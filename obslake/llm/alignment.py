"""Cross-tokenizer alignment: where two tokenizers both end a token, a text falls into groups.

Both tokenizers' tokens are laid over the same bytes (a space and the text). The byte offsets at which
both end are found by galloping: every offset of the shorter list searches the longer one outwards
from where it should be, in steps that double, and then between the last two steps by halving. Common
offsets slice both token lists into groups, and differences of their ranks tell how many tokens of each
a group holds. Every pair of a group's tokens, one of each side, is a link.

Texts are cut before a single space or line feed between two characters that are no white space. At
such a point both tokenizers end a token, whatever stands around it, so parts are encoded and aligned
once and remembered.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import cut, read_file, small_batches

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"  # of the folder of public tokenizers
MARK = "▁"
PART = re.compile(r"(?<=\S)(?=[ \n]\S)")
ID_BITS = 22  # a pair of ids as one long
TABLE_PAIRS = 1 << 20
_MANY = 1 << 12


def gallop(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in a and in b of the values that both hold; each is ascending without repeats.

    All values of the shorter list search at once: each from the rank in proportion to its own,
    doubling its step until the value is passed, then by halving.
    """
    if len(a) > len(b):
        j, i = gallop(b, a)
        return i, j
    n, m = len(a), len(b)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.arange(n, dtype=np.int64) * m // n
    up = b[at] < a  # look further on; the others look back
    lo, hi = at.copy(), at.copy()  # b[lo] < value <= b[hi], as far as known
    step, todo = 1, np.arange(n)
    while len(todo):
        more = up[todo]
        end = np.where(more, np.minimum(hi[todo] + step, m), np.maximum(lo[todo] - step, -1))
        inside = (end >= 0) & (end < m)
        less = np.where(inside, b[np.clip(end, 0, m - 1)] < a[todo], end < 0)
        lo[todo] = np.where(more, np.where(less, end, lo[todo]), end)
        hi[todo] = np.where(more, end, np.where(less, hi[todo], end))
        todo = todo[np.where(more, less, ~less)]
        step *= 2
    while (wide := np.flatnonzero(hi - lo > 1)).size:
        mid = (lo[wide] + hi[wide]) // 2
        less = b[mid] < a[wide]
        lo[wide], hi[wide] = np.where(less, mid, lo[wide]), np.where(less, hi[wide], mid)
    found = (hi < m) & (b[np.minimum(hi, m - 1)] == a)
    return np.flatnonzero(found), hi[found]


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the groups as ranks in both lists: group g holds a[x[g]:x[g+1]] and b[y[g]:y[g+1]]."""
    i, j = gallop(ends_a, ends_b)
    return np.concatenate([[0], i + 1]), np.concatenate([[0], j + 1])


def _grown(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """a, its first `used` rows followed by more; room doubles when it runs out."""
    if used + len(more) > len(a):
        a = np.concatenate([a[:used], np.empty((max(used, len(more), 1024), *a.shape[1:]), a.dtype)])
        if used + len(more) > len(a):
            return _grown(a, used, more)
    a[used:used + len(more)] = more
    return a


def _summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray):
    """(owner, pair, times) with the times of equal (owner, pair) added up, sorted by both."""
    if not len(pair):
        return owner, pair, times
    if int(owner.max()) < 1 << (63 - 2 * ID_BITS):
        order = np.argsort(owner << 2 * ID_BITS | pair)
    else:
        order = np.lexsort((pair, owner))
    owner, pair, times = owner[order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])]))
    return owner[first], pair[first], np.add.reduceat(times, first)


def _spread(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of counts, in one array."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class _Side:
    """One tokenizer: ids of a text that starts with a space or line feed, and the bytes of each id."""

    def ids(self, text: str) -> np.ndarray:
        raise NotImplementedError

    def _measure(self) -> None:
        self.size = np.array([len(x) for x in self.bytes], np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: those that print stand for
    themselves, the others for code points from 256 on."""
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}


class ByteLevel(_Side):
    def __init__(self, file: bytes):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        letters, vocab = _byte_letters(), json.loads(file)["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self._measure()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)


class Pieces(_Side):
    def __init__(self, file: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        m.ParseFromString(file)
        pieces = [p.piece for p in m.pieces]
        spec = m.normalizer_spec
        if not spec.add_dummy_prefix or spec.remove_extra_whitespaces or spec.name != "identity" \
                or any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("parts of a text can only be encoded alone by a model whose pieces keep to words")
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.mark = pieces.index(MARK)
        self.bytes = [bytes([int(p[1:-1], 16)]) if m.pieces[i].type == 6 else p.replace(MARK, " ").encode()
                      for i, p in enumerate(pieces)]
        self._measure()

    def ids(self, text: str) -> np.ndarray:
        if text[0] == " ":  # the processor adds the space again
            return np.array(self.processor.encode(text[1:], num_threads=1), np.int64)
        return np.array(self.processor.encode(text, num_threads=1), np.int64)[1:]


class Aligner:
    """Alignments of parts of texts, remembered by part, up to `most` of them."""

    def __init__(self, a: _Side, b: _Side, most: int = 1 << 19):
        self.a, self.b, self.most = a, b, most
        self.names = [[str(i) for i in range(len(s.bytes))] for s in (a, b)]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[str] = []
        self.figures = np.empty((0, 6), np.int64)  # n_a, n_b, n_groups, n_pairs (distinct), bad, first pair
        self.pairs, self.times, self.held = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def _pairs(self, ids_a, ids_b, x, y):
        """(group, pair, times) of the links in each group; ids repeated within a group of many
        tokens are counted before they are paired."""
        p, q = np.diff(x), np.diff(y)
        few = p * q <= _MANY
        n = np.where(few, p * q, 0)
        g = np.repeat(np.arange(len(p)), n)
        k = _spread(n)
        pair = ids_a[x[g] + k // q[g]] << ID_BITS | ids_b[y[g] + k % q[g]]
        out = [(g, pair, np.ones(len(pair), np.int64))]
        for h in np.flatnonzero(~few):
            u, nu = np.unique(ids_a[x[h]:x[h + 1]], return_counts=True)
            v, nv = np.unique(ids_b[y[h]:y[h + 1]], return_counts=True)
            pair = (u[:, None] << ID_BITS | v).ravel()
            out.append((np.full(len(pair), h), pair, np.outer(nu, nv).ravel()))
        return [np.concatenate(c) for c in zip(*out)]

    def _learn(self, parts: list[str]) -> None:
        """Align parts that, joined, are encoded as each alone."""
        whole = "".join(parts)
        raw = whole.encode()
        ids_a, ids_b = self.a.ids(whole), self.b.ids(whole)
        if self.a.joined(ids_a) != raw or self.b.joined(ids_b) != raw:
            if len(parts) > 1:
                for p in parts:
                    self._learn([p])
            else:
                self._keep(parts, [""], np.array([[0, 0, 0, 0, 1]]), np.empty(0, np.int64), np.empty(0, np.int64))
            return
        ends_a, ends_b = np.cumsum(self.a.size[ids_a]), np.cumsum(self.b.size[ids_b])
        x, y = groups(ends_a, ends_b)
        stops = np.cumsum([len(p.encode()) for p in parts])
        # groups of each part: the last of them ends where the part does
        last = np.searchsorted(ends_a[x[1:] - 1], stops) + 1
        if not np.array_equal(ends_a[x[last] - 1], stops):
            raise ValueError("a part's end is no common end of tokens")
        first = np.concatenate([[0], last[:-1]])
        g, pair, times = self._pairs(ids_a, ids_b, x, y)
        part = np.searchsorted(last, g, side="right")
        part, pair, times = _summed(part, pair, times)
        na, nb = self.names
        xs, ys, sa, sb = x.tolist(), y.tolist(), [na[i] for i in ids_a.tolist()], [nb[i] for i in ids_b.tolist()]
        said = [f"{sa[f]}|{sb[h]}" if t - f == u - h == 1 else ",".join(sa[f:t]) + "|" + ",".join(sb[h:u])
                for f, t, h, u in zip(xs, xs[1:], ys, ys[1:])]
        figures = np.stack([x[last] - x[first], y[last] - y[first], last - first,
                            np.bincount(part, minlength=len(parts)), np.zeros(len(parts), np.int64)], axis=1)
        self._keep(parts, [";".join(said[f:t]) for f, t in zip(first.tolist(), last.tolist())], figures, pair, times)

    def _keep(self, parts, said, figures, pair, times) -> None:
        n = len(self.text)
        self.known.update(zip(parts, range(n, n + len(parts))))
        self.text += said
        first = self.held + np.cumsum(figures[:, 3]) - figures[:, 3]
        self.figures = _grown(self.figures, n, np.column_stack([figures, first]))
        self.pairs, self.times = _grown(self.pairs, self.held, pair), _grown(self.times, self.held, times)
        self.held += len(pair)

    def of(self, texts: list[str | None], joined: int = 1 << 16):
        """For each text: (n_a, n_b, n_groups, n_links), its groups as text, and its distinct pairs
        with the times each is linked, as (text number, pair, times) sorted by both."""
        if len(self.known) > self.most:
            self._clear()
        parts = [PART.split(" " + t) if t else () for t in texts]
        known, new, size = self.known, [], 0
        for p in set().union(*parts) - known.keys():
            if p[-1].isspace():  # white space at the end of a text is parted by what follows it
                self._learn([p])
                continue
            new.append(p)
            size += len(p)
            if size >= joined:
                self._learn(new)
                new, size = [], 0
        if new:
            self._learn(new)
        figures = self.figures

        doc = np.repeat(np.arange(len(texts)), [len(ps) for ps in parts])
        numbers = [list(map(known.__getitem__, ps)) for ps in parts]
        held = np.fromiter(chain.from_iterable(numbers), np.int64, len(doc))
        per_text = figures[held, :5]
        sums = np.stack([np.bincount(doc, per_text[:, c], len(texts)) for c in (0, 1, 2, 4)], axis=1).astype(np.int64)
        bad = sums[:, 3] > 0
        sums = np.where(bad[:, None], 0, sums[:, :3])
        said = ["" if bad[k] else ";".join(map(self.text.__getitem__, ks)) for k, ks in enumerate(numbers)]
        keep = ~bad[doc]
        key, times_held = np.unique(doc[keep] * (len(known) + 1) + held[keep], return_counts=True)
        doc, held = key // (len(known) + 1), key % (len(known) + 1)
        count = figures[held, 3]
        place = np.repeat(figures[held, 5], count) + _spread(count)
        doc, pair, weight = _summed(np.repeat(doc, count), self.pairs[place], self.times[place] * np.repeat(times_held, count))
        links = np.bincount(doc, weight, len(texts)).astype(np.int64)
        return np.concatenate([sums, links[:, None]], axis=1), said, (doc, pair, weight)


def _lists(doc: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def aligned(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_a, n_b (tokens), n_groups, n_links,
    groups_sha256 (of the groups' ids as text), pairs and times (its distinct linked pairs, first id
    << 22 | second id, and how often it links them).

    `first` is a byte-level tokenizer's file, `second` a sentencepiece model's; special tokens in a
    text are plain text. Texts that are null or empty, or that a tokenizer does not give back byte for
    byte, have no tokens: zeros, and an empty groups_sha256. Repeated rows are aligned each; a null
    doc_id is carried; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if first is None or second is None:
        import public_tokenizers
        first, second = first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)
    shared = spark.sparkContext.broadcast((read_file(spark, first), read_file(spark, second)))  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteLevel(shared.value[0]), Pieces(shared.value[1]))
        for b in batches:
            figures, said, (doc, pair, times) = aligner.of(b.column(1).to_pylist())
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(figures[:, c]) for c in range(4)), pa.array(digests, pa.string()),
                 _lists(doc, pair, len(said), pa.int64()), _lists(doc, times, len(said), pa.int64())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best) over rows of `aligned`: in how many of them a pair is linked, and whether that
    is the most of all pairs of its first id."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = cut(counts, "pairs")
    first = F.shiftright("pair", ID_BITS)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return cut(counts.withColumn("a", first).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def scored(docs: DataFrame, table_pairs: int = TABLE_PAIRS, **options) -> DataFrame:
    """`aligned`, with n_best (links whose pair is the one, or one of those, that most documents link of
    all with its first id) and count_sum (over links, the number of documents that link the pair).

    Documents meet the table of counts block by block, each of about table_pairs pairs and no more
    than that is ever broadcast; documents' own pairs are never shuffled.
    """
    found = cut(aligned(docs, **options).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(found)
    blocks = counts.count() // table_pairs + 1
    counts = counts.withColumn("block", F.pmod(F.xxhash64("pair"), F.lit(blocks)))
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    sums = None
    for k in range(blocks):
        block = F.broadcast(counts.where(F.col("block") == k).select(F.col("pair").alias("pairs"), "n", "best"))
        met = links.join(block, "pairs").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        sums = met if sums is None else sums.unionByName(met)
    if blocks > 1:
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}).drop("row")
