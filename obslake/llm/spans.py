"""Repeated spans: runs of SPAN_WORDS words or more that occur at two or more places, however the text
is broken into lines.

Every run of SPAN_WORDS words is a paragraph of its own here, a window. Its band key is the MinHash of
its runs of SEED words: the least of their hashes, its seed. Equal windows have the same seed at the
same place, so they always meet; neighbours mostly share their seed, so one row holds all windows
of one seed. Rows of a seed with the same words throughout are one class, which its first place
stands for. Only where a seed has several classes, at the edges of repeated passages, are single
windows compared. Windows are equal if two independent 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from obslake.llm.common import cut
from obslake.llm.sketch import Words, mixed

SPAN_WORDS = 50
SEED = 12
CHUNK = 1 << 20  # code points of texts worked on at once; a longer text is worked on alone

# a seed's row: its word's place, how many windows begin before and from there on, their first start and last end
SEEDS = "seed long, same long, doc_id long, body long, pos int, before int, after int, start int, size int"
# a marked seed: windows' hashes (of a class's first place only), starts and ends from the first window's on
WINDOWS = "cls long, seed long, doc_id long, body long, pos int, before int, start int, end int, windows array<long>, starts array<int>, ends array<int>"
MARK = "cls long, seed long, pos int, before int, after int, leads boolean"


class Runs:
    """Hashes of all runs of some words: differences of running sums of word hashes times powers of
    an odd number, brought to one power."""

    def __init__(self, odd: int):
        self.odd, self.inverse = odd, pow(odd, -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def sums(self, h: np.ndarray) -> np.ndarray:
        while len(self.up) <= len(h):
            n = len(self.up)
            for name, step in (("up", self.odd), ("down", self.inverse)):
                p = getattr(self, name)
                setattr(self, name, np.concatenate([p, p * np.uint64(pow(step, n, 1 << 64))]))
        out = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[:len(h)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[at]) * self.down[at])


class Texts(Words):
    """The words of some texts, and sums for the hashes of their runs."""

    def __init__(self, tools: Tools, texts: Sequence[str]):
        super().__init__(texts)
        self.tools = tools
        self.seed_sums, self.same_sums = tools.seeds.sums(self.hashes), tools.same.sums(self.hashes)

    def equal(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.tools.same.hashes(self.same_sums, at, ends)


class Tools:
    """What a task keeps from text to text."""

    def __init__(self):
        self.seeds, self.same = Runs(0x9E3779B97F4A7C15), Runs(0xD1342543DE82EF95)


def first_least(h: np.ndarray, n: int) -> np.ndarray:
    """For every n consecutive values the place of the least one, of equal ones the first."""
    if len(h) < n:
        return np.empty(0, np.int64)
    at, size = np.arange(len(h)), 1

    def of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(h[b] < h[a], b, a)

    while 2 * size <= n:
        at, size = of(at[:-size], at[size:]), 2 * size
    return of(at[:len(at) - (n - size)], at[n - size:]) if n > size else at


def _rows_of(t: Texts, span: int, seed: int):
    """Word ranges of seeds and of the windows that each of them stands for: (text, seed's hash, its
    word, first window, last window)."""
    runs = np.arange(max(t.n - seed + 1, 0))
    h = t.tools.seeds.hashes(t.seed_sums, runs, runs + seed)
    own = first_least(h, span - seed + 1)
    stop = np.repeat(t.first + t.count, t.count)
    at = np.flatnonzero(np.arange(len(own)) + span <= stop[:len(own)])  # windows inside of a text
    if not len(at):
        return (np.empty(0, np.int64),) * 5
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(own[at]) != 0)
    heads = np.flatnonzero(new)
    lo, hi = at[heads], at[np.append(heads[1:], len(at)) - 1]
    word = own[lo]
    return np.searchsorted(t.first, lo, "right") - 1, h[word], word, lo, hi


def chunks(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """The rows (doc_id, body, text) of a batch, as many at once as CHUNK allows."""
    some, size = [], 0
    for row in zip(*(c.to_pylist() for c in batch.columns)):
        if some and size + len(row[2]) > CHUNK:
            yield some
            some, size = [], 0
        some.append(row)
        size += len(row[2])
    if some:
        yield some


def _seeds(span: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Tools()
        for b in batches:
            for rows in chunks(b):
                doc, body, texts = zip(*rows)
                t = Texts(tools, texts)
                of, h, word, lo, hi = _rows_of(t, span, seed)
                same = mixed(t.equal(lo, hi + span) + ((word - lo) * 64 + (hi - lo)).astype(np.uint64))
                first, offset = t.first[of], t.offset[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.uint64).view(np.int64)), pa.array(same.view(np.int64)),
                     pa.array(np.array(doc, np.int64)[of]), pa.array(np.array(body, np.int64)[of]),
                     *(pa.array(v.astype(np.int32)) for v in (
                         word - first, word - lo, word - hi, t.starts[lo] - offset, t.ends[hi + span - 1] - t.starts[lo]))],
                    [c.split()[0] for c in SEEDS.split(", ")])
    return run


def windows_of(tools: Tools, doc: np.ndarray, body: np.ndarray, texts: list[str], of: np.ndarray,
               marks: dict[str, np.ndarray], span: int = SPAN_WORDS) -> pa.RecordBatch:
    """The windows (WINDOWS) of these seeds of some texts; `of` tells the text of each seed."""
    t = Texts(tools, texts)
    lo = t.first[of] + marks["pos"] - marks["before"]
    sizes = marks["before"].astype(np.int64) - marks["after"] + 1

    def flat(sizes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        ends = np.cumsum(sizes)
        return np.repeat(lo - ends + sizes, sizes) + np.arange(sizes.sum()), pa.array(np.append(0, ends).astype(np.int32))

    at, ends = flat(sizes)
    led, led_ends = flat(np.where(marks["leads"], sizes, 0))
    start, end = t.starts[lo], t.ends[lo + span - 1]

    def ints(v: np.ndarray) -> pa.Array:
        return pa.array(v.astype(np.int32))

    return pa.RecordBatch.from_arrays(
        [pa.array(marks["cls"]), pa.array(marks["seed"]), pa.array(doc[of]), pa.array(body[of]), ints(marks["pos"]),
         ints(marks["before"]), ints(start - t.offset[of]), ints(end - t.offset[of]),
         pa.ListArray.from_arrays(led_ends, pa.array(t.equal(led, led + span).view(np.int64))),
         pa.ListArray.from_arrays(ends, ints(t.starts[at] - np.repeat(start, sizes))),
         pa.ListArray.from_arrays(ends, ints(t.ends[at + span - 1] - np.repeat(end, sizes)))],
        [c.split()[0] for c in WINDOWS.split(", ")])


def _apart(a: str, b: str, words: int) -> Column:
    """Whether place a is no overlapping run of place b's text."""
    return F.expr(f"{a}.doc_id <> {b}.doc_id or {a}.body <> {b}.body or {a}.pos - {b}.pos >= {words}")


class SpanSearch:
    """The search for repeated spans of d (doc_id long, body long: a hash of the text, text), in two
    steps: `marks` (doc_id, body, marks) are the seeds whose windows must be compared, and spans()
    takes these windows, which the caller reads from the texts by windows_of()."""

    def __init__(self, d: DataFrame, words: int = SPAN_WORDS, seed: int = SEED):
        self.words = words
        seeds = d.where("text is not null").mapInArrow(_seeds(words, seed), SEEDS)
        at = F.struct("doc_id", "body", "pos")
        # all in one shuffle by seed; seeds found once are gone before places are compared
        of_seed, of_class = Window.partitionBy("seed"), Window.partitionBy("seed", "same")
        shared = seeds.withColumns({"n": F.count("*").over(of_seed), "several": F.min("same").over(of_seed) != F.max("same").over(of_seed)}) \
            .where("n > 1").drop("n").withColumns({"head": F.min(at).over(of_class), "tail": F.max(at).over(of_class)})
        self.shared = cut(shared, "shared-seeds", "zstd")
        # numbers of classes grow with their first places
        numbered = self.shared.where(F.col("several") & (at == F.col("head"))).select("seed", "same", "head", "tail").distinct().orderBy("head")
        self.numbered = cut(numbered.withColumn("cls", F.monotonically_increasing_id()), "numbered-classes")
        mark = F.struct("cls", "seed", "pos", "before", "after", (at == F.col("head")).alias("leads"))
        self.marks = self.shared.where("several").join(self.numbered.select("cls", "seed", "same"), ["seed", "same"]) \
            .groupBy("doc_id", "body").agg(F.collect_set(mark).alias("marks"))

    def spans(self, windows: DataFrame) -> DataFrame:
        """One row per repeated span: doc_id, start, end (code points), n_words, component_id (the
        doc_id of the first place), removed (whether an earlier place has it).

        A window is `words` consecutive words (A-Z lower-cased, any white space between them); it
        repeats if it occurs in two documents, or twice in one without overlap. Its first place is the
        least by doc_id, then by place. A span is a maximal run of windows whose first places follow
        one another too, so spans of different origin may overlap; together they cover every window
        that repeats. Where a place is cut, an earlier place has its words, so a copy of every word
        stays. Rows that repeat a doc_id and a text are one document.
        """
        n = self.words
        at = F.struct("doc_id", "body", "pos")
        # seeds of one class: all windows have the same places
        found = self.shared.where("not several").where(_apart("tail", "head", n)).select(
            "doc_id", "body", "pos", "before", "after", "start", (F.col("start") + F.col("size")).alias("end"), "head")
        # of several classes: windows of each class's first place, met by their words; k is the seed's place in them
        known = self.numbered.select("cls", "head", F.xxhash64("head.doc_id", "head.body").alias("of"),
                                     F.col("head.pos").alias("least"), F.col("tail.pos").alias("most"),
                                     _apart("tail", "head", n).alias("apart"))
        led = windows.where("size(windows) > 0").select("cls", "seed", "before", "windows").dropDuplicates(["cls"])
        single = led.join(known.drop("head"), "cls").select(
            "cls", "seed", "of", "least", "most", "apart", "before", F.posexplode("windows").alias("i", "window")) \
            .withColumn("k", F.col("before") - F.col("i")).withColumn("place", F.xxhash64("seed", "k"))
        equal = Window.partitionBy("place", "window")
        met = single.withColumn("size", F.count("*").over(equal)).where("size > 1 or apart").select(
            "cls", "k", F.min("cls").over(equal).alias("first"), F.min("of").over(equal).alias("of"), F.max("of").over(equal).alias("of2"),
            F.min("least").over(equal).alias("least"), F.max("most").over(equal).alias("most"), F.max("apart").over(equal).alias("apart")) \
            .where(f"apart or of <> of2 or most - least >= {n}").select("cls", "k", "first")
        run = F.col("k") - F.row_number().over(Window.partitionBy("cls", "first").orderBy("k"))
        ranges = met.withColumn("run", run).groupBy("cls", "first", "run") \
            .agg(F.min("k").alias("after"), F.max("k").alias("before"))
        ranges = ranges.join(known.select(F.col("cls").alias("first"), "head"), "first") \
            .select("cls", "head", F.col("before").alias("_before"), F.col("after").alias("_after"))
        part = windows.join(ranges, "cls").select(
            "doc_id", "body", "pos", F.col("_before").alias("before"), F.col("_after").alias("after"),
            (F.col("start") + F.get("starts", F.col("before") - F.col("_before"))).alias("start"),
            (F.col("end") + F.get("ends", F.col("before") - F.col("_after"))).alias("end"), "head")
        found = found.unionByName(part).withColumn("at", at).withColumn("removed", _apart("at", "head", n)).select(
            "doc_id", "body", (F.col("pos") - F.col("before")).alias("lo"), (F.col("pos") - F.col("after")).alias("hi"),
            "start", "end", "removed", F.col("head.doc_id").alias("component_id"),
            F.col("head.body").alias("first"), (F.col("pos") - F.col("head.pos")).alias("shift"))
        # rows found twice, of texts given twice, fall into one run
        line = ["doc_id", "body", "component_id", "first", "shift", "removed"]
        order = Window.partitionBy(*line).orderBy("lo")
        new = F.coalesce((F.col("lo") > F.lag("hi").over(order) + 1).cast("int"), F.lit(1))
        return found.withColumn("new", new).withColumn("run", F.sum("new").over(order)).groupBy(*line, "run").agg(
            F.min("start").alias("start"), F.max("end").alias("end"),
            (F.max("hi") - F.min("lo") + n).cast("long").alias("n_words")) \
            .select("doc_id", "start", "end", "n_words", "component_id", "removed")
