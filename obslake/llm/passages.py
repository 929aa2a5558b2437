"""Substring deduplication: paragraphs (lines) that repeat across or within documents, exactly or
nearly, found by MinHash banding and exact Jaccard verification, and clustered by components; and
spans of 50 words or more that repeat exactly, whatever lines they are in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import cut, small_batches
from obslake.llm.linking import similar_components
from obslake.llm.near_dedup import longs
from obslake.llm.sketch import SHINGLE, Words, band_keys_of, set_id, shingle_sets
from obslake.llm.spans import CHUNK, MARK, WINDOWS, SpanSearch, Tools, chunks, windows_of

# 3/4 similar paragraphs meet in a band with probability 1 - 1.6e-4
BANDS, ROWS = 16, 3
MIN_WORDS = 40
SLOTS = 1 << 24  # bits that tell which texts are read again

# rows read from texts: the set of a wanted line, or the windows of a marked seed
READ = "node long, items array<long>, " + WINDOWS


def _paragraphs(bands: int, rows: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in chunks(b):
                doc, body, texts = zip(*some)
                t = Words(texts)
                long = np.flatnonzero(t.line_count >= min_words)
                if not len(long):
                    continue
                of = np.searchsorted(t.offset, t.line_starts[long], "right") - 1
                offset = t.offset[of]
                counts = t.line_count[long]
                ends = np.cumsum(counts)
                h = t.hashes[np.arange(ends[-1]) + np.repeat(t.line_first[long] - ends + counts, counts)]
                items, sizes = shingle_sets(h, counts)
                sets = np.split(items, np.cumsum(sizes)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(doc, np.int64)[of]), pa.array(np.array(body, np.int64)[of]),
                     *(pa.array(v.astype(np.int32)) for v in (
                         long - np.searchsorted(t.line_starts, offset), t.line_starts[long] - offset, t.line_ends[long] - offset)),
                     pa.array(sizes), pa.array([set_id(s) for s in sets], pa.binary()), longs(list(band_keys_of(items, sizes, bands, rows)))],
                    ["doc_id", "body", "para", "start", "end", "n", "cls", "bands"])
    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of the wanted lines of texts, and the windows of their marked seeds (READ)."""
    tools = Tools()
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    columns = [(n, kinds[k]) for n, k in (c.split() for c in READ.split(", "))]

    def filled(b: pa.RecordBatch) -> pa.RecordBatch:
        have = set(b.schema.names)
        return pa.RecordBatch.from_arrays([b.column(n) if n in have else pa.nulls(b.num_rows, t) for n, t in columns],
                                          [n for n, _ in columns])

    for b in batches:
        texts = b.column("text").to_pylist()
        wanted, lines = [], []
        for text, some in zip(texts, b.column("lines").to_pylist()):
            split = text.split("\n") if some else []
            for w in some or []:
                wanted.append(w)
                lines.append(split[w["para"]])
        if wanted:
            t = Words(lines)
            items, sizes = shingle_sets(t.hashes, t.count)
            sets = [(w["node"], s) for w, s in zip(wanted, np.split(items, np.cumsum(sizes)[:-1])) if set_id(s) == w["cls"]]
            yield filled(pa.RecordBatch.from_arrays([pa.array([v for v, _ in sets], pa.int64()), longs([s for _, s in sets])], ["node", "items"]))
        marks = b.column("marks")
        n = marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = marks.flatten()
        fields = {c.split()[0]: flat.field(c.split()[0]).to_numpy(zero_copy_only=False) for c in MARK.split(", ")}
        doc, body = b.column("doc_id").to_numpy(), b.column("body").to_numpy()
        ends, size = np.cumsum(n), np.cumsum([len(t) for t in texts])
        part = (size - 1) // CHUNK  # texts worked on together
        for p in np.unique(part[n > 0]):
            some = np.flatnonzero((part == p) & (n > 0))
            of = np.repeat(np.arange(len(some)), n[some])
            at = np.concatenate([np.arange(ends[k] - n[k], ends[k]) for k in some])
            yield filled(windows_of(tools, doc[some], body[some], [texts[k] for k in some], of, {c: v[at] for c, v in fields.items()}))


def _bodies(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text") \
        .where("doc_id is not null and text is not null")


def _likely(d: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of d that may be in wanted (doc_id, body), so that few other texts are shuffled to it. Each
    wanted text sets one of SLOTS bits; texts are kept by their bit, so none that is wanted is lost. The
    bits are broadcast as words of 64, at most SLOTS / 64 rows; with more texts they only keep more."""
    slot = F.xxhash64("doc_id", "body").bitwiseAND(F.lit(SLOTS - 1))
    word, bit = F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int")
    bits = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    near = d.withColumns({"word": word, "bit": bit}).join(F.broadcast(bits), "word")
    return near.where(F.getbit("bits", F.col("bit")) == 1).select(*d.columns)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, bands: int = BANDS, rows: int = ROWS,
                      search: SpanSearch | None = None) -> DataFrame:
    """One row per repeated paragraph of docs (doc_id long, text): doc_id, para (line number from 0),
    start, end (code points), n_shingles, component_id and component_para (the first paragraph of
    its cluster, by doc_id and line), removed (all but that one).

    A paragraph is a line of min_words words or more. Two are linked from a Jaccard similarity of
    3/4 of their sets of 5-word shingles (A-Z lower-cased). Paragraphs linked to none are not
    returned. Null and short texts have no paragraphs; rows without a doc_id take no part; rows
    that repeat a doc_id and a text are one document. Other columns of docs are ignored.

    With a search for spans its spans follow, in the same columns. A span's row has no para and no
    component_para; its shingles are counted with repetition. Texts are read once for both.
    """
    small_batches(docs.sparkSession)
    d = _bodies(docs)
    found = cut(d.mapInArrow(_paragraphs(bands, rows, min_words), "doc_id long, body long, para int, start int, end int, "
                             "n long, cls binary, bands array<long>"), "paragraphs")
    place = F.struct("doc_id", "para", "body")
    nodes = found.groupBy("cls").agg(F.min(place).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"),
                                     F.max(F.struct("doc_id", "para")).alias("last"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    windows = []

    def load_sets(seen: DataFrame) -> DataFrame:
        lines = nodes.join(seen, "node", "left_semi").select("rep.doc_id", "rep.body", F.struct("node", "cls", "rep.para").alias("line")) \
            .groupBy("doc_id", "body").agg(F.collect_list("line").alias("lines"))
        if search:
            wanted = lines.join(search.marks, ["doc_id", "body"], "full")
        else:
            wanted = lines.withColumn("marks", F.lit(None).cast(f"array<struct<{MARK.replace(' ', ':').replace(',:', ', ')}>>"))
        wanted = cut(wanted, "wanted", "zstd")
        read = _likely(d, wanted).join(wanted, ["doc_id", "body"]).select("doc_id", "body", "text", "lines", "marks")
        read = cut(read.mapInArrow(_read, READ), "read", "zstd")
        windows.append(read.where("cls is not null").drop("node", "items"))
        return read.where("node is not null").select("node", "items").dropDuplicates(["node"])

    labels = similar_components(nodes.select("node", "n", "bands"), load_sets)
    labelled = nodes.select("node", "cls", F.struct("rep.doc_id", "rep.para").alias("rep"), "last").join(labels, "node", "left") \
        .where((F.col("comp").isNotNull()) | (F.col("rep") != F.col("last"))) \
        .withColumn("comp", F.coalesce("comp", "node"))
    least = labelled.groupBy("comp").agg(F.min("rep").alias("head"), F.max("last").alias("tail")).where("head <> tail")
    by_class = labelled.join(least, "comp").select("cls", "head")
    out = found.select("doc_id", "para", "start", "end", "n", "cls").join(by_class, "cls")
    out = out.select("doc_id", "para", "start", "end", F.col("n").alias("n_shingles"),
                     F.col("head.doc_id").alias("component_id"), F.col("head.para").alias("component_para"),
                     (F.struct("doc_id", "para") != F.col("head")).alias("removed")).distinct()
    if not search:
        return out
    none = F.lit(None).cast("int")
    return out.unionByName(search.spans(windows[0]).select(
        "doc_id", none.alias("para"), "start", "end", (F.col("n_words") - (SHINGLE - 1)).alias("n_shingles"), "component_id",
        none.alias("component_para"), "removed"))


def passages_and_spans(docs: DataFrame) -> DataFrame:
    """Repeated paragraphs and repeated spans of docs, in the columns of repeated_passages()."""
    small_batches(docs.sparkSession)
    return repeated_passages(docs, search=SpanSearch(_bodies(docs)))


def without_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with the removed paragraphs, line feeds included, and spans cut from `text`; all columns
    stay."""
    # a line's end is its line feed, which the last line gets too
    stop = F.when(F.col("para").isNull(), F.col("end")).otherwise(F.col("end") + 1)
    gone = found.where("removed").groupBy(F.col("doc_id").alias("_id")) \
        .agg(F.sort_array(F.collect_set(F.struct("start", stop.alias("stop")))).alias("_gone"))
    d = docs.withColumn("_id", F.col("doc_id").cast("long")).join(gone, "_id", "left")
    text = F.concat("text", F.lit("\n"))
    left = F.aggregate(
        "_gone", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["stop"]).alias("at"),
            F.concat(a["out"], F.substring(text, a["at"] + 1, F.greatest(F.lit(0), s["start"] - a["at"]))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    left = F.regexp_replace(left, r"\n\z", "")
    return d.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)).select(*docs.columns)
