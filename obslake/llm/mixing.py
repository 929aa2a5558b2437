"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are put in a random order on a line of words, which is cut into blocks of
equal width. A source's quota is the number of blocks that its target asks for, counted past the
line's end where documents repeat. A binary tree over the output shards splits the vector of quotas:
at each node the left half draws its blocks without replacement from the node's. A leaf thereby
gets, for each source, a number of blocks and where they begin, so shards hold disjoint runs of the
permuted blocks whose sizes add up to the quotas exactly. Within a shard documents are shuffled.

The tree's colours are the sources. With more than COLOURS of them, sources that follow one another
by name share a colour, their quotas laid end to end, so what the driver and each node of the tree
hold stays bounded; targets and quotas are each source's own all the same. Large shards are written
by several tasks, each with the run of the shuffled order that a document's place falls in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from obslake.llm.common import SPACE_RUN, SPACES, cut

WEIGHTS = (3, 1, 2)
SHARD_WORDS = 1 << 22
MOST_SHARDS = 1024  # all copies look their shard up in a list of this length
MOST_TASKS = 1 << 17
COLOURS = 4096
BLOCK_WORDS = 16
BUCKET_DOCS = 1000
FEW_SOURCES = 1 << 17  # rows of 100 bytes or so: broadcast up to here
SALT = 32
_MOST_BLOCKS = 1 << 28  # numpy draws from fewer than 1e9


def n_words(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    def blank(c):
        return F.translate(c, SPACES, "").eqNullSafe("").cast("int")
    edges = blank(F.substring(t, 1, 1)) + blank(F.substring(t, -1, 1))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, SPACE_RUN)) - edges).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, size, docs) of every source to (source, source_size, docs, target).

    Sources by code point, null last, weigh the weights in turn and share `share` of all words;
    none gets over `most` times its size, and the excess goes to the others by weight: with
    sources sorted by the level (target / weight) at which they are full, the common level is the
    least one that the sources not yet full can pay for. One row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.get(F.array(*(F.lit(x) for x in weights)), (F.row_number().over(by_name) - 1) % len(weights))
    s = sizes.select("source", F.col("size").alias("source_size"), "docs", w.cast("long").alias("w")) \
        .withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("open", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()))
    s = s.withColumn("level", (F.lit(share) * F.col("all") - F.col("full")) / F.col("open"))
    # the first source, in this order, that its level leaves unfilled sets the level of all after it
    s = s.withColumn("at", F.row_number().over(order))
    s = s.withColumn("common", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("at", "level")))
                     .over(Window.partitionBy()))
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("common.level") * F.col("w")), F.col("cap").cast("double"))
    return s.select("source", "source_size", "docs", target.alias("target"))


def leaf(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of one shard, for each source: a walk from the root, which
    holds all quotas, to the shard's leaf. A node's draw depends on the seed and the node alone."""
    held, start, lo, hi = quotas.copy(), np.zeros_like(quotas), 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(held, int(held.sum()) * (mid - lo) // (hi - lo), method="marginals") \
            if held.any() else held
        if shard < mid:
            held, hi = left, mid
        else:
            start, held, lo = start + left, held - left, mid
    return start, held


def enough_shards(words: int) -> tuple[int, int]:
    """Shards for a mix of so many words, and tasks that write one."""
    wanted = max(1, -(-words // SHARD_WORDS))
    shards = min(wanted, MOST_SHARDS)
    return shards, min(-(-wanted // shards), MOST_TASKS // shards)


def _lines(docs: DataFrame, sizes: DataFrame, weights, share: float, most: int, shards: int | None,
           block_words: int, seed: int, colours: int) -> tuple[DataFrame, DataFrame, int, int, int, int]:
    """The sources' lines (k, colour, _s, source_size, docs, target, quota, blocks, before: blocks of
    its colour before its own), each colour's shard ends, and block, shards, tasks a shard, sources."""
    spark = docs.sparkSession
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    wanted = cut(targets(sizes, weights, share, most).withColumn("k", (F.row_number().over(by_name) - 1).cast("long")), "targets")
    total = wanted.agg(F.count("*").alias("sources"), F.coalesce(F.sum(F.floor("target")), F.lit(0)).alias("words")).first()
    n, total_words = int(total.sources), int(total.words)
    enough, tasks = enough_shards(total_words)
    shards, tasks = (enough, tasks) if shards is None else (shards, 1)
    block = max(block_words, total_words // _MOST_BLOCKS + 1)
    quota = F.bround(F.col("target") / block).cast("long")
    lines = wanted.withColumn("quota", quota).withColumn("colour", F.expr(f"k div {-(-max(n, 1) // colours)}")) \
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block)).cast("long"))
    before = Window.partitionBy("colour").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    lines = cut(lines.withColumn("before", F.coalesce(F.sum("quota").over(before), F.lit(0)))
                .withColumnRenamed("source", "_s"), "lines")
    held = lines.groupBy("colour").agg(F.sum("quota").alias("quota")).orderBy("colour").collect()  # `colours` rows at most
    quotas = np.array([r.quota for r in held], np.int64)

    # the shards' ends on each colour's sequence of blocks, one row for each colour
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard in b["id"]:
                start, took = leaf(quotas, shards, int(shard), seed)
                yield pd.DataFrame({"colour": np.arange(len(quotas)), "shard": shard, "stop": start + took})
    ends = spark.range(shards).mapInPandas(walk, "colour long, shard long, stop long").groupBy("colour") \
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "stop"))), lambda x: x["stop"]).alias("ends"))
    return lines, cut(ends, "ends"), block, shards, tasks, n


def _with_line(d: DataFrame, lines: DataFrame, sources: int) -> DataFrame:
    """d with its source's line: broadcast where sources are few by their count, else joined, each
    source spread over SALT keys."""
    same = F.col("source").eqNullSafe(F.col("_s"))
    if sources <= FEW_SOURCES:
        return d.join(F.broadcast(lines), same)
    d = d.withColumn("_salt", F.pmod("_h", F.lit(SALT)))
    spread = lines.withColumn("_lsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    return d.join(spread, same & (F.col("_salt") == F.col("_lsalt"))).drop("_salt", "_lsalt")


def _planned(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2, shards: int | None = None,
             block_words: int = BLOCK_WORDS, seed: int = 17, colours: int = COLOURS,
             carry: bool = False) -> tuple[DataFrame, int, int]:
    """The rows of plan(), with carry all columns of the document as `row` besides; the number of
    shards; and tasks a shard."""
    d = docs.select("doc_id", "source", F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("_h"),
                    n_words(F.col("text")).alias("size"), *([F.struct("*").alias("row")] if carry else []))
    per_source = d.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    lines, ends, block, shards, tasks, sources = _lines(docs, per_source, weights, share, most, shards, block_words,
                                                        seed, colours)

    # places on the line: buckets of the hash in order, then documents in order within their bucket
    d = _with_line(d, lines, sources)
    bucket = F.floor(F.shiftrightunsigned("_h", 11) / F.lit(2.0 ** 53) * F.ceil(F.col("docs") / BUCKET_DOCS)).cast("long")
    d = d.withColumn("bucket", bucket)
    offsets = d.groupBy("k", "bucket").agg(F.sum("size").alias("held")) \
        .withColumn("ahead", F.sum("held").over(Window.partitionBy("k").orderBy("bucket")) - F.col("held")) \
        .select("k", "bucket", "ahead")
    inside = Window.partitionBy("k", "bucket").orderBy(F.shiftrightunsigned("_h", 11), "_h", "size", "doc_id") \
        .rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("upto", F.sum("size").over(inside)).join(offsets, ["k", "bucket"])
    middle = F.col("ahead") + F.col("upto") - F.col("size") / 2
    at = F.least(F.floor(middle / block).cast("long"), F.col("blocks") - 1)
    turns = F.transform(F.array(*(F.lit(t) for t in range(most))), lambda t: at + t * F.col("blocks"))
    taken = F.transform(F.filter(turns, lambda b: b < F.col("quota")), lambda b: b + F.col("before"))
    # a copy is dealt to the shard whose run holds its block; a block past the last run is in no mix
    d = d.withColumn("taken", taken).join(F.broadcast(ends), "colour")  # colours x shards numbers at most
    copies = F.filter(F.transform("taken", lambda b: F.struct(
        F.size(F.filter("ends", lambda e: e <= b)).alias("shard"),
        F.xxhash64(F.col("_h"), b, F.lit(seed)).alias("place"))), lambda c: c["shard"] < F.size("ends"))
    p = d.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), *(["row"] if carry else []))
    return p, shards, tasks


def plan(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size (words), source, source_size,
    target (of its source), copies (array of {shard, place}: where the mix takes the document; none,
    one or `most` at most).

    Options: weights, share and most (see targets()), shards (by default one for SHARD_WORDS words of
    the mix, MOST_SHARDS at most), block_words, seed, colours. Documents are taken whole, where the
    middle of their words on the line falls in a block of the quota, so a source's words miss its
    target by half a block and half a document at most. The order on the line follows a hash of the
    row, so reruns agree. A null text has size 0; a null source is a source of its own, last in order;
    repeated rows are taken each on its own; other columns are ignored.
    """
    return _planned(docs, **options)[0]


def mixed(docs: DataFrame, shards: int | None = None, **options) -> DataFrame:
    """The mix itself: every row of docs once for each copy taken, all columns, shard after shard and
    shuffled within them. A shard has a partition of its own, or several that follow one another.
    The options are those of plan()."""
    p, shards, tasks = _planned(docs, shards=shards, carry=True, **options)
    rows = p.select("row", F.explode("copies").alias("copy"))
    run = F.floor(F.shiftrightunsigned("copy.place", 11) / F.lit(2.0 ** 53) * tasks)
    order = F.shiftrightunsigned("copy.place", 1)  # as the runs are, by the place's unsigned value
    return rows.repartitionById(shards * tasks, (F.col("copy.shard") * tasks + run).cast("int")) \
        .sortWithinPartitions("copy.shard", order).select("row.*")
