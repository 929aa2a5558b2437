"""Exact top-k search by inner product with vector-approximation files.

Every vector has two forms: cells (a byte for each component, which names an interval of a grid)
and the exact integers. Vectors are kept in files of bounded length. For a block of queries a file
is scanned by its cells, which bound every score from above and below; exact vectors are then
read in the order of their bounds until the k-th best result is certain. The best k of each file
are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from obslake.llm.common import cut

CELLS = 32
FILE_VECTORS = 8192
QUERY_BLOCK = 1024


def integers(vector: Column) -> Column:
    """Components as floor(256 x); null for a vector that is null, empty, or has a component that is
    null or not finite."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.transform(vector, lambda x: x.cast("double"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & F.forall(v, lambda x: F.coalesce(finite(x), F.lit(False))),
                  F.transform(v, lambda x: F.floor(x * 256).cast("long")))


def cells_of(exact: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, and the least and the greatest value in each dimension's cells. The
    grid parts a dimension's values into about equally full cells."""
    steps = np.linspace(0, 1, cells + 1)[1:-1]
    code = np.empty(exact.shape, np.uint8)
    low, high = np.zeros((exact.shape[1], cells)), np.zeros((exact.shape[1], cells))
    for j in range(exact.shape[1]):
        grid = np.quantile(exact[:, j], steps, method="lower")
        code[:, j] = np.searchsorted(grid, exact[:, j], side="right")
        order = np.argsort(code[:, j], kind="stable")
        used, first = np.unique(code[order, j], return_index=True)
        low[j, used] = np.minimum.reduceat(exact[order, j], first)
        high[j, used] = np.maximum.reduceat(exact[order, j], first)
    return code, low, high


def best_in_file(queries: np.ndarray, exact: np.ndarray, k: int, cells: int = CELLS, step: int = 64):
    """For each query, (numbers, scores) of vectors that include its k best of the file, ties kept."""
    code, low, high = cells_of(exact, cells)
    dims = np.arange(exact.shape[1])
    # bounds of all scores: positive components take one end of a cell, negative ones the other
    up, down = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    least, most = low[dims, code], high[dims, code]  # one row for each vector of the file
    upper = up @ most.T + down @ least.T
    lower = up @ least.T + down @ most.T
    for q, above, below in zip(queries, upper, lower):
        # no vector whose upper bound is under the k-th best lower bound can be a result
        enough = np.partition(below, -k)[-k] if len(below) > k else -np.inf
        order = np.flatnonzero(above >= enough)
        order = order[np.argsort(-above[order], kind="stable")]
        found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(order), step):
            if len(scores) >= k and above[order[at]] < np.partition(scores, -k)[-k]:
                break  # all that follow are worse than the k-th: it is certain
            part = order[at:at + step]
            found, scores = np.append(found, part), np.append(scores, exact[part] @ q)
        if len(scores) > k:
            keep = scores >= np.partition(scores, -k)[-k]
            found, scores = found[keep], scores[keep]
        yield found, scores


def _searcher(k: int, cells: int):
    """Search one file for one block of queries, both of one dimension."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [], "cid": [], "score": []}
        if len(left) and len(right):
            exact = np.stack(right["v"].to_numpy()).astype(np.int64)
            ids = right["cid"].to_numpy()
            queries = np.stack(left["v"].to_numpy()).astype(np.int64)
            # one more than k: a query's own vector may be among them
            for qid, (found, scores) in zip(left["qid"], best_in_file(queries, exact, k, cells)):
                out["qid"].append(np.full(len(found), qid))
                out["cid"].append(ids[found])
                out["score"].append(scores)
        kind = {"qid": np.int64, "cid": np.int64, "score": np.int64}
        return pd.DataFrame({c: np.concatenate(v).astype(kind[c]) if v else np.empty(0, kind[c]) for c, v in out.items()})
    return run


def top_k(table: DataFrame, k: int = 5, every: int = 50, cells: int = CELLS, file_vectors: int = FILE_VECTORS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products.

    table: vec_id, embedding. Queries are the rows whose vec_id is divisible by `every`, candidates
    all rows with another vec_id; scores are of floor(256 x), ties go to the smaller vec_id. Vectors that
    are null, empty, or hold a null or non-finite component take no part, nor do rows without a vec_id;
    vectors of different lengths are not compared. Of rows that repeat a vec_id with different
    vectors, each is a candidate, and the vec_id's best counts; a query takes the first of them in
    the order of their components. Other columns are ignored.

    Equal vectors are one class, searched once as query and as candidate: only its k + 1 least
    ids can be in a result, so a vector that a third of all rows share costs no more than another.
    """
    d = table.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("v")) \
        .where("vec_id is not null and v is not null")
    least = Window.partitionBy("v").orderBy("vec_id")
    distinct = d.groupBy("v", "vec_id").agg(F.count("*").alias("_n")).drop("_n")
    held = distinct.withColumn("at", F.row_number().over(least)).where(F.col("at") <= k + 1)
    classes = held.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    asked = cut(d.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "asked")
    queries = asked.groupBy("v").agg(F.count("*").alias("_n")).join(classes.select("v", "cid"), "v") \
        .select(F.col("cid").alias("qid"), "v")

    files = int(classes.count() // file_vectors) + 1
    blocks = int(queries.count() // query_block) + 1
    dealt = classes.select("cid", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("cid"), F.lit(files)).alias("file"))
    asking = queries.select("qid", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("qid"), F.lit(blocks)).alias("block"))
    # each block of queries meets each file once
    left = asking.withColumn("file", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(files - 1).cast("long"))))
    right = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["block", "file", "dim"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)) \
        .applyInPandas(_searcher(k + 1, cells), "qid long, cid long, score long")
    near = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    # classes of one score: those of the k + 1 best scores may all matter for ties
    found = found.withColumn("level", F.rank().over(near.orderBy(F.desc("score")))).where(F.col("level") <= k + 1)

    members = found.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    per_class = members.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = per_class.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1) \
        .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("best"))
    own = asked.join(classes.select("v", F.col("cid").alias("qid")), "v").select("qid", F.col("vec_id").alias("query_id"))
    result = own.join(best, "qid").select("query_id", F.posexplode(F.slice(F.filter(
        "best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("pos", "hit"))
    return result.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
