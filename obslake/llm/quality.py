"""Quality rules: hashed n-gram log-likelihood ratio of a trusted corpus against the raw one.

Word unigrams and bigrams are hashed into a fixed number of buckets. Two multinomials over the
buckets are counted: one over every text of the corpus, one over its trusted texts. A bucket's
ratio p_trusted / p_raw is its trusted count to the count that its share of the corpus lets expect,
each with `smoothing` more, so rare n-grams weigh little. A document scores the mean log of that ratio
over its n-grams, and is kept from `threshold` on, unless a base rule has failed it.

Main path: DataFrame functions only. One shuffle joins the trusted ids to the texts; counts are
summed per task before they are shuffled; the weights (one double for each bucket) are one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obslake.llm.common import SPACES, words

# fixed values of the base rules
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50


# Arrays are walked by zip_with() and never named inside a lambda: should the optimizer put the
# expression of an array in place of its name, it is computed a few times, not once for each element.


def _after(ws: Column, k: int) -> Column:
    """The words from the k-th on (from 0)."""
    return F.slice(ws, k + 1, F.greatest(F.size(ws) - k, F.lit(0)))


def _hashed(d: DataFrame, text: str) -> DataFrame:
    """d with _w (words), and the hashes _h1 of each word, _h2 of each word with its successor (the
    last one with none) and _h3 of each 3-word window."""
    d = d.withColumn("_w", words(F.col(text)))
    d = d.withColumn("_h1", F.transform("_w", lambda w: F.xxhash64(w)))
    d = d.withColumn("_h2", F.zip_with("_h1", _after(F.col("_h1"), 1), lambda a, b: F.xxhash64(a, b)))
    return d.withColumn("_h3", F.slice(F.zip_with("_h2", _after(F.col("_h1"), 2), lambda a, b: F.xxhash64(a, b)),
                                       1, F.greatest(F.size("_h1") - 2, F.lit(0))))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def bucket_weights(docs: DataFrame, trusted_ids: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One row, column `weights`: the log ratio by bucket. Without trusted texts all are 0."""
    trusted = trusted_ids.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct() \
        .withColumn("_t", F.lit(1))
    # the text, not its words, goes through the shuffle
    d = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")) \
        .join(trusted.hint("merge"), "_id", "left").select("_t", "_text")
    grams = _hashed(d, "_text").select("_t", F.explode(F.concat("_h1", "_h2")).alias("h"))
    counts = grams.groupBy(_bucket(F.col("h"), buckets).alias("b")).agg(F.count("*").alias("raw"), F.count("_t").alias("trusted"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    filled = every.join(counts, "b", "left").na.fill(0, ["raw", "trusted"])
    row = filled.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "trusted"))).alias("c"),
                     F.sum("raw").alias("n_raw"), F.sum("trusted").alias("n_trusted"))
    share = F.coalesce(F.col("n_trusted") / F.nullif("n_raw", F.lit(0)), F.lit(0.0))
    return row.select(F.transform("c", lambda x: F.when(F.col("n_trusted") == 0, 0.0).otherwise(
        F.log((x["trusted"] + smoothing) / (x["raw"] * share + smoothing)))).alias("weights"))


def _placed(hashes: Column) -> Column:
    """Windows as (hash, place), sorted, so that equal ones are neighbours; none if no two are equal."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed) \
        .otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)"))


def _repeated(placed: Column) -> Column:
    """How many words lie in a 3-word window found twice or more: the places of windows that equal
    a neighbour, spread to their words."""
    same = F.flatten(F.filter(F.zip_with(placed, _after(placed, 1), lambda x, y: F.when(
        x["h"] == y["h"], F.array(x["i"], y["i"]))), lambda x: x.isNotNull()))
    return F.size(F.array_distinct(F.flatten(F.transform(same, lambda i: F.array(i, i + 1, i + 2)))))


def base_stats(docs: DataFrame) -> DataFrame:
    """_doc (the row), _h1 and _h2, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed."""
    d = docs.select(F.struct("*").alias("_doc"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = _hashed(d, "_text").select(
        "_doc", "_h1", "_h2", "_h3", lines.alias("_lines"), F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"))
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")) \
        .withColumn("_p", _placed(F.col("_h3"))) \
        .withColumn("n_repeat_words", _repeated(F.col("_p")).cast("long")).drop("_lines", "_h3", "_p")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _scored(docs: DataFrame, trusted_ids: DataFrame, buckets: int, smoothing: float, threshold: float) -> DataFrame:
    weights = bucket_weights(docs, trusted_ids, buckets, smoothing)
    d = base_stats(docs).withColumn("_k", F.lit(0))
    d = d.join(F.broadcast(weights.withColumn("_k", F.lit(0))), "_k")  # one row of `buckets` doubles

    def total(hashes):
        return F.aggregate(hashes, F.lit(0.0), lambda a, h: a + F.get(F.col("weights"), _bucket(h, buckets)))
    d = d.withColumn("score", F.when(F.col("n_words") == 0, 0.0)
                     .otherwise((total("_h1") + total("_h2")) / (2 * F.col("n_words"))))
    return d.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(F.col("score") >= threshold))


def quality(docs: DataFrame, trusted_ids: DataFrame, buckets: int = 1 << 16, smoothing: float = 20.0,
            threshold: float = -0.075) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score, kept.

    score: mean log-likelihood ratio of the document's n-grams; 0 without words, or without any
    trusted text. A null text counts as empty; a null doc_id is never trusted but is scored;
    repeated rows are scored (and counted) each; other columns of docs are ignored.
    """
    d = _scored(docs.select("doc_id", "text"), trusted_ids, buckets, smoothing, threshold)
    return d.select("_doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "score", "kept")


def kept_documents(docs: DataFrame, trusted_ids: DataFrame, buckets: int = 1 << 16, smoothing: float = 20.0,
                   threshold: float = -0.075) -> DataFrame:
    """The rows of docs that quality() keeps, all columns."""
    return _scored(docs, trusted_ids, buckets, smoothing, threshold).where("kept").select("_doc.*")
