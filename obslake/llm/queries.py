"""The registered queries of this package, and their DuckDB SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.llm import (alignment, mixing, near_dedup, packing, passages, pieces, prefix_trie, quality, secret_scans, sequence_packing,
                         toxicity, urls, vectors)
from obslake.llm.common import table


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted corpus: documents labelled as of good quality."""
    return table(spark, sf_dir, "labels").where("quality = 1")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = mixing.plan(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "size", "source_size", "target",
                    (F.size("copies") * F.col("size")).cast("long").alias("taken"),
                    F.transform("copies", lambda c: c["shard"]).alias("shards"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


def dated_lists(pages: DataFrame) -> DataFrame:
    """List entries drawn from the pages' own URLs, as the tables hold no list: hosts and first path
    prefixes whose hash ends in certain digits are listed, some of them removed later and listed
    again."""
    p = urls._plain(F.col("url"))
    prefix = F.concat(p["host"], F.array_join(F.slice(F.split(p["path"], "/"), 1, 2), "/"))
    keys = pages.select(F.explode(F.array(p["host"], prefix)).alias("key")).where("key <> ''").distinct()
    h = F.crc32("key")
    dated = keys.where(h % 3 != 0).select(
        F.when(h % 2 == 0, "malware").otherwise("adult").alias("list"), "key", h.alias("h"),
        F.explode(F.sequence(F.lit(0), (h % 4).cast("int"))).alias("turn"))
    return dated.select("list", "key", F.expr("date_add(date'2024-01-01', cast(h % 90 + turn * (20 + h % 37) as int))").alias("date"),
                        F.when(F.col("turn") % 2 == 0, "add").otherwise("remove").alias("action"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    fetched = F.expr("date_add(date'2024-01-01', cast(pmod(page_id * 7919, 365) as int))")
    return urls.judged(pages.select("page_id", "url", fetched.alias("fetched")), dated_lists(pages.select("url")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages_and_spans(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_and_checked(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"))


def op9_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.digest(secret_scans.find_secrets(table(spark, sf_dir, "documents")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations")).drop("node")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the two tokenizers' tokens of every document."""
    return alignment.scored(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4,096 ids."""
    return sequence_packing.packed_pieces(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_source_mixing, op3_quality_rules, op4_url_filters, op5_substring_dedup,
    op6_sentencepiece, op7_toxicity, op8_exact_top_k, op9_token_packing, op10_secret_scans,
    op11_conversation_trie, op12_tokenizer_alignment, op13_sequence_packing, pipeline)}

# The others are no SQL (sketches, hashed counts, draws, fitted weights, pieces, ledgers); tests
# compare them with brute force.
ORACLE: dict[str, str] = {
    # DuckDB has no crc32, which dated_lists uses: steps and crcs compute it byte by byte
    "op4_url_filters": r"""
        WITH steps AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) AS r(i))),
        rest AS (
            SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919 % 365 + 365) % 365 AS INTEGER) AS fetched,
                regexp_replace(regexp_replace(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//', ''), '[?#].*\z', '') AS rest
            FROM pages),
        parts AS (
            SELECT page_id, url, fetched,
                regexp_replace(lower(regexp_extract(rest, '^(?:[^/@]*@)?([^/:]*)', 1)), '\.\z', '') AS host,
                regexp_replace(regexp_extract(rest, '^[^/]*(/.*)?\z', 1), '/+\z', '') AS path FROM rest),
        listed AS (
            SELECT DISTINCT key FROM (
                SELECT host AS key FROM parts
                UNION ALL SELECT host || array_to_string(string_split(path, '/')[1:2], '/') FROM parts) WHERE key <> ''),
        crcs AS (
            SELECT key, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(key))),
                lambda i: CAST('0x' || substr(hex(encode(key)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM listed, steps),
        entries AS (
            SELECT CASE WHEN h % 2 = 0 THEN 'malware' ELSE 'adult' END AS list, key,
                DATE '2024-01-01' + CAST(h % 90 + turn * (20 + h % 37) AS INTEGER) AS day, turn % 2 = 0 AS adds
            FROM (SELECT key, h, unnest(range(h % 4 + 1)) AS turn FROM crcs WHERE h % 3 <> 0)),
        days AS (SELECT list, key, day, bool_or(adds) AS held FROM entries GROUP BY ALL),
        turns AS (
            SELECT * FROM (SELECT *, coalesce(lag(held) OVER (PARTITION BY list, key ORDER BY day), false) AS before FROM days)
            WHERE held <> before),
        intervals AS (
            SELECT list, key, day AS since, until FROM (
                SELECT *, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM turns) WHERE held),
        asked AS (
            SELECT DISTINCT url, fetched, host, string_split(host, '.') AS l, string_split(path, '/') AS s
            FROM parts WHERE url IS NOT NULL AND fetched IS NOT NULL AND host <> ''),
        named AS (
            SELECT DISTINCT url, fetched, unnest(list_concat(
                list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i:], '.')),
                list_transform(range(2, len(s) + 1), lambda i: host || array_to_string(s[1:i], '/')))) AS key FROM asked),
        hits AS (
            SELECT url, fetched, list, n.key, since, row_number() OVER (
                PARTITION BY url, fetched ORDER BY length(n.key) DESC, list, n.key, since) AS place
            FROM named n JOIN intervals i ON n.key = i.key AND fetched >= since AND (until IS NULL OR fetched < until))
        SELECT page_id, p.url, p.fetched, list IS NOT NULL AS blocked, list, key, since
        FROM parts p LEFT JOIN (SELECT * FROM hits WHERE place = 1) h ON p.url = h.url AND p.fetched = h.fetched""",
    "op8_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
