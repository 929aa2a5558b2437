"""Scans, sinks and keyed tables (S1-S23, G7, T9) on Parquet / CSV / JSON files.

"Append" into a keyed store means upsert: the latest version per key wins. `keyed` holds the tables
themselves, with atomic commits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.schemas import DAY_S, LONG_MEASURES, LONG_TRENDS, OBS_NESTED
from obslake.sources.keyed import KeyedTable, list_names


# --- scans ----------------------------------------------------------------------------------

def read_history_json(spark: SparkSession, path: str, schema: T.StructType = OBS_NESTED,
                      multiline: bool = False) -> DataFrame:
    """Nested JSON history with a declared schema (no inference pass over the data).
    JSON lines (or one array per line) split across tasks; multiline=True reads pretty-printed
    documents, at one task per file, so large histories should be stored as JSON lines."""
    r = spark.read.schema(schema)
    if multiline:
        r = r.option("multiLine", True)
    return r.json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A keyed table as of its newest commit, or a plain Parquet folder."""
    t = KeyedTable(spark, path)
    return t.read() if t.exists() else spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, trends: bool = False,
                    columns: tuple[str, ...] | None = None) -> DataFrame:
    """CSV with header and declared schema, columns picked by name in order."""
    schema = LONG_TRENDS if trends else LONG_MEASURES
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.select(*(columns or [f.name for f in schema.fields]))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """S12 (batch): one text line per row in column `value`."""
    return spark.read.text(path)


# --- sinks ----------------------------------------------------------------------------------

def create_table(df: DataFrame, path: str, key: str = "unix_date", partition_by: str | None = "year",
                 initial_partitions: int | None = None, overwrite: bool = False) -> None:
    """Create and load a keyed table; fails if there is one unless told to overwrite it. The
    size of the data decides how many files a partition has; initial_partitions (the pre-split of the
    original store) ranges the rows over that many first."""
    if initial_partitions:
        df = df.repartitionByRange(initial_partitions, F.col(key))
    KeyedTable(df.sparkSession, path, [key], partition_by).create(df, overwrite)


def write_csv_single(df: DataFrame, path: str) -> None:
    """One CSV file with header. Only for results whose size is bounded by construction
    (records: 6 rows per season; trends: 4 years x 9 measures per season)."""
    df.coalesce(1).write.mode("overwrite").option("sep", ",").option("header", True).csv(path)


def to_json_lines(df: DataFrame) -> DataFrame:
    """Each row as a JSON object text (column `json`)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias("json"))


def preview(df: DataFrame, n: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """The first n rows in the order of `by` (a limit is the feature here)."""
    return (df.orderBy(*by) if by else df).limit(n)


# --- keyed semantics (G7, S5, S6, S13, S14, T9) ----------------------------------------------

def upsert_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest version per key by `order` (ascending = older). One groupBy with max_by over a
    struct: partial aggregation combines versions map-side, so a key with millions of versions
    never reaches one task as raw rows."""
    payload = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) for c in order])
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), ordkey).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in payload])


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet folder or keyed table at path, its declared columns alone; no rows before its first write."""
    empty = spark.createDataFrame([], schema)
    t = KeyedTable(spark, path)
    if t.exists():
        return t.read().select(*empty.columns) if t.manifest().entries else empty
    if any(n[0] not in "._" for n in list_names(spark, path)):
        return spark.read.schema(empty.schema).parquet(path).select(*empty.columns)
    return empty


def write_rejects(rejects: DataFrame, path: str, run: str, batch_id: int) -> None:
    """The raw text of a micro-batch's unreadable rows, in a folder of its run and batch; a replay
    writes the same folder again. Nothing is written where there are none."""
    if not rejects.isEmpty():
        rejects.select(F.col("value").cast("string").alias("value")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{path}/run={run}/batch={batch_id}")


def merge_upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: list[str],
                 partition_by: str | None, newest_by: tuple[str, ...] = ()) -> None:
    """Upsert `new` into the keyed table at `path`, in one commit that writes the
    delivered rows alone (see `keyed`).

    A delivered row replaces the stored one of its key, whatever their contents; `order` (ascending
    = older) decides among rows of one delivery. With newest_by, a stored row whose values there are
    greater stays instead. A null partition value is a partition like any other. Columns that only
    one side has are null on the other. An empty delivery changes nothing.
    """
    KeyedTable(spark, path, keys, partition_by, newest_by).upsert(new, order)


def expire(df: DataFrame, as_of, ttl_s: int = DAY_S, written_at: str = "written_at") -> DataFrame:
    """Rows still alive at `as_of` (written less than ttl_s seconds before it)."""
    a = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    return df.filter(F.col(written_at).cast("timestamp") > a - F.make_dt_interval(secs=F.lit(ttl_s)))


def compact_expired(spark: SparkSession, path: str, as_of, ttl_s: int = DAY_S,
                    written_at: str = "written_at") -> None:
    """T9 compaction: drop the expired rows of a keyed table, whole partitions where none lives on, and
    what no kept version of the table needs."""
    t = KeyedTable(spark, path)
    t.expire(as_of, ttl_s, written_at)
    t.vacuum()


# --- catalog DDL (S19-S21) --------------------------------------------------------------------

def ensure_table(spark: SparkSession, db: str, table: str, ddl_columns: str, path: str,
                 partitioned_by: str | None = None, db_location: str | None = None) -> None:
    """Idempotent namespace + table creation. Over a partitioned keyed table the catalog table follows
    its commits; over a plain Parquet folder the partitions already there are registered. Pass
    db_location (a shared folder) unless the cluster's warehouse dir is configured."""
    loc = f" LOCATION '{db_location}'" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    part = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{table} ({ddl_columns}) USING parquet{part} "
              f"LOCATION '{path}'")
    keyed = KeyedTable(spark, path)
    if keyed.exists():
        keyed.register(f"{db}.{table}")
    elif partitioned_by:
        spark.sql(f"ALTER TABLE {db}.{table} RECOVER PARTITIONS")


def drop_table(spark: SparkSession, db: str, table: str) -> None:
    """Drop (idempotent; the original fails on a second call)."""
    spark.sql(f"DROP TABLE IF EXISTS {db}.{table}")


# --- brokers (S9-S11) -------------------------------------------------------------------------
# Thin adapters: they need the spark-sql-kafka package on the classpath, which this image lacks.
# Everything downstream works on the `value` column and is tested with file streams.

def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Topic -> streaming DataFrame of (key, value) text with the broker's partition, offset
    and timestamp, the columns that the live jobs take; offsets live in the query's
    checkpoint, so a restart resumes where it stopped."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp"))


def write_kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """(key, value) rows -> topic."""
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S12 as in the original setup: a socket text stream, one line per row in `value`.
    Demo only: a socket source keeps no offsets and cannot replay after a failure, so production
    streams read a broker topic or a landing folder (`spark.readStream.text(path)`)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
