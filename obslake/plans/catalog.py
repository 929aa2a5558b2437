"""The named queries: one entry per operator of the inventory, each (spark, sf_dir) -> DataFrame,
and its DuckDB oracle SQL. `__spark_entry__.py` exposes both."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import fixtures
from obslake.functions.columns import (epoch_seconds, epoch_to_date, midnight_epoch, season_year, strip_outer, to_celsius,
                                       to_epoch_long)
from obslake.operators import history, rollup, windows
from obslake.plans import jobs, serve
from obslake.plans import oracle as O
from obslake.schemas import BROKER, INTERVALS, MESSAGE, OBSERVATION, TREND_MEASURES
from obslake.session import work_path
from obslake.sources import codecs, tables
from obslake.sources.keyed import KeyedTable
from obslake.streaming import live

Query = Callable[[SparkSession, str], DataFrame]


# --- history (H) --------------------------------------------------------------------------

def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.history_daily(fixtures.history_records(spark, sf))


def _season(spark: SparkSession, sf: str, split_summer: bool = False) -> DataFrame:
    return rollup.season_rollup(_daily(spark, sf), split_summer)


def q_daily_rollup(spark, sf):
    return _daily(spark, sf)


def q_season_rollup(spark, sf):
    return _season(spark, sf)


def q_season_rollup_split(spark, sf):
    return _season(spark, sf, split_summer=True)


def q_measures_long(spark, sf):
    return rollup.to_long(_season(spark, sf), TREND_MEASURES)


def q_records_extreme(spark, sf):
    return history.records(_season(spark, sf), order="extreme")


def q_records_reference_order(spark, sf):
    return history.records(_season(spark, sf), order="reference")


def q_latest_years(spark, sf):
    return history.latest_years(_season(spark, sf))


def q_yearly_trend(spark, sf):
    return history.trends(_season(spark, sf))


# --- speed layer (E) ------------------------------------------------------------------------

def _obs(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.observations(spark, sf)


def _window_ends_query(w: int) -> Query:
    def q(spark, sf):
        return windows.flat_ends(windows.window_ends(_obs(spark, sf), (w,)))
    q.__name__ = f"q_window_ends_{w}"
    q.__doc__ = f"T3/T4, G4, G5: first and last record per location over {w} s windows sliding by 60 s."
    return q


def q_interval_trends(spark, sf):
    return windows.interval_trends(windows.window_ends(_obs(spark, sf)))


def q_interval_trends_join(spark, sf):
    return windows.interval_trends(windows.window_ends_join(_obs(spark, sf)))


def q_interval_trends_panes(spark, sf):
    return windows.interval_trends(windows.window_ends_panes(_obs(spark, sf)))


QUERIES: dict[str, Query] = {
    "daily_rollup": q_daily_rollup,
    "season_rollup": q_season_rollup,
    "season_rollup_split": q_season_rollup_split,
    "measures_long": q_measures_long,
    "records_extreme": q_records_extreme,
    "records_reference_order": q_records_reference_order,
    "latest_years": q_latest_years,
    "yearly_trend": q_yearly_trend,
    **{f"window_ends_{w}": _window_ends_query(w) for w in INTERVALS},
    "interval_trends": q_interval_trends,
    "interval_trends_join": q_interval_trends_join,
    "interval_trends_panes": q_interval_trends_panes,
}

ORACLE: dict[str, str] = {
    "daily_rollup": O.q_daily_rollup(),
    "season_rollup": O.q_season_rollup(),
    "season_rollup_split": O.q_season_rollup(split_summer=True),
    "measures_long": O.q_measures_long(),
    "records_extreme": O.q_records("extreme"),
    "records_reference_order": O.q_records("reference"),
    "latest_years": O.q_latest_years(),
    "yearly_trend": O.q_yearly_trend(),
    **{f"window_ends_{w}": O.q_window_ends(w) for w in INTERVALS},
    "interval_trends": O.q_interval_trends(),
    "interval_trends_join": O.q_interval_trends(),
    "interval_trends_panes": O.q_interval_trends(),
}


# --- codecs, sources, keyed tables, serving -----------------------------------------------------


AS_OF = "2024-01-31 00:00:00"              # fixed clock for TTL and current-season products
UPSERT_OLD_BEFORE = "2024-01-21 00:00:00"  # first load: observations before this time
UPSERT_NEW_FROM = "2024-01-11 00:00:00"    # re-delivered batch: observations from this time on


def _decoded_nested(spark, sf):
    m = fixtures.nested_messages(spark, sf)
    return m.select("seq", codecs.decode("value").alias("r"))


def q_nested_flatten(spark, sf):
    """Nested JSON messages -> flat raw-observation rows."""
    return codecs.flatten_record(_decoded_nested(spark, sf), "r", keep=("seq",))


def q_first_weather(spark, sf):
    """Main text of the first weather item; null for an empty list."""
    r = _decoded_nested(spark, sf)
    return r.select("seq", codecs.first_weather("r.weather").alias("weather_main"))


def q_double_json_decode(spark, sf):
    """The same messages single- and double-encoded decode to the same rows."""
    m = fixtures.messages(spark, sf)
    twice = F.to_json(F.array(F.col("value")))
    twice = F.substring(twice, F.lit(2), F.length(twice) - F.lit(2))
    both = (m.select("seq", F.lit("single").alias("encoding"), "value")
            .unionByName(m.select("seq", F.lit("double").alias("encoding"), twice.alias("value"))))
    return both.select("seq", "encoding", codecs.decode("value", MESSAGE).alias("m")).select(
        "seq", "encoding", "m.*")


def _planted(spark, sf):
    """Messages whose 'error' observations are cut to half their text (malformed JSON)."""
    e = fixtures.observations(spark, sf)
    value = F.to_json(F.struct("location", epoch_seconds("ts").alias("datetime"),
                               F.col("temperature").alias("temp"), "wind", "humidity", "weather"))
    half = F.substring(value, F.lit(1), (F.length(value) / 2).cast("int"))
    return e.select("seq", F.when(F.col("weather") == "error", half).otherwise(value).alias("value"))


def q_corrupt_split(spark, sf):
    """Good rows decoded, malformed ones routed to rejects; both in one result with status."""
    good, rejects = codecs.split_rejects(_planted(spark, sf))
    good = good.withColumn("status", F.lit("ok"))
    rej = rejects.select("seq", F.lit("rejected").alias("status"))
    return good.unionByName(rej, allowMissingColumns=True)


def _lines(spark, sf):
    e = fixtures.observations(spark, sf)
    return e.select("seq", codecs.format_line("location", epoch_seconds("ts"), "temperature", "wind",
                                              "humidity", "weather").alias("value"))


def q_line_format(spark, sf):
    """Observation -> tuple text line."""
    return _lines(spark, sf)


def q_line_parse(spark, sf):
    """Tuple text line -> typed columns (round trip of line_format)."""
    return _lines(spark, sf).select("seq", codecs.parse_line("value").alias("p")).select("seq", "p.*")


def q_kafka_payload(spark, sf):
    """Observation rows -> (key, value) JSON payload."""
    e = fixtures.observations(spark, sf)
    msg = e.select("location", epoch_seconds("ts").alias("datetime"), F.col("temperature").alias("temp"),
                   "wind", "humidity", "weather")
    return codecs.to_payload(msg, key="location")


def q_midnight_epoch(spark, sf):
    """epoch seconds -> midnight UTC."""
    e = fixtures.observations(spark, sf)
    ep = epoch_seconds("ts")
    return e.select("seq", ep.alias("epoch"), midnight_epoch(ep).alias("midnight"))


def q_daily_rollup_flat(spark, sf):
    """V9 core, G2: raw observation rows (decoded messages) -> daily table."""
    flat = codecs.flatten_record(_decoded_nested(spark, sf), "r")
    return rollup.observations_daily(flat)


def q_season_classify(spark, sf):
    """Calendar columns and season of each daily row."""
    cal = rollup.with_calendar(_daily(spark, sf))
    return cal.select("unix_date", "year", "month", "season",
                      season_year("date").alias("season_year"))


def q_union_widening(spark, sf):
    """Union by position of a double and a long measure widens to double."""
    h = fixtures.history_records(spark, sf)
    d = h.select(F.col("dt").alias("k"), F.col("main.temp_max").alias("v"))
    d = d.groupBy("k").agg(F.max("v").alias("value")).select("k", F.lit("Max Temperature").alias("measure"), "value")
    hum = h.groupBy(F.col("dt").alias("k")).agg(F.max("main.humidity").alias("value"))
    hum = hum.select("k", F.lit("Max Humidity").alias("measure"), "value")
    return d.union(hum).withColumnRenamed("k", "dt")


def q_csv_round_trip(spark, sf):
    """S7 + S8: yearly trends written as one CSV file with header and read back by name."""
    path = work_path(spark, "csv")
    res = history.trends(_season(spark, sf)).drop("has_prev")
    tables.write_csv_single(res, path)
    return tables.read_result_csv(spark, path, trends=True)


def q_table_ddl_cycle(spark, sf):
    """create+load the daily table, register it, read it back, drop it."""
    path = work_path(spark, "daily")
    daily = rollup.with_calendar(_daily(spark, sf)).drop("date", "month", "season")
    tables.create_table(daily, path, key="unix_date", partition_by="year")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in daily.schema.fields)
    db_dir = work_path(spark, "warehouse")
    for _ in range(2):  # idempotent DDL: the second call is a no-op
        tables.ensure_table(spark, "climate", "daily_climate", cols, path, partitioned_by="year",
                            db_location=db_dir)
    out = work_path(spark, "registered")
    spark.table("climate.daily_climate").write.parquet(out)  # what the registered table reads
    for _ in range(2):  # dropping twice does not fail
        tables.drop_table(spark, "climate", "daily_climate")
    spark.read.parquet(out).createOrReplaceTempView("daily_view")
    return spark.table("daily_view")


def _location_data(spark, sf):
    e = fixtures.observations(spark, sf)
    return e.select("location", epoch_seconds("ts").alias("timestamp"), "temperature", "wind",
                    "humidity", "weather", "seq", F.col("ts").alias("written_at"),
                    F.to_date("ts").alias("day"))


def _upsert(spark, sf, replay: int):
    ld = _location_data(spark, sf)
    old = ld.filter(F.col("written_at") < F.lit(UPSERT_OLD_BEFORE).cast("timestamp")) \
        .withColumn("batch", F.lit(1))
    new = ld.filter(F.col("written_at") >= F.lit(UPSERT_NEW_FROM).cast("timestamp")) \
        .withColumn("temperature", F.col("temperature") + F.lit(1.0)).withColumn("batch", F.lit(2))
    path = work_path(spark, "location_data")
    keys, order = ["location", "timestamp"], ["batch", "seq"]
    tables.merge_upsert(spark, path, old, keys, order, "day")
    for _ in range(replay):
        tables.merge_upsert(spark, path, new, keys, order, "day")
    return tables.read_table(spark, path).select("location", "timestamp", "temperature", "wind", "humidity",
                                                 "weather", "seq", "batch")


def q_upsert_latest(spark, sf):
    """Upsert a re-delivered batch into the keyed table (latest version wins)."""
    return _upsert(spark, sf, replay=1)


def q_upsert_idempotent(spark, sf):
    """Replaying the same batch leaves the table unchanged."""
    return _upsert(spark, sf, replay=2)


def q_ttl_filter(spark, sf):
    """Rows still alive one day after being written, at a fixed clock."""
    ld = _location_data(spark, sf)
    return tables.expire(ld, AS_OF).select("location", "timestamp", "temperature", "wind", "humidity",
                                           "weather", "seq")


def q_latest_trends_view(spark, sf):
    """V1 (F10, F18, F19, L3, T9): latest live trends per location and interval at a fixed clock."""
    res = serve.live_results_as_of(fixtures.observations(spark, sf), AS_OF)
    return serve.latest_trends_view(res)


def q_trends_view_json(spark, sf):
    """V2: the trends view as JSON."""
    return serve.trends_view_json(q_latest_trends_view(spark, sf).drop("window_end"))


def q_observations_json(spark, sf):
    """Raw observations as JSON, by column name."""
    return serve.observations_json(_location_data(spark, sf))


def q_history_records_for_season(spark, sf):
    """Records of the season a fixed date falls in."""
    return serve.for_season(history.records(_season(spark, sf)), AS_OF)


def q_history_trends_for_season(spark, sf):
    """V5: trends of the season a fixed date falls in."""
    return serve.for_season(history.trends(_season(spark, sf)), AS_OF)


QUERIES.update({
    "nested_flatten": q_nested_flatten,
    "first_weather": q_first_weather,
    "double_json_decode": q_double_json_decode,
    "corrupt_split": q_corrupt_split,
    "line_format": q_line_format,
    "line_parse": q_line_parse,
    "kafka_payload": q_kafka_payload,
    "midnight_epoch": q_midnight_epoch,
    "daily_rollup_flat": q_daily_rollup_flat,
    "season_classify": q_season_classify,
    "union_widening": q_union_widening,
    "csv_round_trip": q_csv_round_trip,
    "table_ddl_cycle": q_table_ddl_cycle,
    "upsert_latest": q_upsert_latest,
    "upsert_idempotent": q_upsert_idempotent,
    "ttl_filter": q_ttl_filter,
    "latest_trends_view": q_latest_trends_view,
    "trends_view_json": q_trends_view_json,
    "observations_json": q_observations_json,
    "history_records_for_season": q_history_records_for_season,
    "history_trends_for_season": q_history_trends_for_season,
})

ORACLE.update({
    "nested_flatten": O.q_nested_flatten(),
    "first_weather": O.q_first_weather(),
    "double_json_decode": O.q_double_json_decode(),
    "corrupt_split": O.q_corrupt_split(),
    "line_format": O.q_line_format(),
    "line_parse": O.q_line_parse(),
    "kafka_payload": O.q_kafka_payload(),
    "midnight_epoch": O.q_midnight_epoch(),
    "daily_rollup_flat": O.q_daily_rollup_flat(),
    "season_classify": O.q_season_classify(),
    "union_widening": O.q_union_widening(),
    "csv_round_trip": O.q_yearly_trend(with_has_prev=False),
    "table_ddl_cycle": O.q_table_ddl_cycle(),
    "upsert_latest": O.q_upsert(UPSERT_OLD_BEFORE, UPSERT_NEW_FROM),
    "upsert_idempotent": O.q_upsert(UPSERT_OLD_BEFORE, UPSERT_NEW_FROM),
    "ttl_filter": O.q_ttl_filter(AS_OF),
    "latest_trends_view": O.q_latest_trends_view(AS_OF),
    "trends_view_json": O.q_trends_view_json(AS_OF),
    "observations_json": O.q_observations_json(),
    "history_records_for_season": O.q_records("extreme", season="summer"),
    "history_trends_for_season": O.q_yearly_trend(season="summer"),
})


# --- streaming (file streams stand in for the broker) -------------------------------------------


AFTER_ALL = "2024-01-31 12:00:00"   # a clock by which every window of E has ended
STREAM_DELAY = "10 minutes"   # watermark delay; input arrives in time order, so nothing is late


def _stage_by_time(df: DataFrame, path: str, files: int = 30, columns: tuple = ("*",)) -> None:
    """Write a stream's input, in one job, as files that arrive in time order, the way a landing folder
    fills up: rows ranged over the files by ts, the files' times set in that order. More files can be
    added by a second call. `columns` are made of the rows in their files, after the ranges were sampled."""
    known = {f.getName() for f in _data_files(df.sparkSession, path)}
    df.repartitionByRange(files, "ts").sortWithinPartitions("ts").select(*columns).write.mode("append").parquet(path)
    now = int(time.time() * 1000)
    fresh = [f for f in _data_files(df.sparkSession, path) if f.getName() not in known]
    for i, f in enumerate(sorted(fresh, key=lambda f: f.getName())):
        f.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).setTimes(f, now + i, -1)


def _data_files(spark: SparkSession, path: str) -> list:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")] \
        if fs.exists(p) else []


def _closed(df: DataFrame, obs: DataFrame) -> DataFrame:
    hi = obs.agg(F.max("ts").alias("hi")).first()["hi"]
    limit = F.lit(hi).cast("timestamp") - F.expr(f"INTERVAL {STREAM_DELAY}")
    return df.filter(F.col("window_end").cast("timestamp") <= limit)


def q_stream_interval_trends(spark, sf):
    """Live multi-interval trends from a file stream (watermark, closed panes,
    foreachBatch recompute + upsert); windows closed by the final watermark."""
    root = work_path(spark, "live_trends")
    obs = fixtures.observations(spark, sf)
    src = f"{root}/input"
    _stage_by_time(obs, src)
    lt = live.LiveTrends(root, watermark=STREAM_DELAY)
    q = lt.start(live.observation_stream(spark, src, OBSERVATION, max_files=8), trigger=None)
    q.awaitTermination()
    lt.finish(spark, q)
    return _closed(lt.results(spark), obs)


def q_stream_daily_rollup(spark, sf):
    """Message stream -> raw table upsert -> daily table for touched days."""
    root = work_path(spark, "live_ingest")
    msgs = fixtures.nested_messages(spark, sf)
    src = f"{root}/input"
    _stage_by_time(msgs, src)
    ing = live.LiveIngest(root)
    stream = spark.readStream.schema("seq long, ts timestamp, value string").option(
        "maxFilesPerTrigger", 8).parquet(src)
    q = ing.start(stream.select("seq", "value"), trigger=None)
    q.awaitTermination()
    return ing.daily(spark)


QUERIES.update({
    "stream_interval_trends": q_stream_interval_trends,
    "stream_daily_rollup": q_stream_daily_rollup,
})
ORACLE.update({
    "stream_interval_trends": O.q_stream_interval_trends(STREAM_DELAY),
    "stream_daily_rollup": O.q_stream_daily_rollup(),
})


REDELIVERED_YEAR = 1996  # of H, whose days the daily job delivers a second time


# --- end-to-end batch jobs (V6-V9) -------------------------------------------------------------


def q_history_json_scan(spark, sf):
    """History written as nested JSON lines, scanned with the declared schema, rolled up
    and loaded into a new daily table (S4), read back."""
    root = work_path(spark, "history")
    fixtures.history_records(spark, sf).write.mode("errorifexists").json(f"{root}/json")
    jobs.history_bootstrap(spark, f"{root}/json", f"{root}/daily")
    return tables.read_table(spark, f"{root}/daily").drop("year")


def _bootstrapped_daily(spark, sf) -> str:
    path = work_path(spark, "daily")
    tables.create_table(rollup.with_calendar(_daily(spark, sf)).drop("date", "month", "season"), path)
    return path


def q_records_job(spark, sf):
    """V6: daily table -> records CSV per season folder -> read back."""
    out = work_path(spark, "records")
    jobs.records_job(spark, _bootstrapped_daily(spark, sf), out)
    return jobs.read_products(spark, out, trends=False)


def q_trends_job(spark, sf):
    """V7: daily table -> latest-years trends CSV per season folder -> read back."""
    out = work_path(spark, "trends")
    jobs.trends_job(spark, _bootstrapped_daily(spark, sf), out)
    return jobs.read_products(spark, out, trends=True)


def _raw_table(spark, sf, path: str) -> None:
    raw = codecs.raw_observations(fixtures.nested_messages(spark, sf)).withColumn(
        "day", epoch_to_date("unix_date"))
    tables.merge_upsert(spark, path, raw, ["location", "unix_date"], ["seq"], "day")


def q_daily_incremental(spark, sf):
    """Decoded messages upserted into the raw table by (location, unix_date), then
    the daily job rolls the raw table up and upserts the daily table."""
    root = work_path(spark, "incremental")
    _raw_table(spark, sf, f"{root}/raw")
    jobs.daily_incremental(spark, f"{root}/raw", f"{root}/daily")
    jobs.daily_incremental(spark, f"{root}/raw", f"{root}/daily")  # re-run: unchanged
    return tables.read_table(spark, f"{root}/daily").drop("year")


def q_bootstrap_then_daily(spark, sf):
    """V8, then V9 into the same table: the history job creates the daily table from H, the daily
    job delivers the days of E and, once more and changed, the days of H in one year."""
    root = work_path(spark, "bootstrap_daily")
    h = fixtures.history_records(spark, sf)
    h.write.json(f"{root}/json")
    jobs.history_bootstrap(spark, f"{root}/json", f"{root}/daily")
    _raw_table(spark, sf, f"{root}/raw")
    again = (rollup.flatten_observation(h.filter(F.year(F.timestamp_seconds("dt")) == REDELIVERED_YEAR))
             .withColumn("temp_max", F.col("temp_max") + F.lit(1000.0))
             .withColumn("day", epoch_to_date("unix_date")))
    again.write.partitionBy("day").parquet(f"{root}/raw_again")
    jobs.daily_incremental(spark, f"{root}/raw", f"{root}/daily")
    jobs.daily_incremental(spark, f"{root}/raw_again", f"{root}/daily")
    return tables.read_table(spark, f"{root}/daily").drop("year")


QUERIES.update({
    "history_json_scan": q_history_json_scan,
    "records_job": q_records_job,
    "trends_job": q_trends_job,
    "daily_incremental": q_daily_incremental,
    "bootstrap_then_daily": q_bootstrap_then_daily,
})
ORACLE.update({
    "history_json_scan": O.q_daily_rollup(),
    "records_job": O.q_records("extreme"),
    "trends_job": O.q_yearly_trend(with_has_prev=False),
    "daily_incremental": O.q_stream_daily_rollup(),
    "bootstrap_then_daily": O.q_bootstrap_then_daily(REDELIVERED_YEAR),
})


def _broker_stream(spark, rows: DataFrame, src: str, value="value") -> DataFrame:
    """A stream with the columns of the broker source (S9, S10) from (ts, seq, location) rows and their
    value: files stand in for the topic, seq for the offset."""
    value = F.col(value) if isinstance(value, str) else value
    _stage_by_time(rows, src, columns=("ts", F.col("location").alias("key"), value.alias("value"), F.lit(0).alias("partition"),
                                       F.col("seq").alias("offset"), F.col("ts").alias("timestamp")))
    return spark.readStream.schema(BROKER).option("maxFilesPerTrigger", 8).parquet(src)


def _line() -> Column:
    return codecs.format_line("location", epoch_seconds("ts"), "temperature", "wind", "humidity", "weather")


def _line_rows(spark, sf) -> DataFrame:
    return fixtures.observations(spark, sf).select("ts", "seq", "location", _line().alias("value"))


def _line_stream(spark, sf, src: str) -> DataFrame:
    return _broker_stream(spark, fixtures.observations(spark, sf), src, _line())


def q_stream_location_data(spark, sf):
    """V11 raw path, S12, P16, T7, S13: tuple-line stream parsed and upserted into location_data
    keyed by (location, timestamp); the later arrival wins."""
    root = work_path(spark, "live_lines")
    job = live.LiveLocationData(root)
    job.start(_line_stream(spark, sf, f"{root}/in"), trigger=None).awaitTermination()
    return job.table(spark)


def q_stored_observations_json(spark, sf):
    """What the raw path stored, as JSON, by column name."""
    return serve.observations_json(q_stream_location_data(spark, sf))


def q_stream_line_trends(spark, sf):
    """V11 trend path: tuple-line stream -> typed observations -> live interval trends."""
    root = work_path(spark, "line_trends")
    lt = live.LiveTrends(root, watermark=STREAM_DELAY)
    stream = _line_stream(spark, sf, f"{root}/in")
    q = lt.start(live.parse_observations(stream), trigger=None)
    q.awaitTermination()
    lt.finish(spark, q)
    return _closed(lt.results(spark), fixtures.observations(spark, sf))


def q_stream_message_trends(spark, sf):
    """MESSAGE JSON with the broker's columns -> live interval trends."""
    root = work_path(spark, "message_trends")
    e = fixtures.observations(spark, sf).select("ts", "seq", "location")
    rows = fixtures.messages(spark, sf).join(e, "seq")
    lt = live.LiveTrends(root, watermark=STREAM_DELAY)
    q = lt.start(live.parse_messages(_broker_stream(spark, rows, f"{root}/in")), trigger=None)
    q.awaitTermination()
    lt.finish(spark, q)
    return _closed(lt.results(spark), fixtures.observations(spark, sf))


def q_stream_rejects(spark, sf):
    """P18, S23 live: lines and messages that cannot be read, kept with their text."""
    root = work_path(spark, "live_rejects")
    e = fixtures.observations(spark, sf).select("ts", "seq", "location", "weather")
    bad = F.col("weather") == "error"

    def stream(rows, junk, name):
        mixed = rows.join(e.select("seq", "weather"), "seq").withColumn(
            "value", F.when(bad, F.concat(F.lit(junk), F.col("seq").cast("string"))).otherwise(F.col("value")))
        return _broker_stream(spark, mixed, f"{root}/{name}")

    lines = live.LiveLocationData(root)
    lines.start(stream(_line_rows(spark, sf), "junk ", "lines"), trigger=None).awaitTermination()
    ingest = live.LiveIngest(root)
    messages = fixtures.nested_messages(spark, sf).select("seq", "value").join(e.drop("weather"), "seq")
    ingest.start(stream(messages, '{"dt": ', "messages"), trigger=None).awaitTermination()
    return lines.rejects(spark).select(F.lit("lines").alias("source"), "value").unionByName(
        ingest.rejects(spark).select(F.lit("messages").alias("source"), "value"))


def _stored_view(spark, sf) -> DataFrame:
    root = work_path(spark, "stored_view")
    _stage_by_time(fixtures.observations(spark, sf), f"{root}/in")
    lt = live.LiveTrends(root, watermark=STREAM_DELAY, mode="update")
    lt.start(live.observation_stream(spark, f"{root}/in", OBSERVATION, max_files=8), trigger=None).awaitTermination()
    return serve.stored_trends_view(lt.trends_view(spark), AFTER_ALL)


def q_stream_trends_view(spark, sf):
    """The trends page from the table that the live job upserts by (location, interval)."""
    return _stored_view(spark, sf)


def q_stream_trends_view_json(spark, sf):
    """V2: the stored trends view as JSON."""
    return serve.trends_view_json(_stored_view(spark, sf).drop("window_end"))


def q_season_products(spark, sf):
    """Records and trends of the season a fixed date falls in, from the stored products;
    the season picks the folder that is read."""
    daily, root = _bootstrapped_daily(spark, sf), work_path(spark, "products")
    jobs.records_job(spark, daily, f"{root}/records")
    jobs.trends_job(spark, daily, f"{root}/trends")
    rec = serve.season_product(spark, f"{root}/records", trends=False, as_of=AS_OF)
    tr = serve.season_product(spark, f"{root}/trends", trends=True, as_of=AS_OF)
    return rec.select(F.lit("records").alias("product"), "*", F.lit(None).cast("double").alias("trend")) \
        .unionByName(tr.select(F.lit("trends").alias("product"), "*"))


QUERIES.update({
    "stream_location_data": q_stream_location_data,
    "stream_line_trends": q_stream_line_trends,
    "stored_observations_json": q_stored_observations_json,
    "stream_message_trends": q_stream_message_trends,
    "stream_rejects": q_stream_rejects,
    "stream_trends_view": q_stream_trends_view,
    "stream_trends_view_json": q_stream_trends_view_json,
    "season_products": q_season_products,
})
ORACLE.update({
    "stream_location_data": O.q_stream_location_data(),
    "stream_line_trends": O.q_stream_line_trends(STREAM_DELAY),
    "stored_observations_json": O.q_stored_observations_json(),
    "stream_message_trends": O.q_stream_line_trends(STREAM_DELAY),
    "stream_rejects": O.q_stream_rejects(),
    "stream_trends_view": O.q_latest_trends_view(AFTER_ALL),
    "stream_trends_view_json": O.q_trends_view_json(AFTER_ALL),
    "season_products": O.q_season_products("summer"),
})


def q_stream_live_trends(spark, sf):
    """T3-T6 live form, direct: Spark's sliding windows in update mode with an upsert sink;
    equals the batch result in every window, open ones included."""
    root = work_path(spark, "live_update")
    obs = fixtures.observations(spark, sf)
    src = f"{root}/input"
    _stage_by_time(obs, src)
    job = live.LiveTrendsUpdate(root, watermark=STREAM_DELAY)
    job.start(live.observation_stream(spark, src, OBSERVATION, max_files=8), trigger=None).awaitTermination()
    return job.results(spark)


def q_stream_live_trends_panes(spark, sf):
    """T3-T6 live form from panes: pane aggregation in update mode, every trigger recomputes the
    windows of the panes it changed; equals the batch result in every window."""
    root = work_path(spark, "live_update_panes")
    obs = fixtures.observations(spark, sf)
    src = f"{root}/input"
    _stage_by_time(obs, src)
    lt = live.LiveTrends(root, watermark=STREAM_DELAY, mode="update")
    lt.start(live.observation_stream(spark, src, OBSERVATION, max_files=8), trigger=None).awaitTermination()
    return lt.results(spark)


QUERIES["stream_live_trends"] = q_stream_live_trends
QUERIES["stream_live_trends_panes"] = q_stream_live_trends_panes
ORACLE["stream_live_trends"] = O.q_interval_trends()
ORACLE["stream_live_trends_panes"] = O.q_interval_trends()


def q_ttl_compaction(spark, sf):
    """T9 compaction: location_data partitioned by day, expired rows dropped physically."""
    path = work_path(spark, "location_data_ttl")
    KeyedTable(spark, path, ["location", "timestamp", "seq"], "day").create(_location_data(spark, sf))
    tables.compact_expired(spark, path, AS_OF)
    return tables.read_table(spark, path).select("location", "timestamp", "temperature", "wind", "humidity",
                                                 "weather", "seq")


QUERIES["ttl_compaction"] = q_ttl_compaction
ORACLE["ttl_compaction"] = O.q_ttl_filter(AS_OF)


def q_season_year(spark, sf):
    """Q16: the season a day belongs to and the year that season is counted in when summers are
    split at the year change (October-December -> next year)."""
    cal = rollup.with_calendar(_daily(spark, sf), split_summer=True)
    return cal.select("unix_date", "season", F.col("year").alias("season_year"))


def q_interval_trends_direct(spark, sf):
    """T3/T4 with Spark's own window(ts, W, '60 seconds') per interval, then T5."""
    obs = _obs(spark, sf)
    ends = None
    for w in INTERVALS:
        one = windows.window_ends_direct(obs, w)
        ends = one if ends is None else ends.unionByName(one)
    return windows.interval_trends(ends)


QUERIES["season_year"] = q_season_year
QUERIES["interval_trends_direct"] = q_interval_trends_direct
ORACLE["season_year"] = O.q_season_year()
ORACLE["interval_trends_direct"] = O.q_interval_trends()


# --- one source for all sinks; tables that the catalog follows ---------------------------------


def _station(spark, sf) -> live.LiveStation:
    root = work_path(spark, "station")
    job = live.LiveStation(root)
    job.start(_line_stream(spark, sf, f"{root}/in"), trigger=None).awaitTermination()
    return job


def q_station_trends(spark, sf):
    """Trends of the job that feeds all sinks from one read; each window is written once."""
    return _closed(_station(spark, sf).trends.results(spark), fixtures.observations(spark, sf))


def q_station_location_data(spark, sf):
    """location_data of the same job."""
    return _station(spark, sf).raw.table(spark)


def q_registered_after_upsert(spark, sf):
    """A catalog table over the daily table shows what the daily job has upserted since
    it was registered, and no expired year."""
    root = work_path(spark, "registered_daily")
    h = fixtures.history_records(spark, sf)
    h.write.json(f"{root}/json")
    jobs.history_bootstrap(spark, f"{root}/json", f"{root}/daily")
    daily = tables.read_table(spark, f"{root}/daily")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in daily.schema.fields)
    name = f"daily_{os.path.basename(root).replace('-', '_')}"
    tables.ensure_table(spark, "climate_live", name, cols, f"{root}/daily", "year", work_path(spark, "warehouse"))
    _raw_table(spark, sf, f"{root}/raw")
    jobs.daily_incremental(spark, f"{root}/raw", f"{root}/daily")
    KeyedTable(spark, f"{root}/daily").drop({f"year={REDELIVERED_YEAR}"})
    out = f"{root}/seen"
    spark.table(f"climate_live.{name}").drop("year").write.parquet(out)
    tables.drop_table(spark, "climate_live", name)
    return spark.read.parquet(out)


QUERIES.update({
    "station_trends": q_station_trends,
    "station_location_data": q_station_location_data,
    "registered_after_upsert": q_registered_after_upsert,
})
ORACLE.update({
    "station_trends": O.q_stream_line_trends(STREAM_DELAY),
    "station_location_data": O.q_stream_location_data(),
    "registered_after_upsert": O.q_registered_after_upsert(REDELIVERED_YEAR),
})


# --- small column functions and the preview ----------------------------------------------------


def q_table_preview(spark, sf):
    """The first rows of the stored location_data, by its key."""
    return tables.preview(_upsert(spark, sf, replay=1), 10, ("location", "timestamp"))


def q_epoch_cast(spark, sf):
    """F16: epochs with fractions, as text, to whole seconds."""
    e = fixtures.observations(spark, sf)
    text = F.concat(epoch_seconds("ts").cast("string"), F.lit("."), (F.col("seq") % 1000).cast("string"))
    return e.select("seq", to_epoch_long(text).alias("epoch"))


def q_line_split(spark, sf):
    """tuple lines without their brackets and blanks, split on commas."""
    fields = F.split(F.regexp_replace(strip_outer("value"), " ", ""), ",")
    return _lines(spark, sf).select("seq", F.size(fields).alias("n_fields"), fields[0].alias("location"),
                                    fields[1].alias("epoch"), fields[7].alias("weather"))


def q_celsius(spark, sf):
    """Q13: temperatures in Kelvin, Fahrenheit, Celsius and an unknown unit."""
    unit = F.element_at(F.array(*map(F.lit, ("K", "f", "C", "X"))), (F.col("seq") % 4 + 1).cast("int"))
    return fixtures.observations(spark, sf).select("seq", to_celsius("temperature", unit).alias("celsius"))


QUERIES.update({
    "table_preview": q_table_preview,
    "epoch_cast": q_epoch_cast,
    "line_split": q_line_split,
    "celsius": q_celsius,
})
ORACLE.update({
    "table_preview": f"{O.q_upsert(UPSERT_OLD_BEFORE, UPSERT_NEW_FROM)} ORDER BY location, timestamp LIMIT 10",
    "epoch_cast": O.q_epoch_cast(),
    "line_split": O.q_line_split(),
    "celsius": O.q_celsius(),
})
