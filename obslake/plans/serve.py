"""V1-V5: serving products read from the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.columns import clean_location, current_season, interval_label, r2
from obslake.operators import windows
from obslake.plans.jobs import read_products
from obslake.schemas import DAY_S, INTERVALS
from obslake.sources.tables import expire, to_json_lines, upsert_latest
from obslake.streaming.live import LiveLocationData, LiveTrends


def _ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp")


def live_results_as_of(obs: DataFrame, as_of, intervals=INTERVALS, ttl_s: int = DAY_S) -> DataFrame:
    """Interval-trend rows a live deployment holds at `as_of`: windows ending at or before it and
    not yet expired. Only windows ending in (as_of - ttl, as_of] can survive, and they see
    observations in [as_of - ttl - longest window, as_of), so the scan is restricted to that
    range (pushed to Parquet) and the result is exactly the one computed over the whole table."""
    a = _ts(as_of)
    lo = a - F.make_dt_interval(secs=F.lit(ttl_s + max(intervals)))
    recent = obs.filter((F.col("ts") >= lo) & (F.col("ts") < a))
    res = windows.interval_trends(windows.window_ends(recent, intervals))
    res = res.filter(F.col("window_end").cast("timestamp") <= a)
    return expire(res, a, ttl_s, written_at="window_end")


def latest_trends_view(results: DataFrame) -> DataFrame:
    """V1: latest row per (location, interval) as the trends page shows it: interval label (F18),
    location without ( ) . ' (F19), values rounded to 2 (F10), ordered by location and the
    interval in seconds (L3, numeric instead of text order)."""
    latest = upsert_latest(results, ["location", "interval_s"], ["window_end"])
    return (latest.select(
        clean_location("location").alias("location"),
        interval_label("interval_s").alias("interval"),
        "interval_s", "window_end",
        F.col("actual_temperature"),
        r2("temperature_trend").alias("temperature_trend"),
        r2("actual_wind").alias("actual_wind"),
        r2("wind_trend").alias("wind_trend"),
        F.col("actual_humidity"),
        r2("humidity_delta").alias("humidity_delta"),
        "weather")
        .orderBy("location", "interval_s"))


def stored_trends_view(trends_view: DataFrame, as_of, ttl_s: int = DAY_S) -> DataFrame:
    """V1 from the stored table (S16): one row per (location, interval), as the live job upserted it,
    without those that expired by `as_of`."""
    return latest_trends_view(expire(trends_view, _ts(as_of), ttl_s, written_at="window_end"))


def trends_view_json(view: DataFrame) -> DataFrame:
    """V2: the view as JSON objects."""
    return to_json_lines(view)


def observations_json(location_data: DataFrame) -> DataFrame:
    """Raw observations as JSON, columns taken by name (Q10: never by position)."""
    return to_json_lines(location_data.select(
        "location", F.col("timestamp").alias("time"), "temperature", "wind", "humidity", "weather"))


def for_season(long: DataFrame, as_of=None) -> DataFrame:
    """V4/V5 + F20/F21: rows of the season the clock (or a fixed date) is in."""
    return long.filter(F.col("season") == current_season(None if as_of is None else F.lit(as_of)))


def season_product(spark: SparkSession, path: str, trends: bool, as_of=None) -> DataFrame:
    """V4/V5 from the stored products: the folder of the season the clock (or a fixed date) is in."""
    season = spark.range(1).select(current_season(None if as_of is None else F.lit(as_of))).first()[0]
    return read_products(spark, path, trends, season)


def serve_job(spark: SparkSession, root: str, as_of, out: str, records: str | None = None,
              trends: str | None = None) -> None:
    """V1-V5 as JSON-line folders below `out`, each from what a job stored: the trends view and the
    observations still alive at `as_of` below a live root, the products of its season."""
    view = LiveTrends(root).trends_view(spark)
    trends_view_json(stored_trends_view(view, as_of)).write.mode("overwrite").text(f"{out}/trends_view")
    stored = LiveLocationData(root).stored(spark)
    observations_json(expire(stored, as_of)).write.mode("overwrite").text(f"{out}/observations")
    for name, path in (("records", records), ("trends", trends)):
        if path:
            to_json_lines(season_product(spark, path, name == "trends", as_of)).write.mode("overwrite").text(f"{out}/{name}")
