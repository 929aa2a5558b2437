"""Driver tables -> the weather data model (see FIXTURES.md).

H: nested history records from `lineitem`; E: typed observations from `events`;
M: E encoded as messages. All are lazy projections: nothing is materialised here, so Catalyst
prunes the scan to the few source columns each query needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.columns import epoch_seconds
from obslake.schemas import OBS_NESTED


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null(field: str) -> Column:
    return F.lit(None).cast(OBS_NESTED[field].dataType)


def history_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H: one OBS_NESTED record per lineitem row (several years of days)."""
    li = table(spark, sf_dir, "lineitem")
    tc = (F.round(F.col("l_extendedprice") * 100).cast("long") - F.lit(6000000))
    ln = F.col("l_linenumber").cast("long")
    main = F.struct(
        (tc / 100).alias("temp"),
        F.lit(None).cast("double").alias("feels_like"),
        ((tc - ln * 100) / 100).alias("temp_min"),
        ((tc + ln * 100) / 100).alias("temp_max"),
        (F.lit(900) + F.col("l_partkey") % 150).cast("long").alias("pressure"),
        (F.lit(40) + F.lit(5) * F.round(F.col("l_discount") * 100).cast("long")).alias("humidity"),
        F.lit(None).cast("long").alias("sea_level"),
        F.lit(None).cast("long").alias("grnd_level"),
    )
    ts = F.col("l_shipdate")
    return li.select(
        _null("coord").alias("coord"),
        _null("weather").alias("weather"),
        F.lit("stations").alias("base"),
        main.alias("main"),
        F.lit(None).cast("long").alias("visibility"),
        F.struct((F.col("l_quantity") * F.lit(0.5)).alias("speed"),
                 (F.col("l_orderkey") % 360).cast("long").alias("deg")).alias("wind"),
        F.struct((F.col("l_suppkey") % 101).cast("long").alias("all")).alias("clouds"),
        epoch_seconds(ts).alias("dt"),
        _null("sys").alias("sys"),
        F.lit(0).cast("long").alias("timezone"),
        F.lit(None).cast("long").alias("id"),
        F.lit(200).cast("long").alias("cod"),
        F.lit("Antarctica").alias("name"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss '+0000 UTC'").alias("dt_iso"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: typed live observations (location, ts, seq, temperature, wind, humidity, weather).
    `ts` becomes TIMESTAMP (UTC) so that watermarks accept it."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("station-"), (F.col("user_id") % 5).cast("string")).alias("location"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("temperature"),
        (F.col("user_id") % 20).cast("double").alias("wind"),
        F.get_json_object("props", "$.k").try_cast("double").alias("humidity"),
        F.col("event_type").alias("weather"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: E as MESSAGE JSON text in column `value` (+ seq for tie-breaks)."""
    e = observations(spark, sf_dir)
    return e.select(
        F.col("seq"),
        F.to_json(F.struct(
            F.col("location"), epoch_seconds("ts").alias("datetime"), F.col("temperature").alias("temp"),
            F.col("wind"), F.col("humidity"), F.col("weather"))).alias("value"))


def nested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M in OBS_NESTED shape: a current-weather record per observation, as JSON text."""
    e = observations(spark, sf_dir)
    item = F.struct(F.lit(800).cast("long").alias("id"), F.col("weather").alias("main"),
                    F.col("weather").alias("description"), F.lit("01d").alias("icon"))
    # 'view' observations carry an empty weather list (covers P15 on empty arrays)
    arr = F.when(F.col("weather") == "view", F.array_remove(F.array(item), item)).otherwise(F.array(item))
    rec = F.struct(
        arr.alias("weather"),
        F.struct(F.col("temperature").alias("temp"),
                 (F.col("temperature") - F.lit(1.0)).alias("temp_min"),
                 (F.col("temperature") + F.lit(1.0)).alias("temp_max"),
                 (F.lit(1000) + F.col("seq") % 50).alias("pressure"),
                 F.col("humidity").cast("long").alias("humidity")).alias("main"),
        F.struct(F.col("wind").alias("speed"), (F.col("seq") % 360).alias("deg")).alias("wind"),
        F.struct((F.col("seq") % 101).alias("all")).alias("clouds"),
        epoch_seconds("ts").alias("dt"),
        F.col("location").alias("name"),
    )
    return e.select(F.col("seq"), F.col("ts"), F.to_json(rec).alias("value"))
