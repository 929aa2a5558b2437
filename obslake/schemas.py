"""Declared schemas (no inference at any source) and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that results must reproduce.
# ---------------------------------------------------------------------------

# Speed-layer window lengths in seconds, all sliding by one minute.
MINUTE = 60
INTERVALS = (60, 300, 600, 1800, 3600, 21600)
SLIDE_S = 60
DAY_S = 86400  # lifetime of live results (TTL)

# Interval labels shown by the serving layer; anything else is "Invalid interval".
INTERVAL_LABELS = {60: "1 m", 300: "5 m", 600: "10 m", 1800: "30 m", 3600: "1 h", 21600: "6 h"}
INVALID_INTERVAL = "Invalid interval"

# Season: months 3..9 are winter (southern hemisphere), the rest summer.
WINTER_FIRST_MONTH = 3
WINTER_END_MONTH = 10  # exclusive

# Long-form measure names of the history products.
MEASURE_NAMES = {
    "max_temp": "Max Temperature",
    "min_temp": "Min Temperature",
    "avg_temp": "AVG Temperature",
    "max_speed": "Max Wind Speed",
    "min_speed": "Min Wind Speed",
    "avg_speed": "AVG Wind Speed",
    "max_humidity": "Max Humidity",
    "min_humidity": "Min Humidity",
    "avg_humidity": "AVG Humidity",
}
# Measures of the "records" product (no averages) and of the "trends" product.
RECORD_MEASURES = ("max_temp", "min_temp", "max_speed", "min_speed", "max_humidity", "min_humidity")
TREND_MEASURES = ("max_temp", "min_temp", "avg_temp", "max_speed", "min_speed", "avg_speed",
                  "max_humidity", "min_humidity", "avg_humidity")
LATEST_YEARS = 4

# Daily rollup: output name -> (aggregate, source field). Temperature takes its minimum from
# temp_min and its maximum from temp_max; every other measure uses one field for all three.
DAILY_MEASURES = ("clouds", "humidity", "pressure", "temp", "deg", "speed")

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

WEATHER_ITEM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("main", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("icon", T.StringType()),
])

# Nested weather record (current-weather message and history file rows).
OBS_NESTED = T.StructType([
    T.StructField("coord", T.StructType([T.StructField("lon", T.DoubleType()),
                                          T.StructField("lat", T.DoubleType())])),
    T.StructField("weather", T.ArrayType(WEATHER_ITEM)),
    T.StructField("base", T.StringType()),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("temp_min", T.DoubleType()),
        T.StructField("temp_max", T.DoubleType()),
        T.StructField("pressure", T.LongType()),
        T.StructField("humidity", T.LongType()),
        T.StructField("sea_level", T.LongType()),
        T.StructField("grnd_level", T.LongType()),
    ])),
    T.StructField("visibility", T.LongType()),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType()),
                                         T.StructField("deg", T.LongType())])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.LongType())])),
    T.StructField("dt", T.LongType()),
    T.StructField("sys", T.StructType([T.StructField("sunrise", T.LongType()),
                                        T.StructField("sunset", T.LongType())])),
    T.StructField("timezone", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("cod", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("dt_iso", T.StringType()),
])

# Raw-observation table (flat), key unix_date.
OBS_FLAT = T.StructType([
    T.StructField("unix_date", T.LongType()),
    T.StructField("clouds", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("temp_min", T.DoubleType()),
    T.StructField("temp_max", T.DoubleType()),
    T.StructField("deg", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
])

DAILY = T.StructType([T.StructField("unix_date", T.LongType())] + [
    T.StructField(f"{agg}_{m}", T.DoubleType()) for m in DAILY_MEASURES for agg in ("avg", "min", "max")
])

# Live message of the speed layer.
MESSAGE = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("datetime", T.LongType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("wind", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("weather", T.StringType()),
])

# The columns of a broker source.
BROKER = "key string, value string, partition int, offset long, timestamp timestamp"

# Typed observation used by every speed-layer operator.
OBSERVATION = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("wind", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("weather", T.StringType()),
])

# Long history results, as written to CSV.
LONG_MEASURES = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("measure", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
LONG_TRENDS = T.StructType(LONG_MEASURES.fields + [T.StructField("trend", T.DoubleType())])
