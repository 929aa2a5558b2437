"""Flattening, daily and seasonal rollups, wide->long measures.

Every rollup is one groupBy: Spark plans a partial (map-side) hash aggregate, one shuffle of
at most (#groups x #map tasks) rows, and a final aggregate. A hot day or season therefore never
concentrates raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.columns import (day_epoch, epoch_to_date, exact_mean, iso_day,
                                       midnight_epoch, season, season_year)
from obslake.schemas import DAILY_MEASURES, MEASURE_NAMES

# Physical names of the raw-observation table for the nested record's fields.
FLAT_FIELDS = {
    "clouds": "clouds.all",
    "humidity": "main.humidity",
    "pressure": "main.pressure",
    "temp": "main.temp",
    "temp_min": "main.temp_min",
    "temp_max": "main.temp_max",
    "deg": "wind.deg",
    "speed": "wind.speed",
}


def flatten_observation(nested: DataFrame, key: str = "dt", key_as: str = "unix_date") -> DataFrame:
    """Nested record -> flat raw-observation row (all measures double, Q2)."""
    return nested.select(
        F.col(key).cast("long").alias(key_as),
        *[F.col(src).cast("double").alias(dst) for dst, src in FLAT_FIELDS.items()],
    )


def _measure_aggs() -> list:
    out = []
    for m in DAILY_MEASURES:
        lo = "temp_min" if m == "temp" else m
        hi = "temp_max" if m == "temp" else m
        out += [
            exact_mean(m).alias(f"avg_{m}"),
            F.min(lo).cast("double").alias(f"min_{m}"),
            F.max(hi).cast("double").alias(f"max_{m}"),
        ]
    return out


def daily_rollup(flat: DataFrame, key: str = "unix_date", by: tuple[str, ...] = ()) -> DataFrame:
    """18 daily measures (avg to 2 decimals, min, max) per `key` (+ optional `by` keys,
    e.g. a location). Input: flat columns clouds, humidity, pressure, temp, temp_min, temp_max,
    deg, speed."""
    return flat.groupBy(key, *by).agg(*_measure_aggs())


def history_daily(nested: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V8 core (G1): nested history records -> daily table keyed by midnight epoch of dt_iso."""
    day = iso_day("dt_iso")
    flat = nested.select(
        day_epoch(day).alias("unix_date"), *[F.col(c) for c in by],
        *[F.col(src).alias(dst) for dst, src in FLAT_FIELDS.items()],
    )
    return daily_rollup(flat, by=by)


def observations_daily(flat: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V9 core (G2): raw observations keyed by observation epoch -> daily table."""
    return daily_rollup(flat.withColumn("unix_date", midnight_epoch("unix_date")), by=by)


def with_calendar(daily: DataFrame, split_summer: bool = False) -> DataFrame:
    """Date, year, month and season of a daily row. With split_summer, summer
    months October-December are counted to the next year (Q16)."""
    d = epoch_to_date("unix_date")
    return daily.withColumns({
        "date": d,
        "year": season_year(d) if split_summer else F.year(d),
        "month": F.month(d),
        "season": season(d),
    })


def season_rollup(daily: DataFrame, split_summer: bool = False) -> DataFrame:
    """Per (year, season): mean of daily means (unweighted, 2 decimals), max of daily max,
    min of daily min, for temperature, wind speed and humidity."""
    cal = with_calendar(daily, split_summer)
    aggs = []
    for m in ("temp", "speed", "humidity"):
        aggs += [exact_mean(f"avg_{m}").alias(f"avg_{m}"),
                 F.max(f"max_{m}").alias(f"max_{m}"),
                 F.min(f"min_{m}").alias(f"min_{m}")]
    return cal.groupBy("year", "season").agg(*aggs)


def measure_label(col_name_col) -> F.Column:
    """Column name (max_temp, ...) -> display name (Max Temperature, ...)."""
    m = F.create_map(*[x for k, v in MEASURE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, col_name_col)


def to_long(season_df: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Wide season rows -> (season, year, measure, value) in one pass (Expand), instead
    of one scan per measure glued with UNION ALL. Integer-valued measures widen to double."""
    wide = season_df.select("season", "year", *[F.col(m).cast("double").alias(m) for m in measures])
    long = wide.unpivot(["season", "year"], list(measures), "measure_col", "value")
    return long.select("season", "year", measure_label(F.col("measure_col")).alias("measure"), "value")
