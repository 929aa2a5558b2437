"""Records, latest years and year-over-year trends.

Inputs here are season-level rows (years x 2 seasons x 9 measures), so window functions
partitioned by (season, measure) see tiny partitions; the heavy work is upstream in the rollups.
Both seasons are computed in one pass (Q17); `season=` narrows to one (P9), and Catalyst pushes
that filter below the season aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.functions.columns import yearly_trend_pct
from obslake.operators.rollup import to_long
from obslake.schemas import LATEST_YEARS, RECORD_MEASURES, TREND_MEASURES


def _only(df: DataFrame, season: str | None) -> DataFrame:
    return df if season is None else df.filter(F.col("season") == F.lit(season))


def records(season_df: DataFrame, order: str = "extreme", season: str | None = None) -> DataFrame:
    """L1: one record row per (season, measure).

    order='extreme': Max measures take the highest value, Min the lowest (Q1 fixed).
    order='reference': ascending for both, i.e. the lowest yearly maximum (original behaviour).
    Ties are broken by the earlier year.
    """
    long = to_long(_only(season_df, season), RECORD_MEASURES)
    if order == "extreme":
        key = F.when(F.col("measure").startswith("Max"), -F.col("value")).otherwise(F.col("value"))
    elif order == "reference":
        key = F.col("value")
    else:
        raise ValueError(f"unknown order {order!r}")
    w = Window.partitionBy("season", "measure").orderBy(key.asc_nulls_last(), F.col("year").asc())
    return (long.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def latest_years(season_df: DataFrame, n: int = LATEST_YEARS, season: str | None = None,
                 measures: tuple[str, ...] = TREND_MEASURES) -> DataFrame:
    """L2: the latest n years per (season, measure) -> WindowGroupLimit, no global sort."""
    long = to_long(_only(season_df, season), measures)
    w = Window.partitionBy("season", "measure").orderBy(F.col("year").desc())
    return long.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def yearly_trend(long: DataFrame) -> DataFrame:
    """W1+W2 (X2, usable with df.transform): percent change against the previous year of the same
    (season, measure), rounded to 2; 0.0 without a previous value, has_prev tells which."""
    w = Window.partitionBy("season", "measure").orderBy("year")
    prev = F.lag("value").over(w)
    return (long.withColumn("_prev", prev)
            .withColumn("trend", yearly_trend_pct("value", "_prev"))
            .withColumn("has_prev", F.col("_prev").isNotNull())
            .drop("_prev"))


def trends(season_df: DataFrame, n: int = LATEST_YEARS, season: str | None = None) -> DataFrame:
    """V7 core: latest n years per measure with their year-over-year trend."""
    return latest_years(season_df, n, season).transform(yearly_trend)
