"""History layer: goldens, rollup properties, records, seasons."""

import datetime as dt

from pyspark.sql import functions as F

from golden import GOLDEN_TRENDS
from obslake import fixtures
from obslake.functions.columns import season, season_year, yearly_trend_pct
from obslake.operators import history, rollup
from conftest import SF_SMALL


def test_golden_yearly_trends(spark):
    rows = [(s, m, y, v) for s, m, vals in GOLDEN_TRENDS for (y, v, _) in vals]
    long = spark.createDataFrame(rows, "season string, measure string, year int, value double")
    got = {(r.season, r.measure, r.year): (r.trend, r.has_prev)
           for r in history.yearly_trend(long).collect()}
    for s, m, vals in GOLDEN_TRENDS:
        for i, (y, _, trend) in enumerate(vals):
            assert got[(s, m, y)] == (trend, i > 0), (s, m, y)


def test_trend_zero_previous_and_negative_base(spark):
    df = spark.createDataFrame([(0.0, 4.0), (-15.44, -13.91), (None, 3.0)], "prev double, value double")
    out = [r.t for r in df.select(yearly_trend_pct("value", "prev").alias("t")).collect()]
    assert out == [0.0, 9.91, 0.0]


def test_season_edges(spark):
    days = [dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2020, 3, 1), dt.date(2020, 9, 30),
            dt.date(2020, 10, 1), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select(season("d").alias("s"), season_year("d").alias("y")).collect()
    assert [r.s for r in out] == ["summer", "summer", "winter", "winter", "summer", "summer"]
    assert [r.y for r in out] == [2020, 2020, 2020, 2020, 2021, 2021]


def test_daily_rollup_properties(spark):
    daily = rollup.history_daily(fixtures.history_records(spark, SF_SMALL))
    bad = daily.filter(
        (F.col("min_temp") > F.col("avg_temp")) | (F.col("avg_temp") > F.col("max_temp")) |
        (F.col("min_humidity") > F.col("avg_humidity")) | (F.col("avg_humidity") > F.col("max_humidity")))
    assert bad.count() == 0
    assert dict(daily.dtypes)["min_humidity"] == "double"  # Q2: all measures double
    n_days = fixtures.table(spark, SF_SMALL, "lineitem").select(F.to_date("l_shipdate")).distinct().count()
    assert daily.count() == n_days


def test_day_edge_utc(spark):
    rows = [("2020-09-25 23:59:59 +0000 UTC", 1.0), ("2020-09-26 00:00:00 +0000 UTC", 3.0)]
    df = spark.createDataFrame(rows, "dt_iso string, t double").select(
        "dt_iso", F.struct(F.col("t").alias("temp"), F.col("t").alias("temp_min"), F.col("t").alias("temp_max"),
                           F.lit(1).cast("long").alias("pressure"), F.lit(1).cast("long").alias("humidity")).alias("main"),
        F.struct(F.lit(1.0).alias("speed"), F.lit(1).cast("long").alias("deg")).alias("wind"),
        F.struct(F.lit(1).cast("long").alias("all")).alias("clouds"))
    out = sorted((r.unix_date, r.avg_temp) for r in rollup.history_daily(df).collect())
    assert out == [(1600992000, 1.0), (1601078400, 3.0)]


def test_season_max_is_max_of_days(spark):
    daily = rollup.history_daily(fixtures.history_records(spark, SF_SMALL))
    seas = rollup.season_rollup(daily)
    cal = rollup.with_calendar(daily).groupBy("year", "season").agg(F.max("max_temp").alias("m"))
    j = seas.join(cal, ["year", "season"])
    assert j.filter(F.col("m") != F.col("max_temp")).count() == 0


def test_records_orders(spark):
    seas = spark.createDataFrame(
        [(2001, "summer", 1.0, 5.0, 0.0, 1.0, 2.0, 0.0, 50.0, 60.0, 40.0),
         (2002, "summer", 2.0, 9.0, -3.0, 1.0, 4.0, 0.5, 51.0, 81.0, 30.0)],
        "year int, season string, avg_temp double, max_temp double, min_temp double, avg_speed double, "
        "max_speed double, min_speed double, avg_humidity double, max_humidity double, min_humidity double")
    ext = {r.measure: (r.year, r.value) for r in history.records(seas, "extreme").collect()}
    ref = {r.measure: (r.year, r.value) for r in history.records(seas, "reference").collect()}
    assert ext["Max Temperature"] == (2002, 9.0) and ext["Min Temperature"] == (2002, -3.0)
    assert ref["Max Temperature"] == (2001, 5.0)  # Q1: ascending for both
    assert ext["Max Humidity"] == (2002, 81.0)


def test_latest_years_limit(spark):
    daily = rollup.history_daily(fixtures.history_records(spark, SF_SMALL))
    lat = history.latest_years(rollup.season_rollup(daily))
    per = lat.groupBy("season", "measure").count().collect()
    assert per and all(r["count"] <= 4 for r in per)


def test_exact_mean_is_independent_of_partitioning(spark):
    """The rounded daily means are bit-identical however rows are spread over tasks."""
    h = fixtures.history_records(spark, SF_SMALL)
    one = rollup.history_daily(h.repartition(1))
    many = rollup.history_daily(h.repartition(64).sortWithinPartitions(F.col("dt").desc()))
    a = sorted(tuple(r) for r in one.collect())
    b = sorted(tuple(r) for r in many.collect())
    assert a == b


def test_current_season_products(spark):
    """the product shown is the one of the season the clock date falls in."""
    from obslake.plans import serve

    long = spark.createDataFrame([("summer", 2020, "Max Humidity", 1.0), ("winter", 2020, "Max Humidity", 2.0)],
                                 "season string, year int, measure string, value double")
    assert [r.season for r in serve.for_season(long, "2024-01-31").collect()] == ["summer"]
    assert [r.season for r in serve.for_season(long, "2024-07-01").collect()] == ["winter"]
    assert serve.for_season(long).count() == 1  # the real clock: exactly one season
