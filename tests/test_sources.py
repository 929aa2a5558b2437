"""Codecs, keyed tables, TTL, labels, serving helpers."""

import datetime as dt

from pyspark.sql import functions as F

from obslake.functions.columns import clean_location, interval_label, pct_change
from obslake.schemas import MESSAGE
from obslake.session import work_path
from obslake.sources import codecs, tables


def test_line_parse_names(spark):
    lines = ["('New York', 1601044162, 16, 29, 224.59, 5.4, 62, 'Clouds')",
             "(\"L'Aquila\", 1601044162, 16, 29, -1.5, 0.0, 81, 'Clear')",
             "('Washington, D.C.', 1601044162, 16, 29, 1.0, 2.0, 3.0, 'Rain')",
             "not a tuple"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = df.select(codecs.parse_line("value").alias("p")).collect()
    assert [r.p.location if r.p else None for r in out] == ["New York", "L'Aquila", "Washington, D.C.", None]
    assert out[1].p.humidity == 81.0 and out[0].p.timestamp == 1601044162


def test_line_round_trip(spark):
    df = spark.createDataFrame([("L'Aquila", 1601044162, 1.25, 0.0, 81.0, "Clear")],
                               "location string, e long, t double, w double, h double, x string")
    line = df.select(codecs.format_line("location", "e", "t", "w", "h", "x").alias("v"))
    p = line.select(codecs.parse_line("v").alias("p")).first().p
    assert (p.location, p.timestamp, p.temperature, p.weather, p.hour, p.minute) == \
        ("L'Aquila", 1601044162, 1.25, "Clear", 14, 29)


def test_double_encoded_and_rejects(spark):
    single = '{"location":"A","datetime":1,"temp":-23.56,"wind":0.0,"humidity":81,"weather":"Clouds"}'
    double = '"' + single.replace('"', '\\"') + '"'
    df = spark.createDataFrame([(1, single), (2, double), (3, '{"location": "A", "te')], "seq long, value string")
    dec = df.select("seq", codecs.decode("value", MESSAGE).alias("m")).collect()
    assert dec[0].m == dec[1].m and dec[0].m.humidity == 81.0  # long/double union -> 81.0
    good, rej = codecs.split_rejects(df.filter("seq != 2"))
    assert [r.seq for r in good.collect()] == [1] and [r.seq for r in rej.collect()] == [3]


def test_empty_weather_array(spark):
    df = spark.createDataFrame([([],), ([("Clouds",)],)], "w array<struct<main:string>>")
    assert [r.x for r in df.select(codecs.first_weather("w").alias("x")).collect()] == [None, "Clouds"]


def test_labels_and_location_cleanup(spark):
    df = spark.createDataFrame([(60, "('Antarctica',)"), (61, "L'Aquila."), (21600, "x")], "i int, l string")
    out = df.select(interval_label("i").alias("a"), clean_location("l").alias("b")).collect()
    assert [r.a for r in out] == ["1 m", "Invalid interval", "6 h"]
    assert [r.b for r in out] == ["Antarctica,", "LAquila", "x"]


def test_pct_change_signed_vs_abs(spark):
    df = spark.createDataFrame([(-10.0, -5.0), (0.0, 1.0)], "start double, now double")
    out = df.select(pct_change("now", "start", True).alias("s"), pct_change("now", "start", False).alias("a")).collect()
    assert (out[0].s, out[0].a) == (-50.0, 50.0)
    assert out[1].s is None and out[1].a is None


def test_upsert_is_idempotent_and_latest_wins(spark):
    path = work_path(spark, "t_upsert")
    old = spark.createDataFrame([("A", 1, 1.0, 1, dt.date(2024, 1, 1)), ("A", 2, 2.0, 1, dt.date(2024, 1, 1)),
                                 ("B", 3, 3.0, 1, dt.date(2024, 1, 2))],
                                "location string, ts long, v double, batch int, day date")
    new = spark.createDataFrame([("A", 2, 20.0, 2, dt.date(2024, 1, 1)), ("C", 4, 4.0, 2, dt.date(2024, 1, 3))],
                                "location string, ts long, v double, batch int, day date")
    keys, order = ["location", "ts"], ["batch"]
    tables.merge_upsert(spark, path, old, keys, order, "day")
    tables.merge_upsert(spark, path, new, keys, order, "day")
    first = sorted(tuple(r) for r in tables.read_table(spark, path).select("location", "ts", "v").collect())
    tables.merge_upsert(spark, path, new, keys, order, "day")
    second = sorted(tuple(r) for r in tables.read_table(spark, path).select("location", "ts", "v").collect())
    assert first == second == [("A", 1, 1.0), ("A", 2, 20.0), ("B", 3, 3.0), ("C", 4, 4.0)]


def test_ttl(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 29, 23, 0),), (dt.datetime(2024, 1, 30, 1, 0),)], "written_at timestamp")
    assert tables.expire(df, "2024-01-31 00:00:00").count() == 1


def test_csv_round_trip(spark):
    path = work_path(spark, "t_csv")
    df = spark.createDataFrame([("summer", 2014, "Max Humidity", 81.0, 0.0)],
                               "season string, year int, measure string, value double, trend double")
    tables.write_csv_single(df, path)
    back = tables.read_result_csv(spark, path, trends=True).collect()
    assert [tuple(r) for r in back] == [("summer", 2014, "Max Humidity", 81.0, 0.0)]
    assert F is not None


def test_to_celsius(spark):
    from obslake.functions.columns import to_celsius
    df = spark.createDataFrame([(273.15, "K"), (212.0, "f"), (-23.56, "C"), (1.0, "X")], "t double, u string")
    assert [r.c for r in df.select(to_celsius("t", "u").alias("c")).collect()] == [0.0, 100.0, -23.56, None]


def test_compaction_keeps_only_live_rows(spark):
    path = work_path(spark, "t_compact")
    rows = [(dt.datetime(2024, 1, d, h), dt.date(2024, 1, d)) for d in (28, 29, 30) for h in (1, 23)]
    tables.create_table(spark.createDataFrame(rows, "written_at timestamp, day date"), path, "written_at", "day")
    tables.compact_expired(spark, path, "2024-01-30 12:00:00")
    left = sorted(r.written_at for r in tables.read_table(spark, path).collect())
    assert left == [dt.datetime(2024, 1, 29, 23), dt.datetime(2024, 1, 30, 1), dt.datetime(2024, 1, 30, 23)]


def test_small_column_helpers(spark):
    from obslake.functions.columns import (epoch_to_date, local_hour, local_minute, midnight_epoch,
                                           now, strip_outer, to_epoch_long)
    df = spark.createDataFrame([("('a', 1)", "1601044162.73", 1601044162)], "line string, f string, e long")
    r = df.select(strip_outer("line").alias("s"), to_epoch_long("f").alias("l"),
                  local_hour("e").alias("h"), local_minute("e").alias("m"),
                  midnight_epoch("e").alias("mid"), epoch_to_date("e").alias("d"),
                  now().isNotNull().alias("t")).first()
    assert (r.s, r.l, r.h, r.m, r.mid, r.d, r.t) == ("'a', 1", 1601044162, 14, 29, 1600992000, dt.date(2020, 9, 25), True)


def test_create_table_rerun_after_failed_attempt(spark):
    import os

    import pytest

    path = work_path(spark, "t_create")
    os.makedirs(os.path.join(path.removeprefix("file:"), "_temporary"))  # leftovers of a failed attempt
    df = spark.createDataFrame([(1, 2020, 1.0), (2, 2021, 2.0)], "unix_date long, year int, v double")
    tables.create_table(df, path)
    assert tables.read_table(spark, path).count() == 2
    with pytest.raises(FileExistsError):
        tables.create_table(df, path)


def test_upsert_safe_under_static_overwrite_session(spark):
    """Keyed writes must not wipe untouched partitions even if the session is in static mode."""
    path = work_path(spark, "t_static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        a = spark.createDataFrame([("A", 1, 1.0, 1, dt.date(2024, 1, 1)), ("B", 2, 2.0, 1, dt.date(2024, 1, 2))],
                                  "location string, ts long, v double, batch int, day date")
        b = spark.createDataFrame([("A", 1, 5.0, 2, dt.date(2024, 1, 1))],
                                  "location string, ts long, v double, batch int, day date")
        tables.merge_upsert(spark, path, a, ["location", "ts"], ["batch"], "day")
        tables.merge_upsert(spark, path, b, ["location", "ts"], ["batch"], "day")
        got = sorted(tuple(r) for r in tables.read_table(spark, path).select("location", "v").collect())
        assert got == [("A", 5.0), ("B", 2.0)]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_line_parse_unicode_negative_and_junk(spark):
    lines = ["('Zürich', 1601044162, 16, 29, -12.5, 3.0, 40, 'Snow')",
             "('São Paulo', -5, 0, 0, 1e3, 2, 3, 'Rain')",
             "('X', 1601044162, 16, 29, abc, 1.0, 2.0, 'Clear')"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = [r.p for r in df.select(codecs.parse_line("value").alias("p")).collect()]
    assert (out[0].location, out[0].temperature) == ("Zürich", -12.5)
    assert (out[1].location, out[1].timestamp, out[1].temperature) == ("São Paulo", -5, 1000.0)
    assert out[2].location == "X" and out[2].temperature is None and out[2].wind == 1.0


def test_json_export_keeps_nulls(spark):
    """Serving JSON keeps null fields (a zero-start trend is shown as null, not dropped)."""
    df = spark.createDataFrame([("A", None, 1.5)], "location string, wind_trend double, actual_wind double")
    assert tables.to_json_lines(df).first().json == '{"location":"A","wind_trend":null,"actual_wind":1.5}'


def test_upsert_keeps_rows_of_the_null_partition(spark):
    path = work_path(spark, "t_null")
    old = spark.createDataFrame([("a", None, 1.0), ("b", None, 2.0), ("c", 2020, 3.0)], "k string, year int, v double")
    tables.merge_upsert(spark, path, old, ["k"], [], "year")
    tables.merge_upsert(spark, path, spark.createDataFrame([("b", None, 9.0), ("d", 2021, 4.0)], old.schema), ["k"], [], "year")
    tables.merge_upsert(spark, path, old.limit(0), ["k"], [], "year")  # empty: no change
    assert sorted((r.k, r.year, r.v) for r in tables.read_table(spark, path).collect()) == [
        ("a", None, 1.0), ("b", None, 9.0), ("c", 2020, 3.0), ("d", 2021, 4.0)]


def test_create_table_refuses_an_upserted_table(spark):
    import pytest

    path = work_path(spark, "t_refuse")
    df = spark.createDataFrame([(1, 2020, 1.0)], "unix_date long, year int, v double")
    tables.merge_upsert(spark, path, df, ["unix_date"], [], "year")
    with pytest.raises(FileExistsError):
        tables.create_table(df, path)
    tables.create_table(df.withColumn("v", F.lit(2.0)), path, overwrite=True)
    assert [r.v for r in tables.read_table(spark, path).collect()] == [2.0]


def test_later_delivery_replaces_stored_row_whatever_its_order(spark):
    path = work_path(spark, "t_later")
    rows = lambda b, v: spark.createDataFrame([(1, b, v, 2020)], "k int, batch int, v double, year int")
    tables.merge_upsert(spark, path, rows(7, 1.0), ["k"], ["batch"], "year")
    tables.merge_upsert(spark, path, rows(0, 9.0), ["k"], ["batch"], "year")  # ids restarted
    assert [r.v for r in tables.read_table(spark, path).collect()] == [9.0]


def test_daily_job_upserts_into_the_bootstrapped_table(spark):
    """V8, then V9 into the same table: delivered days are replaced, all others stay."""
    from obslake.plans import jobs
    from obslake.operators import rollup

    root = work_path(spark, "t_v8v9")
    cols = ["clouds", "humidity", "pressure", "temp", "temp_min", "temp_max", "deg", "speed"]
    obs = lambda days, v: spark.createDataFrame(
        [(d * 86400 + h, *([v + h] * 8)) for d in days for h in (0, 3600)], "unix_date long, " + ", ".join(f"{c} double" for c in cols))
    first, second = obs([100, 101, 400], 1.0), obs([101, 800], 50.0)
    daily = f"{root}/daily"
    tables.create_table(jobs._with_year(rollup.observations_daily(first)), daily)
    second.write.parquet(f"{root}/raw")
    jobs.daily_incremental(spark, f"{root}/raw", daily)
    want = rollup.observations_daily(first).where("unix_date <> 101 * 86400").unionByName(rollup.observations_daily(second))
    got = tables.read_table(spark, daily).drop("year").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_exact_mean_of_infinities_nan_large_and_long_decimals(spark):
    import math

    from obslake.functions.columns import exact_mean

    inf, nan = math.inf, math.nan
    groups = {"plain": [0.01, 0.02], "eight": [0.00500001, 0.00499999], "long": [0.00499999] * 4,
              "neg": [-7.125, -7.125], "big": [1e13, 3e13, 1.0], "inf": [1.0, inf], "both": [inf, -inf],
              "nan": [1.0, nan, 2.0], "null": [None, None], "some": [None, 3.0], "wide": [9999999.25, -9999999.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_mean("v").alias("m")).collect()}
    assert (got["plain"], got["eight"], got["long"], got["neg"]) == (0.02, 0.01, 0.0, -7.13)
    assert got["big"] == round((4e13 + 1.0) / 3, 2) and got["inf"] == inf and got["wide"] == 0.13
    assert math.isnan(got["both"]) and math.isnan(got["nan"]) and got["null"] is None and got["some"] == 3.0
