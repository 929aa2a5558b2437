"""DuckDB SQL equivalents of the named queries (the correctness oracle).

The SQL is written against the raw driver tables. Two helpers keep exact parity with Spark:
`xmean` reproduces exact_mean (HALF_UP mean of an exact decimal sum) with integer arithmetic,
and `r2` reproduces Spark's round(double, 2), which rounds the shortest decimal form HALF_UP.
"""

from __future__ import annotations

from obslake.schemas import (INTERVAL_LABELS, INTERVALS, LATEST_YEARS, MEASURE_NAMES,
                             RECORD_MEASURES, TREND_MEASURES)


def r2(x: str) -> str:
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,15)), 2) AS DOUBLE)"


def xmean(x: str) -> str:
    s = f"CAST(SUM(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(24,8))) * 100000000 AS HUGEINT)"
    d = f"(CAST(COUNT({x}) AS HUGEINT) * 1000000)"
    q = (f"CASE WHEN {s} >= 0 THEN ({s} * 2 + {d}) // ({d} * 2) "
         f"ELSE -((-{s} * 2 + {d}) // ({d} * 2)) END")
    return f"(CAST({q} AS DOUBLE) / 100.0::DOUBLE)"


def pct(now: str, start: str, signed: bool) -> str:
    den = start if signed else f"abs({start})"
    return f"(CASE WHEN {start} = 0 THEN NULL ELSE ({now} - {start}) / {den} END * 100.0)"


# --- H: history records from lineitem -----------------------------------------------------

H_FLAT = """
h_src AS (
  SELECT CAST(l_shipdate AS DATE) AS day,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) - 6000000 AS tc,
         l_linenumber, l_discount, l_partkey, l_suppkey, l_orderkey, l_quantity, l_shipdate
  FROM lineitem),
h_flat AS (
  SELECT CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) AS unix_date,
         CAST(epoch(l_shipdate) AS BIGINT) AS dt,
         CAST(l_suppkey % 101 AS DOUBLE) AS clouds,
         CAST(40 + 5 * CAST(ROUND(l_discount * 100) AS BIGINT) AS DOUBLE) AS humidity,
         CAST(900 + l_partkey % 150 AS DOUBLE) AS pressure,
         tc / 100 AS temp,
         (tc - 100 * l_linenumber) / 100 AS temp_min,
         (tc + 100 * l_linenumber) / 100 AS temp_max,
         CAST(l_orderkey % 360 AS DOUBLE) AS deg,
         l_quantity * 0.5::DOUBLE AS speed
  FROM h_src)"""


def daily_select(src: str, key: str = "unix_date") -> str:
    parts = []
    for m in ("clouds", "humidity", "pressure", "temp", "deg", "speed"):
        lo = "temp_min" if m == "temp" else m
        hi = "temp_max" if m == "temp" else m
        parts += [f"{xmean(m)} AS avg_{m}", f"MIN({lo}) AS min_{m}", f"MAX({hi}) AS max_{m}"]
    return f"SELECT {key} AS unix_date, {', '.join(parts)} FROM {src} GROUP BY {key}"


H_DAILY = H_FLAT + f""",
h_daily AS ({daily_select('h_flat')})"""


def season_cte(split_summer: bool = False) -> str:
    year = ("CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END" if split_summer
            else "year(d)")
    return H_DAILY + f""",
h_cal AS (
  SELECT *, CAST({year} AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CASE WHEN month(d) >= 3 AND month(d) < 10 THEN 'winter' ELSE 'summer' END AS season
  FROM (SELECT *, CAST(make_timestamp(unix_date * 1000000) AS DATE) AS d FROM h_daily)),
h_season AS (
  SELECT year, season,
         {xmean('avg_temp')} AS avg_temp, MAX(max_temp) AS max_temp, MIN(min_temp) AS min_temp,
         {xmean('avg_speed')} AS avg_speed, MAX(max_speed) AS max_speed, MIN(min_speed) AS min_speed,
         {xmean('avg_humidity')} AS avg_humidity, MAX(max_humidity) AS max_humidity,
         MIN(min_humidity) AS min_humidity
  FROM h_cal GROUP BY year, season)"""


def long_union(measures: tuple[str, ...], src: str = "h_season") -> str:
    return "\n  UNION ALL ".join(
        f"SELECT season, year, '{MEASURE_NAMES[m]}' AS measure, CAST({m} AS DOUBLE) AS value FROM {src}"
        for m in measures)


def q_daily_rollup() -> str:
    return f"WITH {H_DAILY} SELECT * FROM h_daily"


def q_season_rollup(split_summer: bool = False) -> str:
    return f"WITH {season_cte(split_summer)} SELECT * FROM h_season"


def q_measures_long() -> str:
    return f"WITH {season_cte()}, lng AS ({long_union(TREND_MEASURES)}) SELECT * FROM lng"


def q_records(order: str, season: str | None = None) -> str:
    if order == "extreme":
        key = "CASE WHEN starts_with(measure, 'Max') THEN -value ELSE value END"
    else:
        key = "value"
    return f"""WITH {season_cte()}, lng AS ({long_union(RECORD_MEASURES)}),
r AS (SELECT *, row_number() OVER (PARTITION BY season, measure ORDER BY {key} ASC NULLS LAST, year ASC) AS rn
      FROM lng)
SELECT season, year, measure, value FROM r WHERE rn = 1""" + (
        "" if season is None else f" AND season = '{season}'")


def q_latest_years(n: int = LATEST_YEARS) -> str:
    return f"""WITH {season_cte()}, lng AS ({long_union(TREND_MEASURES)}),
r AS (SELECT *, row_number() OVER (PARTITION BY season, measure ORDER BY year DESC) AS rn FROM lng)
SELECT season, year, measure, value FROM r WHERE rn <= {n}"""


def q_yearly_trend(n: int = LATEST_YEARS, season: str | None = None, with_has_prev: bool = True) -> str:
    where = "" if season is None else f" AND season = '{season}'"
    return f"""WITH {season_cte()}, lng AS ({long_union(TREND_MEASURES)}),
r AS (SELECT *, row_number() OVER (PARTITION BY season, measure ORDER BY year DESC) AS rn FROM lng),
l AS (SELECT season, year, measure, value FROM r WHERE rn <= {n}{where}),
t AS (SELECT *, lag(value) OVER (PARTITION BY season, measure ORDER BY year) AS prev FROM l)
SELECT season, year, measure, value,
       COALESCE({r2(pct('value', 'prev', signed=False))}, 0.0::DOUBLE) AS trend
       {", prev IS NOT NULL AS has_prev" if with_has_prev else ""}
FROM t"""


# --- E: observations from events ----------------------------------------------------------

E_OBS = """
e AS (
  SELECT 'station-' || CAST(user_id % 5 AS VARCHAR) AS location, ts, event_id AS seq,
         value AS temperature, CAST(user_id % 20 AS DOUBLE) AS wind,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity, event_type AS weather
  FROM events)"""

REC = "{'ts': ts, 'seq': seq, 'temperature': temperature, 'wind': wind, 'humidity': humidity, 'weather': weather}"


def ends_cte(intervals=INTERVALS) -> str:
    arr = ", ".join(str(int(w)) for w in intervals)
    return E_OBS + f""",
e_iv AS (SELECT *, unnest([{arr}]) AS interval_s FROM e),
e_x AS (
  SELECT *, unnest(generate_series(date_trunc('minute', ts) + INTERVAL 1 MINUTE,
                                   date_trunc('minute', ts) + to_seconds(interval_s),
                                   INTERVAL 1 MINUTE)) AS window_end
  FROM e_iv),
ends AS (
  SELECT location, interval_s, window_end,
         arg_min({REC}, (ts, seq)) AS f, arg_max({REC}, (ts, seq)) AS l
  FROM e_x GROUP BY location, interval_s, window_end)"""


def q_window_ends(w: int) -> str:
    return f"""WITH {ends_cte((w,))}
SELECT location, interval_s, window_end, f.seq AS first_seq, f.ts AS first_ts,
       l.seq AS last_seq, l.ts AS last_ts FROM ends"""


TREND_SELECT = f"""SELECT location, interval_s, window_end,
       l.temperature AS actual_temperature,
       {pct('l.temperature', 'f.temperature', signed=True)} AS temperature_trend,
       l.wind AS actual_wind, {pct('l.wind', 'f.wind', signed=True)} AS wind_trend,
       l.humidity AS actual_humidity, l.humidity - f.humidity AS humidity_delta,
       l.weather AS weather
FROM ends"""


def q_interval_trends(intervals=INTERVALS) -> str:
    return f"WITH {ends_cte(intervals)}\n{TREND_SELECT}"


EP = "(epoch_us(ts) // 1000000)"


def _q(x: str) -> str:
    sq = "''''"  # a single-quote character as a SQL literal
    return f"""(CASE WHEN instr({x}, {sq}) > 0 THEN '"' || {x} || '"' ELSE {sq} || {x} || {sq} END)"""


NESTED_FLAT = f"""SELECT location, seq, temperature AS temp, temperature - 1.0 AS temp_min, temperature + 1.0 AS temp_max,
       CAST(1000 + seq % 50 AS DOUBLE) AS pressure, CAST(CAST(humidity AS BIGINT) AS DOUBLE) AS humidity,
       wind AS speed, CAST(seq % 360 AS DOUBLE) AS deg, CAST(seq % 101 AS DOUBLE) AS clouds,
       {EP} AS unix_date
FROM e"""


def q_nested_flatten() -> str:
    return f"WITH {E_OBS}, nf AS ({NESTED_FLAT}) SELECT * EXCLUDE (location) FROM nf"


def q_first_weather() -> str:
    return f"WITH {E_OBS} SELECT seq, CASE WHEN weather = 'view' THEN NULL ELSE weather END AS weather_main FROM e"


MSG_COLS = f"location, {EP} AS datetime, temperature AS temp, wind, humidity, weather"


def q_double_json_decode() -> str:
    return f"""WITH {E_OBS}
SELECT seq, 'single' AS encoding, {MSG_COLS} FROM e
UNION ALL SELECT seq, 'double' AS encoding, {MSG_COLS} FROM e"""


def q_corrupt_split() -> str:
    return f"""WITH {E_OBS}
SELECT seq, {MSG_COLS}, 'ok' AS status FROM e WHERE weather <> 'error'
UNION ALL
SELECT seq, NULL, NULL, NULL, NULL, NULL, NULL, 'rejected' FROM e WHERE weather = 'error'"""


LINE = (f"'(' || {_q('location')} || ', ' || {EP} || ', ' || hour(ts) || ', ' || minute(ts) || ', ' || "
        f"CAST(temperature AS VARCHAR) || ', ' || CAST(wind AS VARCHAR) || ', ' || "
        f"CAST(humidity AS VARCHAR) || ', ' || {_q('weather')} || ')'")


def q_line_format() -> str:
    return f"WITH {E_OBS} SELECT seq, {LINE} AS value FROM e"


def q_line_parse() -> str:
    return f"""WITH {E_OBS}
SELECT seq, location, {EP} AS timestamp, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(minute(ts) AS INTEGER) AS minute, temperature, wind, humidity, weather FROM e"""


def q_kafka_payload() -> str:
    return f"""WITH {E_OBS}
SELECT location AS key,
       CAST(to_json({{'location': location, 'datetime': {EP}, 'temp': temperature, 'wind': wind,
                     'humidity': humidity, 'weather': weather}}) AS VARCHAR) AS value
FROM e"""


def q_midnight_epoch() -> str:
    return f"WITH {E_OBS} SELECT seq, {EP} AS epoch, {EP} - ({EP} % 86400) AS midnight FROM e"


def q_daily_rollup_flat() -> str:
    return f"""WITH {E_OBS}, nf AS ({NESTED_FLAT}),
nd AS (SELECT * REPLACE (unix_date - unix_date % 86400 AS unix_date) FROM nf)
{daily_select('nd')}"""


def q_season_classify() -> str:
    return f"""WITH {season_cte()}
SELECT unix_date, year, month, season,
       CAST(CASE WHEN month >= 10 THEN year + 1 ELSE year END AS INTEGER) AS season_year FROM h_cal"""


def q_union_widening() -> str:
    return f"""WITH {H_FLAT}
SELECT dt, 'Max Temperature' AS measure, MAX(temp_max) AS value FROM h_flat GROUP BY dt
UNION ALL
SELECT dt, 'Max Humidity' AS measure, CAST(MAX(humidity) AS DOUBLE) AS value FROM h_flat GROUP BY dt"""


def q_table_ddl_cycle() -> str:
    return f"""WITH {season_cte()}
SELECT * EXCLUDE (d, month, season) FROM h_cal"""


LD = f"""ld AS (SELECT location, {EP} AS timestamp, temperature, wind, humidity, weather, seq, ts FROM e)"""


def q_upsert(old_before: str, new_from: str) -> str:
    return f"""WITH {E_OBS}, {LD},
u AS (SELECT * EXCLUDE (ts), 1 AS batch FROM ld WHERE ts < TIMESTAMP '{old_before}'
      UNION ALL
      SELECT * EXCLUDE (ts) REPLACE (temperature + 1.0 AS temperature), 2 AS batch
      FROM ld WHERE ts >= TIMESTAMP '{new_from}'),
r AS (SELECT *, row_number() OVER (PARTITION BY location, timestamp ORDER BY batch DESC, seq DESC) AS rn FROM u)
SELECT * EXCLUDE (rn) FROM r WHERE rn = 1"""


def q_ttl_filter(as_of: str) -> str:
    return f"""WITH {E_OBS}, {LD}
SELECT * EXCLUDE (ts) FROM ld WHERE ts > TIMESTAMP '{as_of}' - INTERVAL 1 DAY"""


def _label(x: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in INTERVAL_LABELS.items())
    return f"(CASE {x} {whens} ELSE 'Invalid interval' END)"


def _view(as_of: str) -> str:
    strip = "'().' || chr(39)"
    return f"""WITH {ends_cte()},
res AS ({TREND_SELECT} WHERE window_end <= TIMESTAMP '{as_of}'
        AND window_end > TIMESTAMP '{as_of}' - INTERVAL 1 DAY),
lt AS (SELECT *, row_number() OVER (PARTITION BY location, interval_s ORDER BY window_end DESC) AS rn FROM res)
SELECT translate(location, {strip}, '') AS location, {_label('interval_s')} AS interval, interval_s,
       window_end, actual_temperature, {r2('temperature_trend')} AS temperature_trend,
       {r2('actual_wind')} AS actual_wind, {r2('wind_trend')} AS wind_trend, actual_humidity,
       {r2('humidity_delta')} AS humidity_delta, weather
FROM lt WHERE rn = 1"""


def q_latest_trends_view(as_of: str) -> str:
    return _view(as_of)


def q_trends_view_json(as_of: str) -> str:
    return f"""WITH v AS ({_view(as_of)})
SELECT CAST(to_json({{'location': location, 'interval': interval, 'interval_s': interval_s,
        'actual_temperature': actual_temperature, 'temperature_trend': temperature_trend,
        'actual_wind': actual_wind, 'wind_trend': wind_trend, 'actual_humidity': actual_humidity,
        'humidity_delta': humidity_delta, 'weather': weather}}) AS VARCHAR) AS json FROM v"""


def q_observations_json() -> str:
    return f"""WITH {E_OBS}
SELECT CAST(to_json({{'location': location, 'time': {EP}, 'temperature': temperature, 'wind': wind,
        'humidity': humidity, 'weather': weather}}) AS VARCHAR) AS json FROM e"""


def q_stream_interval_trends(delay: str) -> str:
    return f"""WITH {ends_cte()}
{TREND_SELECT}
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {delay}"""


def q_stream_daily_rollup() -> str:
    return f"""WITH {E_OBS}, nf AS ({NESTED_FLAT}),
dd AS (SELECT * FROM nf QUALIFY row_number() OVER (PARTITION BY location, unix_date ORDER BY seq DESC) = 1),
nd AS (SELECT * REPLACE (unix_date - unix_date % 86400 AS unix_date) FROM dd)
{daily_select('nd')}"""


def q_bootstrap_then_daily(year: int) -> str:
    """Daily rows of E replace those of H; those of the redelivered year have a raised maximum."""
    return f"""WITH {H_DAILY}, e_daily AS (FROM ({q_stream_daily_rollup()})),
h_new AS (SELECT * REPLACE (max_temp + CASE WHEN year(make_timestamp(unix_date * 1000000)) = {year}
                            THEN 1000.0 ELSE 0.0 END AS max_temp) FROM h_daily)
SELECT * FROM h_new WHERE unix_date NOT IN (SELECT unix_date FROM e_daily)
UNION ALL BY NAME SELECT * FROM e_daily"""


def q_registered_after_upsert(dropped_year: int) -> str:
    """Daily rows of E replace those of H; one year is gone."""
    return f"""WITH {H_DAILY}, e_daily AS (FROM ({q_stream_daily_rollup()}))
SELECT * FROM (SELECT * FROM h_daily WHERE unix_date NOT IN (SELECT unix_date FROM e_daily)
UNION ALL BY NAME SELECT * FROM e_daily) WHERE year(make_timestamp(unix_date * 1000000)) <> {dropped_year}"""


E_LINE = f"""
e AS (
  SELECT 'station-' || CAST(user_id % 5 AS VARCHAR) AS location, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS ts,
         event_id AS seq, value AS temperature, CAST(user_id % 20 AS DOUBLE) AS wind,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity, event_type AS weather
  FROM events)"""


def q_stream_location_data() -> str:
    return f"""WITH {E_LINE}
SELECT location, {EP} AS timestamp, temperature, wind, humidity, weather FROM e
QUALIFY row_number() OVER (PARTITION BY location, {EP} ORDER BY seq DESC) = 1"""


def q_stored_observations_json() -> str:
    return f"""SELECT CAST(to_json({{'location': location, 'time': timestamp, 'temperature': temperature, 'wind': wind,
        'humidity': humidity, 'weather': weather}}) AS VARCHAR) AS json FROM ({q_stream_location_data()})"""


def q_stream_line_trends(delay: str) -> str:
    return f"""WITH {ends_cte().replace(E_OBS, E_LINE)}
{TREND_SELECT}
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {delay}"""


def q_stream_rejects() -> str:
    return """SELECT 'lines' AS source, 'junk ' || event_id AS value FROM events WHERE event_type = 'error'
UNION ALL SELECT 'messages', '{"dt": ' || event_id FROM events WHERE event_type = 'error'"""


def q_season_products(season: str) -> str:
    return f"""SELECT 'records' AS product, *, CAST(NULL AS DOUBLE) AS trend FROM ({q_records('extreme', season)})
UNION ALL BY NAME SELECT 'trends' AS product, * FROM ({q_yearly_trend(season=season, with_has_prev=False)})"""


def q_season_year() -> str:
    return f"""WITH {season_cte(split_summer=True)}
SELECT unix_date, season, year AS season_year FROM h_cal"""


def q_epoch_cast() -> str:
    return f"WITH {E_LINE} SELECT seq, {EP} AS epoch FROM e"


def q_line_split() -> str:
    return f"""WITH {E_LINE}
SELECT seq, CAST(8 AS INTEGER) AS n_fields, chr(39) || location || chr(39) AS location, CAST({EP} AS VARCHAR) AS epoch,
       chr(39) || weather || chr(39) AS weather FROM e"""


def q_celsius() -> str:
    return f"""WITH {E_LINE}
SELECT seq, CASE seq % 4 WHEN 0 THEN temperature - 273.15::DOUBLE
                         WHEN 1 THEN (temperature - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE
                         WHEN 2 THEN temperature END AS celsius FROM e"""
