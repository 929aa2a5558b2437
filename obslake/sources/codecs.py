"""Message and line codecs (P2-P4, P11-P18, S11, S18) as column expressions.

All decoding is from_json / get_json_object / regexp_extract inside the JVM; a stream of
millions of messages never reaches a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.columns import local_hour, local_minute, to_double
from obslake.schemas import MESSAGE, OBS_NESTED

CORRUPT = "_corrupt_record"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unwrap_json(value) -> Column:
    """JSON text that may be encoded twice (a JSON string holding the object) -> the object's
    text. get_json_object(v, '$') returns the inner text for a JSON string and the object itself
    otherwise, so single- and double-encoded input decode alike."""
    v = _c(value)
    return F.coalesce(F.get_json_object(v, "$"), v)


def decode(value, schema: T.StructType = OBS_NESTED, double_encoded: bool = True) -> Column:
    """JSON text -> struct with a declared schema (no inference)."""
    v = unwrap_json(value) if double_encoded else _c(value)
    return F.from_json(v, schema)


def once(x: Column) -> Column:
    """A costly value as a row of its own: filters on it stay behind it, while in a plain select the
    optimizer copies it into each of them."""
    return F.explode(F.array(x))


def decode_permissive(value, schema: T.StructType = MESSAGE) -> Column:
    """PERMISSIVE decode; malformed text lands in `_corrupt_record`, the rest is null."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(_c(value), with_corrupt,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def split_rejects(df: DataFrame, value: str = "value", schema: T.StructType = MESSAGE):
    """(good, rejects). Both are lazy projections of one decode; nothing is collected."""
    parsed = df.withColumn("_m", decode_permissive(value, schema))
    bad = F.col(f"_m.{CORRUPT}").isNotNull()
    good = parsed.filter(~bad).select(*[c for c in df.columns if c != value], "_m.*").drop(CORRUPT)
    rejects = parsed.filter(bad).select(*[c for c in df.columns if c != value],
                                        F.col(value).alias("raw"))
    return good, rejects


def first_weather(weather_arr) -> Column:
    """Main text of the first element of an array of weather structs; null when empty."""
    return F.get(_c(weather_arr), 0)["main"]


# Nested record -> raw-observation row (struct flatten + fixed order + renames).
RAW_COLUMNS = ("temp", "temp_min", "temp_max", "pressure", "humidity", "speed", "deg", "all", "dt")
RAW_RENAMES = {"dt": "unix_date", "all": "clouds"}


def flatten_record(rec_df: DataFrame, rec: str = "r", keep: tuple[str, ...] = ()) -> DataFrame:
    """Main.*, wind.*, clouds.* and dt side by side; P3: fixed column subset and order;
    P4: logical -> physical names. Values widen to double (Q2). `keep` columns pass through."""
    wide = rec_df.select(*keep, f"{rec}.main.*", f"{rec}.wind.*", f"{rec}.clouds.*",
                         F.col(f"{rec}.dt").alias("dt"))
    sub = wide.select(*keep, *RAW_COLUMNS)
    return sub.select(*keep, *[F.col(c).cast("long" if c == "dt" else "double").alias(RAW_RENAMES.get(c, c))
                               for c in RAW_COLUMNS])


def raw_observations(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P2-P4, P14 for broker messages (seq, value): raw-observation rows with the station's name as
    `location` and the arrival order `seq`; `keep` columns pass through. A message that is no record
    has a null unix_date."""
    rec = messages.select("seq", *keep, decode("value").alias("r"))
    return flatten_record(rec.withColumn("location", F.col("r.name")), "r", keep=("location", "seq", *keep))


def arrival(df: DataFrame) -> Column:
    """Q19: the order in which the rows of one delivery arrived: the broker's `offset` (one station
    writes to one topic partition), else a `seq` column, else the file that brought them (`landed`, see
    `line_stream`) and the place in it, else the place in the delivery."""
    for c in ("offset", "seq"):
        if c in df.columns:
            return F.col(c).cast("long")
    place = F.monotonically_increasing_id()
    return F.struct("landed", place.alias("place")) if "landed" in df.columns else place


def line_stream(spark, path: str, max_files: int | None = None) -> DataFrame:
    """A landing folder of text files as a stream of lines (`value`), each with the time, path and
    block of its file (`landed`), by which lines without offsets are put in the order of arrival."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    m = F.col("_metadata")
    return r.load(path).select("value", F.struct(
        m["file_modification_time"].alias("time"), m["file_path"].alias("path"), m["file_block_start"].alias("block")).alias("landed"))


# 0001-01-01 and 9999-12-31T23:59:59, the epochs that are dates
MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300799


def is_epoch(epoch_s) -> Column:
    """Whether whole seconds are a date that can be stored; false for null."""
    return F.coalesce(_c(epoch_s).between(MIN_EPOCH, MAX_EPOCH), F.lit(False))


# --- text lines (P16, P17) -------------------------------------------------------------------

# One line is the printed form of an 8-tuple:
# ('<location>', <epoch>, <hour>, <minute>, <temp>, <wind>, <humidity>, '<weather>')
# Strings are quoted with ' (or " when the text holds a ').
_Q = r"""(['"])(.*?)\{n}"""
LINE_PATTERN = (r"^\(\s*" + _Q.format(n=1) + r"\s*,\s*(-?\d+)\s*,\s*(-?\d+)\s*,\s*(-?\d+)\s*,"
                r"\s*([^,]*?)\s*,\s*([^,]*?)\s*,\s*([^,]*?)\s*,\s*" + _Q.format(n=9) + r"\s*\)\s*$")


def parse_line(value="value") -> Column:
    """P16 + F14: typed struct from a tuple line. Names keep inner blanks and commas (Q20);
    quote marks are dropped; numbers that do not parse become null.

    The line is matched once: the six numbers, which hold no comma, are put before the two texts, which
    hold no line feed."""
    return parse_matched(value, matched(value))


def matched(value="value") -> Column:
    """A tuple line put in the order that `parse_matched` takes; another line as it is."""
    return F.regexp_replace(_c(value), LINE_PATTERN, "$3,$4,$5,$6,$7,$8,$2\n$10")


def parse_matched(value, r) -> Column:
    """`parse_line` of a line that was matched already (r)."""
    v, r = _c(value), _c(r)
    p = F.split(r, ",", 7)
    texts = F.get(p, 6)
    return F.when(r != v, F.struct(  # a line that does not match is left as it is
        F.substring_index(texts, "\n", 1).alias("location"),
        F.get(p, 0).try_cast("long").alias("timestamp"),
        F.get(p, 1).try_cast("int").alias("hour"),
        F.get(p, 2).try_cast("int").alias("minute"),
        to_double(F.get(p, 3)).alias("temperature"),
        to_double(F.get(p, 4)).alias("wind"),
        to_double(F.get(p, 5)).alias("humidity"),
        F.substring_index(texts, "\n", -1).alias("weather"),
    ))


def _quoted(s) -> Column:
    c = _c(s)
    dq = F.instr(c, "'") > 0
    return F.when(dq, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.concat(F.lit("'"), c, F.lit("'")))


def format_line(location, epoch, temperature, wind, humidity, weather) -> Column:
    """The tuple line for one observation; hour and minute from the epoch (session zone)."""
    e = _c(epoch)
    return F.concat(
        F.lit("("), _quoted(location), F.lit(", "), e.cast("string"), F.lit(", "),
        local_hour(e).cast("string"), F.lit(", "), local_minute(e).cast("string"), F.lit(", "),
        _c(temperature).cast("string"), F.lit(", "), _c(wind).cast("string"), F.lit(", "),
        _c(humidity).cast("string"), F.lit(", "), _quoted(weather), F.lit(")"))


def to_payload(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows -> (key, value) JSON text, the shape a Kafka or file sink takes."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), value.alias("value"))
