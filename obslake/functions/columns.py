"""Column functions (F1-F22). Every function returns a built-in Spark expression, so it stays
inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake.schemas import (DAY_S, INTERVAL_LABELS, INVALID_INTERVAL, WINTER_END_MONTH,
                             WINTER_FIRST_MONTH)

ColOrName = Column | str


def _c(x: ColOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- dates and epochs (F1-F6, F15, F16, F22) --------------------------------------------

def iso_day(dt_iso: ColOrName) -> Column:
    """first ten characters of an ISO-like stamp as a date (position 0 acts as 1).
    Dirty text yields null instead of failing the job."""
    return F.try_to_date(F.substring(_c(dt_iso), 0, 10), "yyyy-MM-dd")


def day_epoch(day: ColOrName) -> Column:
    """midnight of a date as epoch seconds (session zone is UTC)."""
    return F.unix_timestamp(_c(day).cast("timestamp"))


def midnight_epoch(epoch_s: ColOrName) -> Column:
    """truncate epoch seconds to midnight UTC. Same result as the
    from_unixtime -> to_date -> unix_timestamp chain under UTC, without the string round trip."""
    e = _c(epoch_s).cast("long")
    return e - F.pmod(e, F.lit(DAY_S))


def epoch_to_date(epoch_s: ColOrName) -> Column:
    """epoch seconds -> calendar date (UTC)."""
    return F.to_date(F.timestamp_seconds(_c(epoch_s)))


def epoch_seconds(ts: ColOrName) -> Column:
    """Seconds since the epoch of a timestamp or timestamp_ntz (read as UTC)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def local_hour(epoch_s: ColOrName) -> Column:
    """hour of an epoch in the session zone."""
    return F.hour(F.timestamp_seconds(_c(epoch_s)))


def local_minute(epoch_s: ColOrName) -> Column:
    """minute of an epoch in the session zone."""
    return F.minute(F.timestamp_seconds(_c(epoch_s)))


def to_epoch_long(x: ColOrName) -> Column:
    """F16: float epoch (number or text) -> whole seconds, truncating like int(); junk -> null."""
    return _c(x).try_cast("double").cast("long")


def now() -> Column:
    """processing time."""
    return F.current_timestamp()


# --- seasons (F7, F8, F20, P10) ---------------------------------------------------------

def is_winter_month(month: ColOrName, start: int = WINTER_FIRST_MONTH,
                    end: int = WINTER_END_MONTH) -> Column:
    """P10: start <= month < end."""
    m = _c(month)
    return (m >= start) & (m < end)


def season(day: ColOrName, start: int = WINTER_FIRST_MONTH, end: int = WINTER_END_MONTH) -> Column:
    """F8: southern-hemisphere season of a date: months [start, end) winter, else summer."""
    return F.when(is_winter_month(F.month(_c(day)), start, end), F.lit("winter")).otherwise(F.lit("summer"))


def season_year(day: ColOrName, end: int = WINTER_END_MONTH) -> Column:
    """Q16 option: the year a summer belongs to when it spans the year change
    (October-December count to the next year). Winter keeps its calendar year."""
    d = _c(day)
    return F.when(F.month(d) >= end, F.year(d) + 1).otherwise(F.year(d))


def current_season(as_of: ColOrName | None = None) -> Column:
    """season of the clock date, or of a fixed date so results repeat."""
    return season(F.current_date() if as_of is None else F.to_date(_c(as_of)))


# --- arithmetic (F9-F13) ----------------------------------------------------------------

def r2(x: ColOrName) -> Column:
    """two-decimal rounding, HALF_UP on the decimal value."""
    return F.round(_c(x), 2)


UNITS = 100_000_000   # units of a value that are summed exactly: 1e-8
EXACT_BELOW = 1e7     # larger values have no exact 1e-8 units in a double
LOW_BITS = 24


def exact_mean(x: ColOrName, scale: int = 2) -> Column:
    """avg rounded HALF_UP to `scale` decimals, from an exact sum.

    A double sum depends on the order rows arrive in, i.e. on the partitioning; at a rounding
    half that flips the last digit. Here every value below ten million is taken in units of 1e-8 as
    a long (exact for inputs with up to 8 decimals), and the high and low bits are summed apart, so
    that neither sum overflows below some 1e11 rows a group. The sum is order-free, and the
    single division per group is done in decimal.

    Larger values, NaN and the infinities are added as doubles, as avg() does: a group with a NaN
    has a NaN mean (and a NaN max, the greatest double), one infinity makes the mean infinite, both
    make it NaN. Nulls are ignored; a group of nulls has a null mean.
    """
    v = _c(x).cast("double")
    exact = F.abs(v) < F.lit(EXACT_BELOW)  # false for NaN, which is greater than any number
    units = F.when(exact, F.rint(v * F.lit(float(UNITS))).cast("long"))
    high = F.sum(F.shiftright(units, LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    rest = F.sum(F.when(~exact, v))
    total = high.cast("decimal(28,0)") * F.lit(1 << LOW_BITS).cast("decimal(9,0)") + low.cast("decimal(20,0)")
    n = F.count(v)
    mean_units = total.cast("decimal(38,8)") / n.cast("decimal(20,0)")
    mean = F.round(mean_units, scale - 8).cast("double") / F.lit(float(UNITS))
    sum_all = F.coalesce(total.cast("double") / F.lit(float(UNITS)), F.lit(0.0)) + rest
    return F.when(rest.isNull(), mean).otherwise(F.round(sum_all / n, scale))


def pct_change(now_v: ColOrName, start_v: ColOrName, signed: bool = False) -> Column:
    """(now - start) / start * 100. signed=True divides by the signed start (speed
    layer), signed=False by |start| (history trends). Zero start gives null, not an error (Q8)."""
    s = _c(start_v)
    return F.try_divide(_c(now_v) - s, s if signed else F.abs(s)) * F.lit(100.0)


def delta(now_v: ColOrName, start_v: ColOrName) -> Column:
    """absolute change."""
    return _c(now_v) - _c(start_v)


def yearly_trend_pct(value: ColOrName, prev: ColOrName) -> Column:
    """round(pct_change(value, prev, |prev|), 2); 0.0 when there is no previous value or it
    is zero (Q9: kept for compatibility, `has_prev` tells the two apart)."""
    return F.coalesce(r2(pct_change(value, prev, signed=False)), F.lit(0.0))


# --- text (F14, F17-F19) ----------------------------------------------------------------

def to_double(s: ColOrName) -> Column:
    """numeric cast that yields null on junk."""
    return _c(s).try_cast("double")


def strip_outer(s: ColOrName) -> Column:
    """drop first and last character."""
    c = _c(s)
    return F.substring(c, F.lit(2), F.length(c) - F.lit(2))


def interval_label(interval_s: ColOrName) -> Column:
    """60 -> '1 m', ..., 21600 -> '6 h'; anything else 'Invalid interval'.
    A six-entry literal map inside the expression; no join, no broadcast."""
    m = F.create_map(*[x for k, v in INTERVAL_LABELS.items() for x in (F.lit(str(k)), F.lit(v))])
    return F.coalesce(F.try_element_at(m, _c(interval_s).cast("string")), F.lit(INVALID_INTERVAL))


def clean_location(s: ColOrName) -> Column:
    """delete ( ) . and ' from a location name."""
    return F.translate(_c(s), "().'", "")


def to_celsius(temp: ColOrName, unit: ColOrName) -> Column:
    """Q13: live messages carry Kelvin, history Celsius; a `unit` column travels with the value
    and this converts on request ('K', 'F' or 'C'; unknown units give null)."""
    t, u = _c(temp), F.upper(_c(unit))
    return (F.when(u == "C", t)
            .when(u == "K", t - F.lit(273.15))
            .when(u == "F", (t - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)))
