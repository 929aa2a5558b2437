"""First and last observation per location over sliding windows, and the
interval trends derived from them.

Windows are [end - W, end) with ends on the minute grid, sliding by one minute, as
`window(ts, W, '60 seconds')` defines them. Ties on ts are broken by seq: first is the lowest
(ts, seq), last the highest (Q19). Only non-empty windows produce rows (Q6).

Scale design ("gap-bounded emission"). Exploding every row into its W/60 windows multiplies the
input by 360 for the 6 h window (466 over all six). Instead:

1. panes: one row per (location, minute) with min(struct) and max(struct) of its rows
   (partial aggregation before the shuffle);
2. end buckets: each pane is copied to the day bucket(s) whose window ends it can reach (one,
   or two for panes within W of midnight) and gets its previous and next pane there, with a
   window partitioned by (location, end bucket). No partition holds more than one bucket of
   one location (<= 1,440 + 360 panes), however hot the location is;
3. every window end is emitted exactly twice: once by its last pane p (ends in
   (p, min(p + W, next_p)]) and once by its first pane q (ends in (max(prev_q + W, q), q + W]);
4. an aggregate inside the same (location, end bucket) partitioning pairs the two: no further
   exchange.

Work is proportional to the number of result rows, not rows x W/60, and only panes are shuffled.
The pane-explode form (`window_ends_panes`) and the window() form (`window_ends_direct`)
are kept: they give the same rows and are what a streaming aggregation can run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.columns import delta, pct_change
from obslake.schemas import DAY_S, INTERVALS, SLIDE_S

REC_FIELDS = ("ts", "seq", "temperature", "wind", "humidity", "weather")


def record(fields: tuple[str, ...] = REC_FIELDS) -> Column:
    """G4/G5 ordering key + payload: struct ordering compares ts, then seq, so min/max of it
    are arg-min/arg-max by (ts, seq) and need no second pass."""
    return F.struct(*[F.col(f) for f in fields])


def _epoch_s(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def panes(obs: DataFrame, slide_s: int = SLIDE_S, fields: tuple[str, ...] = REC_FIELDS) -> DataFrame:
    """Tumbling panes of slide_s seconds per location: first and last record of each."""
    rec = record(fields)
    pane = _epoch_s(F.col("ts")) - F.pmod(_epoch_s(F.col("ts")), F.lit(slide_s))
    return (obs.groupBy("location", pane.alias("pane"))
            .agg(F.min(rec).alias("first_rec"), F.max(rec).alias("last_rec")))


def _bucket_for(intervals, slide_s: int = SLIDE_S) -> int:
    """End-bucket length: at least a day and the longest window, a multiple of the slide so
    bucket edges sit on the grid of window ends."""
    b = max(DAY_S, max(intervals))
    return ((b + slide_s - 1) // slide_s) * slide_s


def _finish(df: DataFrame) -> DataFrame:
    return df.select("location", "interval_s",
                     F.timestamp_seconds("end_s").cast("timestamp_ntz").alias("window_end"),
                     "first_rec", "last_rec")


def _to_buckets(pn: DataFrame, longest_s: int, bucket_s: int) -> DataFrame:
    """Panes with each `ebucket` (end bucket) that windows of up to longest_s reach from them."""
    b0 = F.floor(F.col("pane") / F.lit(bucket_s)).cast("long")
    copies = F.when(F.col("pane") >= (b0 + 1) * bucket_s - longest_s, F.array(b0, b0 + 1)).otherwise(F.array(b0))
    return pn.withColumn("ebucket", F.explode(copies))


def bucketed_panes(pn: DataFrame, intervals=INTERVALS, slide_s: int = SLIDE_S) -> DataFrame:
    """Panes laid out by the bucket of the window ends they can reach.

    A pane p reaches ends in (p, p + W]; with bucket length B >= W these fall in bucket(p) and,
    for panes within W of the bucket's end, in bucket(p) + 1. Each pane is copied to those one
    or two end buckets (extra volume W/B, 25 % for 6 h windows in day buckets) and gets its
    previous / next pane inside the end bucket. Everything an end needs is then in its own
    (location, end bucket) partition, however hot the location."""
    x = _to_buckets(pn, max(intervals), _bucket_for(intervals, slide_s))
    w = Window.partitionBy("location", "ebucket").orderBy("pane")
    return (x.withColumn("prev_pane", F.lag("pane").over(w))
            .withColumn("next_pane", F.lead("pane").over(w)))


def _emissions(pn: DataFrame, intervals, slide_s: int, ends: tuple[int, int] | None = None) -> DataFrame:
    """Both emissions of every pane for every interval, tagged is_last, in (location, end bucket)
    partitions: (location, ebucket, interval_s, end_s, is_last, first_rec, last_rec). With ends, only
    those of window ends in (ends[0], ends[1]]."""
    B = _bucket_for(intervals, slide_s)
    bp = bucketed_panes(pn, intervals, slide_s)
    base = bp.withColumn("interval_s", F.explode(F.array(*[F.lit(int(w)) for w in intervals])))
    p, w = F.col("pane"), F.col("interval_s").cast("long")
    step = F.lit(slide_s).cast("long")
    b_lo = F.col("ebucket") * B          # ends of this bucket: (b_lo, b_hi]
    b_hi = b_lo + B

    def seq(lo, hi):  # ends in (lo, hi], stepping by the slide; empty when lo >= hi
        return F.when(lo < hi, F.sequence(lo + step, hi, step)).otherwise(F.array().cast("array<long>"))

    lo, hi = (F.lit(x).cast("long") for x in ends or (-(1 << 62), 1 << 62))
    last_hi = F.least(p + w, F.coalesce(F.col("next_pane"), p + w), b_hi)
    first_lo = F.greatest(F.coalesce(F.col("prev_pane") + w, p), p, b_lo)
    tagged = F.concat(
        F.transform(seq(F.greatest(p, b_lo, lo), F.least(last_hi, hi)),
                    lambda e: F.struct(e.alias("end_s"), F.lit(True).alias("is_last"))),
        F.transform(seq(F.greatest(first_lo, lo), F.least(p + w, b_hi, hi)),
                    lambda e: F.struct(e.alias("end_s"), F.lit(False).alias("is_last"))))
    return base.select("location", "ebucket", "interval_s", F.inline(tagged), "first_rec", "last_rec")


def window_ends(obs: DataFrame | None, intervals=INTERVALS, slide_s: int = SLIDE_S,
                pn: DataFrame | None = None, ends: tuple[int, int] | None = None) -> DataFrame:
    """(location, interval_s, window_end, first_rec, last_rec) for every non-empty window;
    default form. Panes are shuffled once to their (location, end bucket); both emissions come
    out of one explode and are paired by an aggregate inside that same partitioning, so after
    the pane stage there is exactly one exchange and no result-sized shuffle.
    Pass `pn` (location, pane, first_rec, last_rec) to start from stored panes, `ends` (epoch seconds
    on the slide's grid) for the windows that end after the first and by the second alone."""
    em = _emissions(panes(obs, slide_s) if pn is None else pn, intervals, slide_s, ends)
    paired = em.groupBy("location", "ebucket", "interval_s", "end_s").agg(
        F.min(F.when(~F.col("is_last"), F.col("first_rec"))).alias("first_rec"),
        F.max(F.when(F.col("is_last"), F.col("last_rec"))).alias("last_rec"))
    return _finish(paired)


def window_ends_join(obs: DataFrame, intervals=INTERVALS, slide_s: int = SLIDE_S) -> DataFrame:
    """The same pairs as an inner equi-join window-last |x| window-first on
    (location, end bucket, interval, end). Both sides are result-sized with one row per key, so
    no key can be hot; the records travel as flat columns through explode and join."""
    em = _emissions(panes(obs, slide_s), intervals, slide_s)
    keys = ["location", "ebucket", "interval_s", "end_s"]
    flat = em.select(*keys, "is_last",
                     *[F.col("last_rec")[f].alias(f"l_{f}") for f in REC_FIELDS],
                     *[F.col("first_rec")[f].alias(f"f_{f}") for f in REC_FIELDS])
    last = flat.filter(F.col("is_last")).select(*keys, *[f"l_{f}" for f in REC_FIELDS])
    first = flat.filter(~F.col("is_last")).select(*keys, *[f"f_{f}" for f in REC_FIELDS])
    # a merge join: both sides grow with the result, which size estimates do not show
    j = last.hint("merge").join(first, keys, "inner")
    return _finish(j.select(*keys,
                            F.struct(*[F.col(f"f_{f}").alias(f) for f in REC_FIELDS]).alias("first_rec"),
                            F.struct(*[F.col(f"l_{f}").alias(f) for f in REC_FIELDS]).alias("last_rec")))


def window_ends_panes(obs: DataFrame, intervals=INTERVALS, slide_s: int = SLIDE_S) -> DataFrame:
    """Section 4.3 form: panes, then each pane is copied into the W/slide windows that contain it.
    Same rows; volume grows with panes x W/slide. This is what a streaming aggregation runs."""
    pn = panes(obs, slide_s).withColumn(
        "interval_s", F.explode(F.array(*[F.lit(int(w)) for w in intervals])))
    p, w = F.col("pane"), F.col("interval_s").cast("long")
    step = F.lit(slide_s).cast("long")
    ex = pn.withColumn("end_s", F.explode(F.sequence(p + step, p + w, step)))
    paired = ex.groupBy("location", "interval_s", "end_s").agg(
        F.min("first_rec").alias("first_rec"), F.max("last_rec").alias("last_rec"))
    return _finish(paired)


def _hop(n: int) -> int:
    """The smallest divisor of n that is its square root or more."""
    return next(d for d in range(max(1, math.isqrt(n - 1) + 1), n + 1) if n % d == 0)


def window_ends_direct(obs: DataFrame, interval_s: int, slide_s: int = SLIDE_S,
                       fields: tuple[str, ...] = REC_FIELDS) -> DataFrame:
    """T3/T4 as Spark's window(): groupBy(location, window(ts, W, slide)). Works on streaming
    DataFrames (with a watermark on ts) in update or append mode; there, and where the slide does not
    divide W, every row joins all its windows.

    In batch, panes stand for the rows, and window() is applied twice: to windows of a hop (a
    divisor of W near W's square root in slides) every slide, then to windows of W every hop over the
    ends of those, apart for each phase of an end within the hop. A 6 h window then takes 20 + 18 rows a
    pane in place of 360 a row. Panes are copied to the end buckets they reach, so both aggregates
    stay in the (location, end bucket) partitions of one exchange of panes."""
    rec = record(fields)
    if obs.isStreaming or interval_s % slide_s:
        win = F.window("ts", f"{interval_s} seconds", f"{slide_s} seconds")
        g = obs.groupBy("location", win.alias("w")).agg(F.min(rec).alias("first_rec"),
                                                       F.max(rec).alias("last_rec"))
        return g.select("location", F.lit(int(interval_s)).alias("interval_s"),
                        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "first_rec", "last_rec")
    hop = _hop(interval_s // slide_s) * slide_s
    B = _bucket_for((interval_s,), slide_s)
    place = ["location", "ebucket"]
    first, last = F.min("first_rec").alias("first_rec"), F.max("last_rec").alias("last_rec")

    def ends(d: DataFrame, at: str, by: list[str], length: int, slide: int) -> DataFrame:
        """End (epoch seconds) of the windows of these rows, which begin at `at`."""
        w = F.window(F.timestamp_seconds(at), f"{length} seconds", f"{slide} seconds")
        g = d.groupBy(*place, *by, w.alias("w")).agg(first, last)
        return g.select(*place, *by, F.unix_seconds("w.end").alias("end_s"), "first_rec", "last_rec")

    pn = _to_buckets(panes(obs, slide_s, fields), interval_s, B).repartition(*place)
    e = ends(pn, "pane", [], hop, slide_s)
    if hop < interval_s:
        # of one phase, windows of a hop begin on a grid of hops: the next windows' slide
        phase = F.pmod("end_s", F.lit(hop))
        e = ends(e.withColumn("phase", phase).withColumn("start_s", F.col("end_s") - F.col("phase") - hop),
                 "start_s", ["phase"], interval_s, hop).withColumn("end_s", F.col("end_s") + F.col("phase"))
    lo = F.col("ebucket") * B
    e = e.where((F.col("end_s") > lo) & (F.col("end_s") <= lo + B))
    return _finish(e.withColumn("interval_s", F.lit(int(interval_s))))


def _bounds(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Rows of t (location, pane, us, seq) by location, pane and time: their order, which of them begin
    a pane, and which have its least and its greatest (us, seq); a null seq is the least."""
    loc = t.column("location").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    pane, us, seq = (t.column(c).combine_chunks().fill_null(-(1 << 63)).to_numpy() for c in ("pane", "us", "seq"))
    order = np.lexsort((seq, us, pane, loc))
    loc, pane, us, seq = loc[order], pane[order], us[order], seq[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(loc) != 0) | (np.diff(pane) != 0)
    heads = np.flatnonzero(new)
    sizes = np.diff(heads, append=len(order))
    same = [(us == np.repeat(us[at], sizes)) & (seq == np.repeat(seq[at], sizes)) for at in (heads, heads + sizes - 1)]
    return order, loc, pane, heads, sizes, *same


def _pane_ends(most: int):
    def reduced(t: pa.Table) -> pa.Table:
        order, _, _, _, _, first, last = _bounds(t)
        return t.take(order[first | last]).group_by(t.column_names).aggregate([]).select(t.column_names)

    def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
        order, loc, pane, heads, sizes, first, last = _bounds(t)
        one = np.append(loc[heads][1:] == loc[heads][:-1], False)  # whether the next pane is of the same location
        after = pa.array(np.repeat(np.append(pane[heads][1:], 0), sizes), mask=~np.repeat(one, sizes))
        before = pa.array(np.repeat(np.append(0, pane[heads][:-1]), sizes), mask=~np.repeat(np.append(False, one[:-1]), sizes))
        t = t.take(order)
        for name, c in (("prev_pane", before), ("next_pane", after), ("is_first", pa.array(first)), ("is_last", pa.array(last))):
            t = t.append_column(name, c)
        yield from t.to_batches(1 << 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, left = [], 0, 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= 2 * left + most:
                t = reduced(pa.Table.from_batches(held))
                if t.num_rows >= most:
                    yield from out(t)
                    t = t.slice(0, 0)
                held, n = t.to_batches(), t.num_rows
                left = n
        if n:
            yield from out(reduced(pa.Table.from_batches(held)))
    return run


def partial_window_ends(obs: DataFrame, intervals=INTERVALS, slide_s: int = SLIDE_S, most: int = 1 << 17) -> DataFrame:
    """(location, interval_s, end_s, first_rec, last_rec): what each input partition adds to the windows
    that its rows lie in, for an aggregate by min(first_rec) and max(last_rec). Without state or order,
    so a stream can run it before its own aggregate.

    A task keeps the first and the last rows of the panes it has met, rows that tie on (ts, seq)
    included, passes them on once there are `most`, and emits a window by its first pane and by its
    last one (`_emissions`): two rows a window, however many rows it holds."""
    d = obs.where("ts is not null").withColumn("pane", _epoch_s(F.col("ts")) - F.pmod(_epoch_s(F.col("ts")), F.lit(slide_s))) \
        .withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).select("location", *REC_FIELDS, "pane", "us")
    more = [T.StructField(n, t) for n, t in (("prev_pane", T.LongType()), ("next_pane", T.LongType()),
                                             ("is_first", T.BooleanType()), ("is_last", T.BooleanType()))]
    x = d.mapInArrow(_pane_ends(most), T.StructType([*d.schema.fields, *more]))
    x = x.withColumn("interval_s", F.explode(F.array(*[F.lit(int(w)) for w in intervals])))
    p, w, step = F.col("pane"), F.col("interval_s").cast("long"), F.lit(slide_s).cast("long")

    def seq(of, lo, hi, is_last):  # ends in (lo, hi]
        some = F.when(F.col(of) & (lo < hi), F.sequence(lo + step, hi, step)).otherwise(F.array().cast("array<long>"))
        return F.transform(some, lambda e: F.struct(e.alias("end_s"), F.lit(is_last).alias("ends")))

    tagged = F.concat(seq("is_last", p, F.least(p + w, F.coalesce("next_pane", p + w)), True),
                      seq("is_first", F.greatest(F.coalesce(F.col("prev_pane") + w, p), p), p + w, False))
    ex = x.select("location", "interval_s", F.inline(tagged), record().alias("rec"))
    return ex.select("location", "interval_s", "end_s", F.when(~F.col("ends"), F.col("rec")).alias("first_rec"),
                     F.when(F.col("ends"), F.col("rec")).alias("last_rec"))


def flat_ends(ends: DataFrame) -> DataFrame:
    """First and last record of each window as flat columns (T3/T4 output)."""
    f, l = F.col("first_rec"), F.col("last_rec")
    return ends.select("location", "interval_s", "window_end",
                       f["seq"].alias("first_seq"), f["ts"].cast("timestamp_ntz").alias("first_ts"),
                       l["seq"].alias("last_seq"), l["ts"].cast("timestamp_ntz").alias("last_ts"))


def interval_trends(ends: DataFrame, signed: bool = True) -> DataFrame:
    """T5: per (location, interval, window end): current values, temperature and wind percent
    change from the window's first record (signed start as on the live path, Q14; null on a zero
    start, Q8), humidity difference (Q15), weather of the last record."""
    f, l = F.col("first_rec"), F.col("last_rec")
    return ends.select(
        "location", "interval_s", "window_end",
        l["temperature"].alias("actual_temperature"),
        pct_change(l["temperature"], f["temperature"], signed).alias("temperature_trend"),
        l["wind"].alias("actual_wind"),
        pct_change(l["wind"], f["wind"], signed).alias("wind_trend"),
        l["humidity"].alias("actual_humidity"),
        delta(l["humidity"], f["humidity"]).alias("humidity_delta"),
        l["weather"].alias("weather"),
    )
