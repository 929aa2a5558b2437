"""Speed layer: sliding first/last windows and trends (hand-written rows, brute force, forms)."""

import datetime as dt

from pyspark.sql import functions as F

from obslake import fixtures
from obslake.operators import windows
from obslake.schemas import OBSERVATION
from conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION)


def _row(loc, sec, seq, temp=1.0, wind=1.0, hum=1.0, weather="Clouds"):
    return (loc, T0 + dt.timedelta(seconds=sec), seq, temp, wind, hum, weather)


def test_zero_start_gives_null_trend(spark):
    df = _obs(spark, [_row("A", 5, 1, wind=0.0), _row("A", 20, 2, wind=5.0)])
    tr = windows.interval_trends(windows.window_ends(df, (60,))).collect()
    assert len(tr) == 1
    assert tr[0].wind_trend is None and tr[0].humidity_delta == 0.0 and tr[0].actual_wind == 5.0


def test_equal_timestamps_tie_break(spark):
    df = _obs(spark, [_row("A", 10, 2, temp=2.0), _row("A", 10, 1, temp=1.0)])
    e = windows.flat_ends(windows.window_ends(df, (60,))).collect()
    assert [(r.first_seq, r.last_seq) for r in e] == [(1, 2)]


def test_single_row_window_and_absent_location(spark):
    df = _obs(spark, [_row("A", 10, 1, temp=3.0), _row("B", 3600, 2)])
    tr = windows.interval_trends(windows.window_ends(df, (60,))).collect()
    by = {(r.location, r.window_end) for r in tr}
    assert by == {("A", T0 + dt.timedelta(seconds=60)), ("B", T0 + dt.timedelta(seconds=3660))}
    a = [r for r in tr if r.location == "A"][0]
    assert (a.temperature_trend, a.wind_trend, a.humidity_delta) == (0.0, 0.0, 0.0)


def _brute(rows, w):
    """Every window end from the definition: [end - w, end), ends on the minute grid."""
    out = {}
    for loc, ts, seq, *_ in rows:
        sec = int((ts - dt.datetime(1970, 1, 1)).total_seconds())
        p = sec - sec % 60
        for end in range(p + 60, p + w + 1, 60):
            k = (loc, end)
            lo, hi = out.get(k, ((ts, seq), (ts, seq)))
            out[k] = (min(lo, (ts, seq)), max(hi, (ts, seq)))
    return {(loc, end): (lo[1], hi[1]) for (loc, end), (lo, hi) in out.items()}


def test_matches_brute_force_on_small_table(spark):
    obs = fixtures.observations(spark, SF_SMALL)
    rows = [tuple(r) for r in obs.collect()]
    for w in (300, 3600, 21600):
        got = {(r.location, int((r.window_end - dt.datetime(1970, 1, 1)).total_seconds())): (r.first_seq, r.last_seq)
               for r in windows.flat_ends(windows.window_ends(obs, (w,))).collect()}
        assert got == _brute(rows, w), w


def test_forms_agree(spark):
    obs = fixtures.observations(spark, SF_SMALL)
    ivs = (60, 600, 3600)
    a = windows.flat_ends(windows.window_ends(obs, ivs))
    b = windows.flat_ends(windows.window_ends_join(obs, ivs))
    c = windows.flat_ends(windows.window_ends_panes(obs, ivs))
    d = None
    for w in ivs:
        x = windows.flat_ends(windows.window_ends_direct(obs, w))
        d = x if d is None else d.unionByName(x)
    for other in (b, c, d):
        assert a.exceptAll(other).count() == 0 and other.exceptAll(a).count() == 0


def test_hot_location_spread_over_buckets(spark):
    """Neighbour windows are partitioned by (location, day): one location over many days
    gives many partitions, not one."""
    obs = fixtures.observations(spark, SF_SMALL)
    one = obs.withColumn("location", F.lit("hot"))
    bp = windows.bucketed_panes(windows.panes(one))
    assert bp.select("ebucket").distinct().count() > 20
    biggest = bp.groupBy("location", "ebucket").count().agg(F.max("count")).first()[0]
    assert biggest <= 1440 + 360
    ref = windows.window_ends_panes(one, (3600,))
    assert windows.window_ends(one, (3600,)).exceptAll(ref).count() == 0


def _widest_expand(df):
    found, todo = 0, [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Expand":
            found = max(found, node.projections().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_direct_windows_do_not_expand_rows_into_all_windows(spark):
    """6 h windows: 20 and 18 rows a pane, not 360 a row; the same windows, at bucket edges, before
    the epoch, with null locations, equal rows and slides that do not divide the window."""
    secs = [*range(0, 900, 7), 86399, 86400, 86400 - 21600, 3 * 86400 + 59, -(1 << 33), 5, 5]
    rows = [_row(loc, s, i % 40) for i, s in enumerate(secs) for loc in ("A", None)]
    obs = _obs(spark, rows)
    assert _widest_expand(windows.window_ends_direct(obs, 21600)) <= 20
    got, want = windows.window_ends_direct(obs, 21600), windows.window_ends_panes(obs, (21600,))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    for w, slide in ((420, 60), (60, 60), (90, 60), (100, 50)):
        win = F.window("ts", f"{w} seconds", f"{slide} seconds")
        rec = windows.record()
        want = obs.groupBy("location", win.alias("w")).agg(F.min(rec).alias("first_rec"), F.max(rec).alias("last_rec")) \
            .select("location", F.lit(w).alias("interval_s"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "first_rec", "last_rec")
        got = windows.window_ends_direct(obs, w, slide)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_partitions_add_two_rows_to_a_window(spark):
    """Partial windows, kept rows passed on early or late, give the same windows; ties on (ts, seq), null
    seq and location, NaN and null values included; rows of a window are not multiplied."""
    import itertools

    times = [*range(0, 600, 3), 3600, 3601, 90000]
    rows = [(loc, T0 + dt.timedelta(seconds=s), seq, temp, None, float(s % 7), "x")
            for s, (loc, seq, temp) in zip(times * 8, itertools.cycle(itertools.product(
                ("A", "B", None), (1, 2, None), (1.0, None, float("nan")))))] + [("A", None, 1, 1.0, 1.0, 1.0, "x")]
    obs = _obs(spark, rows).repartition(3)
    want = windows.window_ends(obs.where("ts is not null"), (60, 21600)).withColumn("end_s", F.unix_seconds(F.col("window_end").cast("timestamp")))
    cols = ["location", "interval_s", "end_s", "first_rec", "last_rec"]
    for most in (1, 64, 1 << 17):
        part = windows.partial_window_ends(obs, (60, 21600), most=most)
        got = part.groupBy("location", "interval_s", "end_s").agg(F.min("first_rec").alias("first_rec"), F.max("last_rec").alias("last_rec"))
        assert got.count() > 0 and got.select(cols).exceptAll(want.select(cols)).count() == 0
        assert want.select(cols).exceptAll(got.select(cols)).count() == 0
    dense = _obs(spark, [_row("A", s / 100, s) for s in range(0, 30000)]).coalesce(1)
    part = windows.partial_window_ends(dense, (21600,))
    assert part.count() == 2 * part.select("end_s").distinct().count()
