"""Streams equal batch (closed windows), replays are idempotent, jobs round-trip."""

import datetime as dt

from pyspark.sql import functions as F

from obslake import fixtures
from obslake.operators import windows
from obslake.plans import catalog
from obslake.sources import tables
from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_trends_equal_batch_on_closed_windows(spark):
    got = catalog.q_stream_interval_trends(spark, SF_SMALL)
    obs = fixtures.observations(spark, SF_SMALL)
    want = catalog._closed(windows.interval_trends(windows.window_ends(obs)), obs)
    assert got.count() > 0 and _same(got, want)


def test_live_update_mode_equals_batch_everywhere(spark):
    got = catalog.q_stream_live_trends(spark, SF_SMALL)
    want = windows.interval_trends(windows.window_ends(fixtures.observations(spark, SF_SMALL)))
    assert _same(got, want)


def test_stream_daily_equals_batch_daily(spark):
    got = catalog.q_stream_daily_rollup(spark, SF_SMALL)
    again = catalog.q_daily_incremental(spark, SF_SMALL)
    assert got.count() > 0 and _same(got, again)


def test_json_history_scan_equals_direct(spark):
    got = catalog.q_history_json_scan(spark, SF_SMALL)
    want = catalog.q_daily_rollup(spark, SF_SMALL)
    assert _same(got.select(*want.columns), want)


def test_products_read_back_per_season(spark):
    rec = catalog.q_records_job(spark, SF_SMALL)
    assert set(r.season for r in rec.collect()) == {"summer", "winter"}
    assert rec.filter(F.col("season") == "summer").count() == 6


def test_live_results_compaction_and_expiry(spark):
    from obslake.session import work_path
    from obslake.streaming import live

    root = work_path(spark, "t_expiry")
    obs = fixtures.observations(spark, SF_SMALL)
    src = f"{root}/input"
    catalog._stage_by_time(obs, src)
    lt = live.LiveTrends(root, watermark=catalog.STREAM_DELAY)
    lt.start(live.observation_stream(spark, src, catalog.OBSERVATION, max_files=10), trigger=None).awaitTermination()
    before = sorted(tuple(r) for r in lt.results(spark).collect())
    folders = lambda t: [e.part for e in t(spark).manifest().entries]
    assert len(folders(lt.results_table)) > len(set(folders(lt.results_table)))
    # compaction: one folder a day, same rows
    lt.compact_results(spark)
    assert len(folders(lt.results_table)) == len(set(folders(lt.results_table)))
    assert sorted(tuple(r) for r in lt.results(spark).collect()) == before
    # expiry: windows ended more than a day before as_of are gone
    as_of = "2024-01-29 00:00:00"
    cut = dt.datetime(2024, 1, 28)
    want = [r for r in before if r[2] > cut]
    lt.expire_results(spark, as_of)
    assert sorted(tuple(r) for r in lt.results(spark).collect()) == want
    # pane days older than lifetime + longest window are gone, recent ones stay
    days = sorted(int(d[4:]) for d in folders(lt.panes_table))
    assert days and days[0] >= (dt.date(2024, 1, 27) - dt.date(1970, 1, 1)).days - 1


def test_late_rows_are_merged_not_lost(spark):
    import datetime as dt

    from obslake.schemas import OBSERVATION
    from obslake.session import work_path
    from obslake.streaming import live

    root = work_path(spark, "t_late")
    t0 = dt.datetime(2024, 1, 2, 12, 0, 0)
    on_time = [("A", t0 + dt.timedelta(minutes=i), i, 1.0 + i, 1.0, 1.0, "x") for i in range(30)]
    late = [("A", t0 - dt.timedelta(hours=2), 100, 99.0, 1.0, 1.0, "late")]
    spark.createDataFrame(on_time, OBSERVATION).coalesce(1).write.parquet(f"{root}/in")
    spark.createDataFrame(late, OBSERVATION).coalesce(1).write.mode("append").parquet(f"{root}/in")
    lt = live.LiveTrends(root, intervals=(60, 300), watermark="10 minutes")
    q = lt.start(live.observation_stream(spark, f"{root}/in", OBSERVATION, max_files=1), trigger=None)
    q.awaitTermination()
    lt.finish(spark, q)
    assert live.late_rows(q) == 0  # behind the current watermark only: accepted
    # the late row is merged, not lost: closed windows equal a batch run over all delivered rows
    allrows = spark.createDataFrame(on_time + late, OBSERVATION)
    want = windows.interval_trends(windows.window_ends(allrows, (60, 300)))
    wm = F.lit(t0 + dt.timedelta(minutes=29) - dt.timedelta(minutes=10)).cast("timestamp_ntz")
    got = lt.results(spark).filter(F.col("window_end") <= wm)
    assert got.filter(F.col("weather") == "late").count() > 0
    assert _same(got, want.filter(F.col("window_end") <= wm))


def test_row_behind_previous_watermark_is_dropped_and_counted(spark):
    """A row for a minute that was closed by an earlier batch is dropped and counted."""
    import datetime as dt

    from obslake.schemas import OBSERVATION
    from obslake.session import work_path
    from obslake.streaming import live

    root = work_path(spark, "t_late2")
    t0 = dt.datetime(2024, 1, 2, 12, 0, 0)
    # file 1 and 2 close the 12:02 pane (stored by batch 1); file 3 brings a late row for it
    first = [("A", t0 + dt.timedelta(minutes=i, seconds=30), i, 10.0 + i, 1.0, 1.0, "x") for i in range(60)]
    late = [("A", t0 + dt.timedelta(minutes=2, seconds=1), 100, -5.0, 0.0, 1.0, "late")]
    spark.createDataFrame(first[:30], OBSERVATION).coalesce(1).write.parquet(f"{root}/in")
    spark.createDataFrame(first[30:], OBSERVATION).coalesce(1).write.mode("append").parquet(f"{root}/in")
    spark.createDataFrame(late, OBSERVATION).coalesce(1).write.mode("append").parquet(f"{root}/in")
    lt = live.LiveTrends(root, intervals=(60, 300), watermark="10 minutes")
    q = lt.start(live.observation_stream(spark, f"{root}/in", OBSERVATION, max_files=1), trigger=None)
    q.awaitTermination()
    lt.finish(spark, q)
    assert live.late_rows(q) == lt.late_rows(spark) == 1
    accepted = spark.createDataFrame(first, OBSERVATION)
    want = windows.interval_trends(windows.window_ends(accepted, (60, 300)))
    wm = F.lit(t0 + dt.timedelta(minutes=59, seconds=30) - dt.timedelta(minutes=10)).cast("timestamp_ntz")
    got = lt.results(spark).filter(F.col("window_end") <= wm)
    assert got.count() > 0 and _same(got, want.filter(F.col("window_end") <= wm))


def test_restart_from_checkpoint_equals_one_run(spark):
    """Stop after part of the input, restart on the same checkpoint with more files."""
    from obslake.session import work_path
    from obslake.streaming import live

    root = work_path(spark, "t_restart")
    obs = fixtures.observations(spark, SF_SMALL)
    src = f"{root}/input"
    mid = F.lit("2024-01-15 00:00:00").cast("timestamp")
    catalog._stage_by_time(obs.filter(F.col("ts") < mid), src)
    lt = live.LiveTrends(root, watermark=catalog.STREAM_DELAY)
    lt.start(live.observation_stream(spark, src, catalog.OBSERVATION, max_files=5), trigger=None).awaitTermination()
    catalog._stage_by_time(obs.filter(F.col("ts") >= mid), src)
    lt2 = live.LiveTrends(root, watermark=catalog.STREAM_DELAY)  # a new process: same folders
    q = lt2.start(live.observation_stream(spark, src, catalog.OBSERVATION, max_files=5), trigger=None)
    q.awaitTermination()
    lt2.finish(spark, q)
    got = catalog._closed(lt2.results(spark), obs)
    want = catalog._closed(windows.interval_trends(windows.window_ends(obs)), obs)
    assert _same(got, want)


def test_live_update_mode_from_panes_equals_batch_everywhere(spark):
    got = catalog.q_stream_live_trends_panes(spark, SF_SMALL)
    want = windows.interval_trends(windows.window_ends(fixtures.observations(spark, SF_SMALL)))
    assert _same(got, want)


def test_ingest_batch_replay_is_idempotent(spark):
    """A micro-batch delivered twice (same id) leaves raw and daily tables unchanged."""
    from obslake.session import work_path
    from obslake.streaming import live

    root = work_path(spark, "t_ingest_replay")
    msgs = fixtures.nested_messages(spark, SF_SMALL).select("seq", "value")
    ing = live.LiveIngest(root)
    ing.process_batch(msgs, 0)
    raw1 = sorted(tuple(r) for r in tables.read_table(spark, ing.raw_path).collect())
    daily1 = sorted(tuple(r) for r in ing.daily(spark).collect())
    ing.process_batch(msgs, 0)
    assert sorted(tuple(r) for r in tables.read_table(spark, ing.raw_path).collect()) == raw1
    assert sorted(tuple(r) for r in ing.daily(spark).collect()) == daily1
    assert daily1 == sorted(tuple(r) for r in catalog.q_stream_daily_rollup(spark, SF_SMALL).collect())


def test_trends_batch_replay_is_idempotent(spark):
    """The same closed panes delivered twice under one batch id give the same results."""
    from obslake.session import work_path
    from obslake.streaming import live

    lt = live.LiveTrends(work_path(spark, "t_trends_replay"), mode="update")
    obs = fixtures.observations(spark, SF_SMALL)
    pn = windows.panes(obs)
    lt.process_batch(pn, 0)
    first = sorted(tuple(r) for r in lt.results(spark).collect())
    lt.process_batch(pn, 0)
    assert sorted(tuple(r) for r in lt.results(spark).collect()) == first
    want = windows.interval_trends(windows.window_ends(obs))
    assert _same(lt.results(spark), want)


def test_location_data_batch_replay_is_idempotent(spark):
    """A replayed batch of tuple lines leaves location_data unchanged."""
    from obslake.session import work_path
    from obslake.streaming import live

    job = live.LiveLocationData(work_path(spark, "t_lines_replay"))
    lines = catalog._lines(spark, SF_SMALL).select("value")
    job.process_batch(lines, 0)
    first = sorted(tuple(r) for r in job.table(spark).collect())
    job.process_batch(lines, 0)
    assert first and sorted(tuple(r) for r in job.table(spark).collect()) == first


def _lines(spark, *rows):
    return spark.createDataFrame(list(rows), "value string, offset long")


def test_unreadable_first_batches_change_no_table(spark):
    """A first batch of junk is kept as rejects; later batches work; no table, no rows."""
    from obslake.session import work_path
    from obslake.streaming import live

    root = work_path(spark, "t_junk")
    job, ing, lt = live.LiveLocationData(root), live.LiveIngest(root), live.LiveTrends(root)
    assert lt.results(spark).count() == lt.trends_view(spark).count() == job.table(spark).count() == 0
    junk = _lines(spark, ("", 0), ("no tuple", 1), ("('A', 99999999999999, 0, 0, 1.0, 1.0, 1.0, 'x')", 2), (None, 3))
    for _ in range(2):  # replayed: the same rejects
        job.process_batch(junk, 0)
        ing.process_batch(junk, 0)
    assert job.rejects(spark).count() == ing.rejects(spark).count() == 4 and job.table(spark).count() == 0
    job.process_batch(_lines(spark, ("('A', 60, 0, 1, 2.0, 1.0, 1.0, 'x')", 4)), 1)
    ing.process_batch(_lines(spark, ('{"dt": 60, "name": "A", "main": {"temp": 2.0}}', 4)), 1)
    assert [r.temperature for r in job.table(spark).collect()] == [2.0]
    assert [r.avg_temp for r in tables.read_table(spark, ing.daily_path).collect()] == [2.0]


def test_location_data_does_not_depend_on_the_cut_of_batches(spark):
    """Q19: of two lines of one second the later arrival wins, in one batch and in two."""
    from obslake.session import work_path
    from obslake.streaming import live

    first = ("('A', 60, 0, 1, 9.0, 1.0, 1.0, 'x')", 1)
    second = ("('A', 60, 0, 1, 1.0, 1.0, 1.0, 'x')", 2)
    got = []
    for name, batches in (("one", [(second, first)]), ("two", [(first,), (second,)])):
        job = live.LiveLocationData(work_path(spark, f"t_cut_{name}"))
        for i, rows in enumerate(batches):
            job.process_batch(_lines(spark, *rows), i)
        got.append([r.temperature for r in job.table(spark).collect()])
    assert got == [[1.0], [1.0]]


def test_new_pane_of_one_location_writes_no_other(spark):
    """A batch rewrites the windows of the locations it touched; the stored view keeps the newest."""
    from obslake.schemas import OBSERVATION
    from obslake.session import work_path
    from obslake.streaming import live

    t0 = dt.datetime(2024, 1, 2, 12)
    obs = lambda locs, m, v: spark.createDataFrame(
        [(x, t0 + dt.timedelta(minutes=m), m, v, 1.0, 1.0, "x") for x in locs], OBSERVATION)
    lt = live.LiveTrends(work_path(spark, "t_touched"), intervals=(60, 300), mode="update")
    a, b, late = obs("ABC", 0, 1.0), obs("A", 1, 2.0), obs("B", -60, 5.0)
    for i, o in enumerate((a, b, late)):
        lt.process_batch(windows.panes(o), i)
    written = sorted({e.seq for e in lt.results_table(spark).manifest().entries})
    second = lt.results_table(spark).written(written[1])
    assert {r.location for r in second.collect()} == {"A"} and second.count() == 6
    every = a.unionByName(b).unionByName(late)
    assert _same(lt.results(spark), windows.interval_trends(windows.window_ends(every, (60, 300))))
    newest = {(r.location, r.interval_s): r.window_end for r in lt.trends_view(spark).collect()}
    assert newest["B", 60] == t0 + dt.timedelta(minutes=1) and newest["A", 300] == t0 + dt.timedelta(minutes=6)
    assert len(newest) == 6


def test_a_line_is_matched_and_a_message_decoded_once(spark):
    """The filter on the time holds no second copy of the pattern or of the decoding."""
    from obslake.streaming import live

    d = spark.createDataFrame([("('A', 60, 0, 1, 2.0, 1.0, 1.0, 'x')", 4), ("junk", 5), (None, 6)], "value string, offset long").repartition(2)
    j = spark.createDataFrame([('{"datetime": 60, "location": "A", "temp": 2.0}', 4), ("junk", 5), (None, 6)], "value string, offset long").repartition(2)
    for got, word in ((live.parse_observations(d), "regexp_replace("), (live.parse_messages(j), "from_json(")):
        assert got._jdf.queryExecution().optimizedPlan().toString().count(word) == 1
        assert [(r.location, r.seq, r.temperature) for r in got.collect()] == [("A", 4, 2.0)]
