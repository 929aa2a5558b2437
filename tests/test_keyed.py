"""Keyed tables: atomic commits, deltas, catalog tables, expiry; what the jobs keep in them."""

import datetime as dt
import json
import types

import pytest
from pyspark.sql import functions as F

from obslake.operators import windows
from obslake.plans import jobs
from obslake.schemas import OBSERVATION
from obslake.session import work_path
from obslake.sources import codecs, tables
from obslake.sources.keyed import KeyedTable, list_names, partition_value
from obslake.streaming import live

T0 = dt.datetime(2024, 1, 2, 12)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, p string, v double")


def seen(df):
    return sorted((tuple(r) for r in df.select("k", "p", "v").collect()), key=repr)


def table(spark, name, **options):
    return KeyedTable(spark, work_path(spark, name), ["k"], "p", **options)


# --- commits ------------------------------------------------------------------------------------

def test_writer_lost_before_the_switch_changes_nothing(spark, monkeypatch):
    t = table(spark, "t_lost")
    t.upsert(rows(spark, ("a", "x", 1.0), ("b", "y", 2.0)))
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", lambda self, new: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.upsert(rows(spark, ("a", "x", 9.0), ("c", "z", 3.0)), writer="w", batch=0)
        with pytest.raises(OSError):
            t.compact()
            t.drop({"p=x"})
    assert seen(t.read()) == [("a", "x", 1.0), ("b", "y", 2.0)]
    t.upsert(rows(spark, ("a", "x", 9.0), ("c", "z", 3.0)), writer="w", batch=0)  # delivered again
    want = [("a", "x", 9.0), ("b", "y", 2.0), ("c", "z", 3.0)]
    assert seen(t.read()) == want
    t.compact()
    t.vacuum(keep=1)
    assert seen(t.read()) == want
    left = sum(len([p for p in list_names(spark, f"{t.path}/data/{s}/{c}") if "=" in p])
               for s in list_names(spark, f"{t.path}/data") for c in list_names(spark, f"{t.path}/data/{s}"))
    assert left == len(t.manifest().entries) == 3  # the lost writer's folders are gone


def test_reader_keeps_its_version(spark):
    t = table(spark, "t_pin")
    t.upsert(rows(spark, ("a", "x", 1.0)))
    before = t.read()
    t.upsert(rows(spark, ("a", "x", 2.0), ("b", "x", 2.0)))
    t.compact()
    assert seen(before) == [("a", "x", 1.0)] and seen(t.read()) == [("a", "x", 2.0), ("b", "x", 2.0)]
    assert seen(t.read(version=1)) == [("a", "x", 1.0)]


def test_writers_that_race_both_arrive(spark, monkeypatch):
    a = table(spark, "t_race")
    a.upsert(rows(spark, ("a", "x", 1.0)))
    b, publish, raced = KeyedTable(spark, a.path), KeyedTable._publish, []

    def late(self, new):
        if self is a and not raced:
            raced.append(1)
            b.upsert(rows(spark, ("a", "x", 5.0), ("b", "x", 5.0)))
        return publish(self, new)
    monkeypatch.setattr(KeyedTable, "_publish", late)
    a.upsert(rows(spark, ("b", "x", 7.0), ("c", "y", 7.0)))
    assert seen(a.read()) == [("a", "x", 5.0), ("b", "x", 7.0), ("c", "y", 7.0)]
    assert a.versions() == [1, 2, 3]


def test_compaction_gives_way_to_another_one(spark, monkeypatch):
    a = table(spark, "t_give")
    for v in (1.0, 2.0):
        a.upsert(rows(spark, ("a", "x", v)))
    publish, raced = KeyedTable._publish, []

    def late(self, new):
        if self is a and not raced:
            raced.append(1)
            KeyedTable(spark, a.path).compact()
        return publish(self, new)
    monkeypatch.setattr(KeyedTable, "_publish", late)
    a.compact()
    assert seen(a.read()) == [("a", "x", 2.0)] and len(a.manifest().entries) == 1


def test_replayed_batch_changes_nothing(spark):
    t = table(spark, "t_replay")
    assert t.upsert(rows(spark, ("a", "x", 1.0)), writer="q", batch=0) == t.upsert(rows(spark, ("a", "x", 8.0)), writer="q", batch=0)
    t.upsert(rows(spark, ("a", "x", 2.0)), writer="other", batch=0)  # another run counts for itself
    assert seen(t.read()) == [("a", "x", 2.0)]


def _bytes(spark, t, seq):
    return sum(e.size for e in t.manifest().entries if e.seq == seq)


def test_a_batch_writes_its_own_rows_however_large_the_partition(spark):
    sizes = []
    for n in (10, 50_000):
        t = table(spark, f"t_delta_{n}")
        t.create(spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("p"), F.rand(1).alias("v")))
        sizes.append(_bytes(spark, t, t.upsert(rows(spark, ("3", "x", 1.0), ("new", "x", 2.0)))))
        assert t.read().count() == n + 1 and t.read().where("k = '3'").first().v == 1.0
    assert sizes[0] == sizes[1]


def test_folders_of_a_partition_stay_few(spark):
    t = table(spark, "t_few", most_folders=3)
    for i in range(12):
        t.upsert(rows(spark, ("same", "x", float(i)), (f"k{i}", "x", float(i))))
    assert len(t.manifest().entries) <= 4
    assert seen(t.read()) == sorted([("same", "x", 11.0)] + [(f"k{i}", "x", float(i)) for i in range(12)])


def test_a_partition_of_one_folder_is_read_without_a_shuffle(spark):
    t = table(spark, "t_plan")
    t.upsert(rows(spark, ("a", "x", 1.0), ("b", "y", 1.0)))
    t.upsert(rows(spark, ("a", "x", 2.0)))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan(t.read()) and "Exchange" not in plan(t.read(parts={"p=y"}))
    t.compact()
    assert "Exchange" not in plan(t.read())


def test_columns_and_merges(spark):
    t = table(spark, "t_columns")
    t.upsert(rows(spark, ("a", None, 1.0), ("b", "x", 1.0)))
    t.upsert(rows(spark, ("a", None, 2.0)).withColumn("seq", F.lit(7)))  # a column named as none of the folders'
    assert sorted(tuple(r) for r in t.read().select("k", "v", "seq").collect()) == [("a", 2.0, 7), ("b", 1.0, None)]
    t.upsert(rows(spark))  # empty
    m = table(spark, "t_merge", merge={"v": "min"})
    m.upsert(rows(spark, ("a", "x", 3.0), ("a", "x", 5.0)))
    m.upsert(rows(spark, ("a", "x", 4.0), ("b", "x", 1.0)))
    assert seen(m.read()) == [("a", "x", 3.0), ("b", "x", 1.0)]


# --- expiry and the catalog ------------------------------------------------------------------------

def test_null_and_escaped_partitions_expire(spark):
    t = KeyedTable(spark, work_path(spark, "t_expire"), ["k"], "p")
    old, young = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)
    odd = ["a:b", "c d%", "é/ü", "plain"]
    t.upsert(spark.createDataFrame([("n", None, old), *((p, p, old) for p in odd), ("m1", "mixed", old), ("m2", "mixed", young),
                                    ("w", "unknown", None)], "k string, p string, written_at timestamp"))
    assert {partition_value(e.part) for e in t.manifest().entries} == {None, *odd, "mixed", "unknown"}
    t.expire("2024-01-03 12:00:00")
    assert sorted(r.k for r in t.read().collect()) == ["m2"]
    assert [e.part for e in t.manifest().entries] == ["p=mixed"]


def test_catalog_table_follows_commits(spark):
    t = table(spark, "t_catalog")
    t.create(rows(spark, ("a", "x", 1.0), ("b", "y:1", 1.0), ("c", None, 1.0)))
    name = "t_follow.follow_" + t.path.rsplit("-", 1)[1]
    tables.ensure_table(spark, *name.split("."), "k string, v double, p string", t.path, "p", work_path(spark, "wh"))
    same = lambda: seen(spark.table(name)) == seen(t.read())
    assert same() and spark.table(name).count() == 3
    t.upsert(rows(spark, ("a", "x", 2.0), ("c", None, 2.0), ("d", "new", 2.0)))
    assert same() and spark.table(name).count() == 4
    t.drop({"p=x"})
    assert same() and spark.table(name).count() == 3
    tables.drop_table(spark, *name.split("."))
    t.upsert(rows(spark, ("e", "x", 3.0)))  # a dropped table is followed no longer
    assert spark.catalog.tableExists(name) is False


# --- jobs ------------------------------------------------------------------------------------------

RAW = "unix_date long, clouds double, humidity double, pressure double, temp double, temp_min double, temp_max double, deg double, speed double"


def test_daily_job_reads_the_days_that_changed(spark, monkeypatch):
    root = work_path(spark, "t_daily")
    raw = KeyedTable(spark, f"{root}/raw", ["unix_date"], "day")
    day = F.to_date(F.timestamp_seconds("unix_date"))
    obs = lambda *secs, v=1.0: spark.createDataFrame([(s, *[v] * 8) for s in secs], RAW).withColumn("day", day)
    raw.upsert(obs(0, 3600, 86400, 10 * 86400))
    jobs.daily_incremental(spark, raw.path, f"{root}/daily")
    read, asked = KeyedTable.read, []
    monkeypatch.setattr(KeyedTable, "read", lambda self, version=None, parts=None: asked.append(parts) or read(self, version, parts))
    daily = KeyedTable(spark, f"{root}/daily")
    before = daily.versions()
    jobs.daily_incremental(spark, raw.path, f"{root}/daily")  # nothing new
    raw.compact()
    jobs.daily_incremental(spark, raw.path, f"{root}/daily")
    assert asked == [] and daily.versions() == before
    raw.upsert(obs(86400, v=5.0))
    jobs.daily_incremental(spark, raw.path, f"{root}/daily")
    assert asked == [{"day=1970-01-02"}]
    assert sorted((r.unix_date, r.avg_temp) for r in daily.read().collect()) == [(0, 1.0), (86400, 5.0), (864000, 1.0)]


def observed(spark, minutes, locations="A"):
    return spark.createDataFrame([(x, T0 + dt.timedelta(minutes=m), m, float(m), 1.0, 1.0, "x") for m in minutes for x in locations], OBSERVATION)


def test_each_window_is_written_once(spark):
    """One new pane closes one window of each interval, and no window is written again."""
    lt = live.LiveTrends(work_path(spark, "t_once"))
    lt.process_batch(windows.panes(observed(spark, range(5))), 0)
    first = lt.results(spark).count()
    lt.process_batch(windows.panes(observed(spark, [5])), 1)
    t = lt.results_table(spark)
    written = [t.written(s).count() for s in sorted({e.seq for e in t.manifest().entries})]
    assert written == [first, 6] and lt.results(spark).count() == first + 6
    lt.process_batch(windows.panes(observed(spark, [5])), 1)  # replayed
    lt.finish(spark)
    want = windows.interval_trends(windows.window_ends(observed(spark, range(6))))
    got = lt.results(spark)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    newest = {r.interval_s: r.window_end for r in lt.trends_view(spark).collect()}
    assert newest[60] == T0 + dt.timedelta(minutes=6) and newest[21600] == T0 + dt.timedelta(hours=6, minutes=5)


def test_pane_behind_the_frontier_corrects_its_windows(spark):
    lt = live.LiveTrends(work_path(spark, "t_behind"), intervals=(60, 300))
    lt.process_batch(windows.panes(observed(spark, [0, 1, 9], "AB")), 0)
    lt.process_batch(windows.panes(observed(spark, [-3, 4], "A")), 1)
    lt.finish(spark)
    every = observed(spark, [0, 1, 9], "AB").unionByName(observed(spark, [-3, 4], "A"))
    want, got = windows.interval_trends(windows.window_ends(every, (60, 300))), lt.results(spark)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_new_checkpoint_adds_to_what_is_stored(spark):
    """A stream restarted under a fresh checkpoint keeps the panes and results of the old one."""
    root = work_path(spark, "t_fresh")
    ends = []
    for part, minutes in enumerate((range(0, 31), range(31, 42))):
        observed(spark, minutes).coalesce(1).write.parquet(f"{root}/in{part}")
        lt = live.LiveTrends(root, intervals=(60, 300), watermark="1 minute")
        q = lt.start(live.observation_stream(spark, f"{root}/in{part}", OBSERVATION), trigger=None, checkpoint=f"{root}/c{part}")
        q.awaitTermination()
        lt.finish(spark, q)
        ends.append((lt.panes_table(spark).read().count(), lt.results(spark).count()))
    assert ends[0][0] >= 28 and ends[1][0] >= ends[0][0] + 9 and ends[1][1] > ends[0][1]
    closed = lt.results(spark).where(F.col("window_end") <= F.lit(T0 + dt.timedelta(minutes=29)).cast("timestamp_ntz"))
    want = windows.interval_trends(windows.window_ends(observed(spark, range(31)), (60, 300))).where(
        F.col("window_end") <= F.lit(T0 + dt.timedelta(minutes=29)).cast("timestamp_ntz"))
    assert closed.exceptAll(want).count() == want.exceptAll(closed).count() == 0


def test_late_rows_are_counted_over_all_batches_and_runs(spark):
    lt = live.LiveTrends(work_path(spark, "t_late_count"))
    lt.panes_table(spark).note(late={"old run": [7, 3]})
    progress = lambda b, n: types.SimpleNamespace(batchId=b, stateOperators=[types.SimpleNamespace(numRowsDroppedByWatermark=n)])
    for b in range(120):
        for _ in range(2 if b % 40 == 0 else 1):  # asked twice: counted once
            lt.panes_table(spark).note(late=lt._late(spark, "run", progress(b, b % 3)))
    assert lt.late_rows(spark) == 3 + sum(b % 3 for b in range(120))


def lines(*minutes, v=1.0, place="A"):
    return [f"('{place}', {int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) + 60 * m}, 0, 0, {v}, 1.0, 1.0, 'x')" for m in minutes]


def test_station_feeds_all_sinks_and_counts_late_lines(spark):
    job = live.LiveStation(work_path(spark, "t_station"), intervals=(60, 300), delay_s=120)
    batch = lambda *ls: spark.createDataFrame([(x, i) for i, x in enumerate(ls)], "value string, offset long")
    batches = [batch(*lines(0, 1, 2), "junk"), batch(*lines(5, 4, v=2.0)), batch(*lines(0, 1, 3, 6, v=9.0)), batch("no line")]
    for i, b in enumerate(batches):
        for _ in range(2):  # each is delivered twice
            job.process_batch(b, i)
    # the newest time before batch 2 was minute 5: what ended by minute 3 is late
    assert job.trends.late_rows(spark) == 2 and job.raw.rejects(spark).count() == 2
    assert sorted(r.temperature for r in job.raw.table(spark).collect()) == [1.0, 2.0, 2.0, 9.0, 9.0, 9.0, 9.0]
    job.trends.finish(spark)
    kept = spark.createDataFrame([("A", T0 + dt.timedelta(minutes=m), m, v, 1.0, 1.0, "x") for m, v in
                                  ((0, 1.0), (1, 1.0), (2, 1.0), (4, 2.0), (5, 2.0), (3, 9.0), (6, 9.0))], OBSERVATION)
    want, got = windows.interval_trends(windows.window_ends(kept, (60, 300))), job.trends.results(spark)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_later_file_wins_without_offsets(spark):
    """Q19: lines of one second in two files: the later file's values, whatever their names and batches."""
    root = work_path(spark, "t_files")
    path = f"{root}/in"
    for name, v in (("b", 1.0), ("a", 7.0)):  # names against their times
        spark.createDataFrame([(x,) for x in [*lines(0, v=v), *lines(30)]], "value string").coalesce(1).write.mode("append").text(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")]
    text = {f.getName(): spark.read.text(f.toString()).first().value for f in files}
    for f in files:
        fs.setTimes(f, 1_700_000_000_000 + (5000 if ", 7.0," in text[f.getName()] else 0), -1)
    for most in (None, 1):
        job = live.LiveStation(f"{root}/{most}", intervals=(60,), delay_s=3600)
        job.start(codecs.line_stream(spark, path, most), trigger=None).awaitTermination()
        job.trends.finish(spark)
        assert [r.temperature for r in job.raw.table(spark).orderBy("timestamp").collect()] == [7.0, 1.0]
        got = {r.window_end: r.actual_temperature for r in job.trends.results(spark).collect()}
        assert got[T0 + dt.timedelta(minutes=1)] == 7.0


def test_processing_time_trigger(spark):
    """A stream on a processing-time trigger takes what lands, until it is stopped."""
    import time

    root = work_path(spark, "t_trigger")
    observed(spark, range(8)).coalesce(1).write.parquet(f"{root}/in")
    lt = live.LiveTrends(root, intervals=(60,), watermark="1 minute", mode="update")
    q = lt.start(live.observation_stream(spark, f"{root}/in", OBSERVATION), trigger="1 second")
    end = time.time() + 60
    while time.time() < end and lt.results(spark).count() < 8:
        time.sleep(1)
    q.stop()
    assert lt.results(spark).count() == 8


def test_command_line_of_live_jobs(spark, tmp_path):
    """Live-lines, live-messages and serve, each in its own process."""
    from test_cli import _run

    src, root, out = (str(tmp_path / n) for n in ("lines", "live", "out"))
    spark.createDataFrame([(x,) for x in lines(*range(30))], "value string").coalesce(1).write.text(src)
    _run("live-lines", "--source", src, "--root", root, "--trigger", "available-now", "--delay", "60", cwd=tmp_path)
    _run("serve", "--root", root, "--as-of", "2024-01-02 13:00:00", "--out", out, cwd=tmp_path)
    view = [json.loads(r.value) for r in spark.read.text(f"{out}/trends_view").collect()]
    assert {v["interval"] for v in view} >= {"1 m", "5 m", "10 m"} and {v["location"] for v in view} == {"A"}
    job = live.LiveLocationData(root)
    assert job.table(spark).count() == 30
    messages = str(tmp_path / "messages")
    epoch = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    spark.createDataFrame([("k", json.dumps({"location": "A", "datetime": epoch + 60 * i, "temp": 1.0 * i, "wind": 1.0, "humidity": 1,
                                             "weather": "x"}), 0, i, T0) for i in range(30)],
                          "key string, value string, partition int, offset long, timestamp timestamp").coalesce(1).write.parquet(messages)
    other = str(tmp_path / "live2")
    _run("live-messages", "--source", messages, "--root", other, "--trigger", "available-now", "--watermark", "1 minute", cwd=tmp_path)
    assert live.LiveTrends(other).results(spark).where("interval_s = 60").count() == 28
