"""Structured Streaming jobs.

Live interval trends
--------------------
stream -> watermark on ts -> tumbling one-minute panes per location (min/max struct), so the
state store only holds panes not yet closed by the watermark. Each micro-batch (foreachBatch, T2)
commits its panes to a keyed table (a batch of a run is committed once, T11), then the windows that
follow from them, then the newest of these per (location, interval) to `trends_view`, which the serving
layer reads (S14, S16). In append mode panes come closed and in an order that no later pane breaks, so a
frontier moves over the ends of windows: those it passes are written, once, from the panes they
reach. A new checkpoint is another run: its batches add to what is stored.

T12: rows behind the previous batch's watermark are dropped by Spark and counted. `LiveStation` does the
same without a state store, from one read of the source, for all sinks.

Rows that cannot be read go, with their text, to a reject table per job (P18), and a delivery of
nothing else changes no table. Of the rows of one key the later arrival wins (`codecs.arrival`).

Live ingest (V10) decodes broker messages, flattens them and upserts the raw-observation table
per micro-batch (S6), then re-aggregates only the days the batch touched into the daily table
(V9 incremental).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.functions.columns import epoch_to_date, now
from obslake.operators import windows
from obslake.plans.jobs import daily_incremental
from obslake.schemas import DAY_S, INTERVALS, MESSAGE, SLIDE_S
from obslake.sources import codecs, tables
from obslake.sources.keyed import KeyedTable, partition_value

# the rows of the live tables, as their jobs write them
TREND_ROW = (
    "location string, interval_s int, window_end timestamp_ntz, actual_temperature double, temperature_trend double, "
    "actual_wind double, wind_trend double, actual_humidity double, humidity_delta double, weather string")
LOCATION_DATA = (
    "location string, timestamp long, temperature double, wind double, humidity double, weather string, written_at timestamp")


def trigger_kwargs(trigger: str | None) -> dict:
    """T1: '10 seconds' -> processingTime trigger; None -> availableNow (drain and stop)."""
    return {"availableNow": True} if trigger is None else {"processingTime": trigger}


def stream_panes(obs_stream: DataFrame, watermark: str, slide_s: int = SLIDE_S) -> DataFrame:
    """Closed panes of a streaming observation frame (append mode)."""
    rec = windows.record()
    g = (obs_stream.withWatermark("ts", watermark)
         .groupBy("location", F.window("ts", f"{slide_s} seconds").alias("w"))
         .agg(F.min(rec).alias("first_rec"), F.max(rec).alias("last_rec")))
    return g.select("location", F.unix_seconds(F.col("w.start")).alias("pane"), "first_rec", "last_rec")


class LiveTrends:
    """Multi-interval trends maintained from a stream of observations."""

    def __init__(self, root: str, intervals=INTERVALS, watermark: str = "10 minutes",
                 slide_s: int = SLIDE_S, signed: bool = True, mode: str = "append"):
        """mode='append': panes closed by the watermark are taken, and each window is written once, as
        soon as every pane in it is closed. mode='update': every trigger takes the panes it changed,
        open ones included, and refreshes all their windows, so results are live (provisional until
        the watermark passes). Panes that are delivered again only widen (min can only fall, max only
        rise), so both modes end equal."""
        if mode not in ("append", "update"):
            raise ValueError(f"mode must be 'append' or 'update', not {mode!r}")
        self.mode = mode
        self.root = root
        self.panes_path = os.path.join(root, "panes")
        self.results_path = os.path.join(root, "results")
        self.view_path = os.path.join(root, "trends_view")
        self.checkpoint = os.path.join(root, "_checkpoint")
        self.intervals = tuple(intervals)
        self.watermark = watermark
        self.slide_s = slide_s
        self.signed = signed
        self.spark = self.query = None  # of the running stream: its session, not a micro-batch's, which plans without AQE

    # stored tables

    def panes_table(self, spark: SparkSession) -> KeyedTable:
        """First and last record per (location, minute), by day; deliveries of one minute are merged."""
        return KeyedTable(spark, self.panes_path, ["location", "pane"], "day",
                          merge={"first_rec": "min", "last_rec": "max"})

    def results_table(self, spark: SparkSession) -> KeyedTable:
        return KeyedTable(spark, self.results_path, ["location", "interval_s", "window_end"], "day")

    def view_table(self, spark: SparkSession) -> KeyedTable:
        return KeyedTable(spark, self.view_path, ["location", "interval_s"], newest_by=("window_end",))

    # batches

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Panes of one micro-batch into the stored tables. The progress of the batch before tells how
        far windows are closed besides the panes themselves, and how many rows came too late."""
        spark = self.spark or batch.sparkSession
        run, last = run_id(spark), self.query.lastProgress if self.query else None
        closed = _watermark_s(last) if self.mode == "append" else None
        late = self._late(spark, run, last)
        self.take(batch, run, batch_id, closed, {"late": late} if late else None)

    def _late(self, spark: SparkSession, run: str, progress) -> dict:
        """Rows dropped behind the watermark, by run: [last batch counted, rows so far]."""
        late = self.panes_table(spark).manifest().facts.get("late", {})
        if progress is None or progress.batchId <= late.get(run, [-1, 0])[0]:
            return late
        return late | {run: [progress.batchId, late.get(run, [-1, 0])[1] + _dropped(progress)]}

    def take(self, panes: DataFrame, run: str, batch_id: int, closed_s: int | None = None, facts: dict | None = None,
             open_panes: bool = False) -> None:
        """Store panes (location, pane, first_rec, last_rec) and the windows that follow from them.
        closed_s: no pane that ends by then will be delivered; neither will one before a pane that was,
        unless the panes may be open ones.

        Each of the three tables is committed once, in this order, under the run's batch number: a
        replayed batch goes on where it was lost. The batch is evaluated once, by the first write."""
        spark = self.spark or panes.sparkSession
        table = self.panes_table(spark)
        day = F.floor(F.col("pane") / F.lit(DAY_S)).cast("long")
        seq = table.upsert(panes.withColumn("day", day), writer=run, batch=batch_id, facts=facts, unique=True)
        mine = table.written(seq) if seq is not None and seq >= 0 else None
        span = mine.agg(F.min("pane").alias("lo"), F.max("pane").alias("hi")).first() if mine is not None else None
        if span is not None and span["lo"] is None:
            mine, span = None, None
        if self.mode == "update":
            if mine is not None:
                self._write(self._touched(table, mine, span["lo"], span["hi"]), run, batch_id, {})
            return
        before = self.results_table(spark).manifest().facts.get("frontier")
        ends = [t for t in (before, closed_s and closed_s // self.slide_s * self.slide_s,
                            span["hi"] + self.slide_s if span and not open_panes else None) if t is not None]
        if not ends or (mine is None and max(ends) == before):  # S23: nothing closed in this batch
            return
        frontier = max(ends)
        lo = before if before is not None else table.read().agg(F.min("pane")).first()[0] if table.manifest().entries else None
        if lo is None:
            return
        closing = self._ends(table, lo, frontier)
        if mine is not None and span["lo"] < lo:  # panes behind the frontier: their windows once more
            late = mine.where(F.col("pane") < lo)
            again = self._touched(table, late, span["lo"], min(span["hi"], lo), upto=lo)
            closing = closing.unionByName(again)
        self._write(closing, run, batch_id, {"frontier": frontier})

    def finish(self, spark: SparkSession, query=None) -> None:
        """Write the windows that the last watermark of a stopped query closed; without a query those
        that its panes reach at all, for a stream that has ended."""
        table, results = self.panes_table(spark), self.results_table(spark)
        if query is not None and (last := query.lastProgress):
            table.note(late=self._late(spark, str(query.id), last))
        before = results.manifest().facts.get("frontier")
        if before is None or not table.manifest().entries:
            return
        if query is None:
            upto = table.read().agg(F.max("pane")).first()[0] + max(self.intervals)
        else:
            upto = (_watermark_s(query.lastProgress) or 0) // self.slide_s * self.slide_s
        if upto > before:
            self._write(self._ends(table, before, upto), None, None, {"frontier": upto})

    def _ends(self, table: KeyedTable, lo: int, hi: int) -> DataFrame:
        """Windows that end in (lo, hi], from the stored panes that they reach."""
        pn = self._stored_panes(table, lo - max(self.intervals), hi)
        return windows.window_ends(None, self.intervals, self.slide_s, pn=pn, ends=(lo, hi))

    def _stored_panes(self, table: KeyedTable, lo: int, hi: int) -> DataFrame:
        """Panes in [lo, hi): of the day folders in that range alone, the rest by Parquet statistics."""
        days = {e.part for e in table.manifest().entries if lo // DAY_S <= int(partition_value(e.part) or -1) <= hi // DAY_S}
        return table.read(parts=days).where((F.col("pane") >= lo) & (F.col("pane") < hi)).drop("day")

    def _touched(self, table: KeyedTable, mine: DataFrame, lo: int, hi: int, upto: int | None = None) -> DataFrame:
        """Windows that hold a pane of `mine`, of its locations alone, each over its own pane range."""
        wmax = max(self.intervals)
        scope = mine.groupBy(F.col("location").alias("_loc")).agg(F.min("pane").alias("_lo"), F.max("pane").alias("_hi"))
        here = F.col("location").eqNullSafe(F.col("_loc"))
        pn = self._stored_panes(table, lo - wmax, hi + wmax).join(
            scope, here & (F.col("pane") >= F.col("_lo") - wmax) & (F.col("pane") < F.col("_hi") + wmax)) \
            .select("location", "pane", "first_rec", "last_rec")
        end_s = F.unix_seconds(F.col("window_end").cast("timestamp"))
        ends = windows.window_ends(None, self.intervals, self.slide_s, pn=pn).join(
            scope, here & (end_s > F.col("_lo")) & (end_s <= F.col("_hi") + F.col("interval_s"))).drop("_loc", "_lo", "_hi")
        return ends if upto is None else ends.where(end_s <= upto)

    def _write(self, ends: DataFrame, run: str | None, batch_id: int | None, facts: dict) -> None:
        spark = ends.sparkSession
        results = self.results_table(spark)
        rows = windows.interval_trends(ends, self.signed).withColumn("day", F.to_date("window_end"))
        seq = results.upsert(rows, writer=run, batch=batch_id, facts=facts, unique=True)
        if seq is not None and seq >= 0:
            newest = results.written(seq).drop("day")
            self.view_table(spark).upsert(newest, writer=run, batch=batch_id)

    def start(self, obs_stream: DataFrame, trigger: str | None = "10 seconds", checkpoint: str | None = None):
        self.spark, self.query = obs_stream.sparkSession, None
        self.query = (stream_panes(obs_stream, self.watermark, self.slide_s).writeStream
                      .outputMode(self.mode)
                      .foreachBatch(self.process_batch)
                      .option("checkpointLocation", checkpoint or self.checkpoint)
                      .trigger(**trigger_kwargs(trigger))
                      .start())
        return self.query

    # upkeep

    def expire_results(self, spark: SparkSession, as_of, ttl_s: int = DAY_S) -> None:
        """Windows that ended more than ttl_s before as_of go; so do pane days too old for any later
        window (older than the result lifetime plus the longest window)."""
        self.results_table(spark).expire(as_of, ttl_s, written_at="window_end")
        keep_from = spark.range(1).select(
            F.floor((F.unix_seconds(F.lit(as_of).cast("timestamp")) - ttl_s - max(self.intervals))
                    / F.lit(DAY_S)).cast("long") - 1).first()[0]
        table = self.panes_table(spark)
        table.drop({e.part for e in table.manifest().entries if int(partition_value(e.part) or -1) < keep_from})

    def compact_results(self, spark: SparkSession) -> None:
        """One folder per day of panes and of results, and one of the view; what no kept version of
        them names is deleted."""
        for t in (self.panes_table(spark), self.results_table(spark), self.view_table(spark)):
            t.compact()
            t.vacuum()

    def results(self, spark: SparkSession) -> DataFrame:
        """Latest computation per (location, interval, window end); no rows before the first."""
        return tables.read_or_empty(spark, self.results_path, TREND_ROW)

    def trends_view(self, spark: SparkSession) -> DataFrame:
        """The stored newest trend row per (location, interval)."""
        return tables.read_or_empty(spark, self.view_path, TREND_ROW)

    def late_rows(self, spark: SparkSession) -> int:
        """Rows that came too late, over all runs: up to the batch before the last, and all of them
        once `finish` was called."""
        return sum(n for _, n in self.panes_table(spark).manifest().facts.get("late", {}).values())


class LiveTrendsUpdate:
    """Direct low-latency form with Spark's own sliding windows: every trigger re-emits the
    windows its rows touched (update mode) and the sink upserts them by (location, interval,
    window end). Rows do not join all their windows (466 a row): a task brings two rows for each
    window it adds to, so volume grows with the windows. `LiveTrends(mode='update')` gives the same
    live results from panes. The watermark is on the window end, so state for older ends is dropped."""

    def __init__(self, root: str, intervals=INTERVALS, watermark: str = "10 minutes",
                 slide_s: int = SLIDE_S, signed: bool = True):
        self.results_path = os.path.join(root, "results_live")
        self.checkpoint = os.path.join(root, "_checkpoint_live")
        self.intervals, self.watermark, self.slide_s, self.signed = tuple(intervals), watermark, slide_s, signed

    def aggregate(self, obs_stream: DataFrame) -> DataFrame:
        """Every partition of a micro-batch brings each window it adds to once, as first and last rows."""
        ex = (windows.partial_window_ends(obs_stream, self.intervals, self.slide_s)
              .withColumn("window_end", F.timestamp_seconds("end_s"))
              .withWatermark("window_end", self.watermark))
        return ex.groupBy("location", "interval_s", "window_end").agg(
            F.min("first_rec").alias("first_rec"), F.max("last_rec").alias("last_rec"))

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        ends = batch.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
        res = windows.interval_trends(ends, self.signed).withColumn("batch", F.lit(batch_id).cast("long"))
        res.write.mode("overwrite").parquet(f"{self.results_path}/part={batch_id}")

    def start(self, obs_stream: DataFrame, trigger: str | None = "10 seconds"):
        return (self.aggregate(obs_stream).writeStream.outputMode("update")
                .foreachBatch(self.process_batch)
                .option("checkpointLocation", self.checkpoint)
                .trigger(**trigger_kwargs(trigger)).start())

    def results(self, spark: SparkSession) -> DataFrame:
        res = spark.read.parquet(self.results_path).drop("part")
        return tables.upsert_latest(res, ["location", "interval_s", "window_end"], ["batch"]).drop("batch")


def parse_observations(lines: DataFrame) -> DataFrame:
    """S12 + P16 + P11: tuple text lines -> typed observations. The broker's `offset` becomes seq, so the
    later arrival of a second is its last; plain text lines carry none: their seq is 0 and ties are
    broken by the remaining fields. Unreadable lines drop here; `LiveLocationData` keeps them."""
    seq = F.col("offset") if "offset" in lines.columns else F.lit(0)
    m = lines.select("value", codecs.once(codecs.matched("value")).alias("matched"), seq.cast("long").alias("seq"))
    return observations_of(m.select(codecs.parse_matched("value", "matched").alias("p"), "seq"), "seq")


def observations_of(parsed: DataFrame, seq: str) -> DataFrame:
    """Typed observations of parsed lines (p, and their order)."""
    return parsed.filter(codecs.is_epoch("p.timestamp")).select(
        F.col("p.location").alias("location"),
        F.timestamp_seconds(F.col("p.timestamp")).alias("ts"),
        seq,
        F.col("p.temperature").alias("temperature"),
        F.col("p.wind").alias("wind"),
        F.col("p.humidity").alias("humidity"),
        F.col("p.weather").alias("weather"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """S10 + P13: broker messages (value as MESSAGE JSON, offset) -> typed observations for
    `LiveTrends`. Messages that are no JSON, or hold no time, drop."""
    m = messages.select(codecs.once(codecs.decode("value", MESSAGE)).alias("m"), F.col("offset").cast("long").alias("seq"))
    return m.filter(codecs.is_epoch(F.col("m.datetime"))).select(
        F.col("m.location").alias("location"),
        F.timestamp_seconds(F.col("m.datetime")).alias("ts"),
        "seq",
        F.col("m.temp").alias("temperature"),
        F.col("m.wind").alias("wind"),
        F.col("m.humidity").alias("humidity"),
        F.col("m.weather").alias("weather"))


def read_lines(batch: DataFrame) -> DataFrame:
    """One micro-batch of lines, parsed (p) with their arrival order (seq), staged in the shared folder
    so that the source is read once, however many sinks follow."""
    return batch.select("value", codecs.parse_line("value").alias("p"), codecs.arrival(batch).alias("seq"),
                        now().alias("written_at")).checkpoint(eager=True)


class LiveLocationData:
    """Raw pass-through persistence of parsed lines into location_data, upserted by
    (location, timestamp) per micro-batch and partitioned by day. The later arrival wins, within a
    batch and across batches; written_at is the time of the write, from which the lifetime runs. A
    batch writes its own rows, however many its days hold. Lines that cannot be parsed go to the
    reject table."""

    def __init__(self, root: str):
        self.path = os.path.join(root, "location_data")
        self.rejects_path = os.path.join(root, "rejected_lines")
        self.checkpoint = os.path.join(root, "_checkpoint_location_data")
        self.spark = None

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = self.spark or batch.sparkSession
        self.take(read_lines(batch), run_id(spark), batch_id)

    def take(self, staged: DataFrame, run: str, batch_id: int) -> None:
        good = codecs.is_epoch("p.timestamp")
        tables.write_rejects(staged.filter(~good), self.rejects_path, run, batch_id)
        ts = F.timestamp_seconds("p.timestamp")
        rows = staged.filter(good).select(
            "p.location", "p.timestamp", "p.temperature", "p.wind", "p.humidity", "p.weather", "written_at",
            F.to_date(ts).alias("day"), F.col("seq").alias("_order"))
        table = KeyedTable(self.spark or staged.sparkSession, self.path, ["location", "timestamp"], "day")
        table.upsert(rows, ["_order"], writer=run, batch=batch_id, keep_order=False)

    def start(self, line_stream: DataFrame, trigger: str | None = "10 seconds"):
        self.spark = line_stream.sparkSession
        return (line_stream.writeStream.foreachBatch(self.process_batch)
                .option("checkpointLocation", self.checkpoint)
                .trigger(**trigger_kwargs(trigger)).start())

    def stored(self, spark: SparkSession) -> DataFrame:
        return tables.read_or_empty(spark, self.path, LOCATION_DATA)

    def table(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).drop("written_at")

    def rejects(self, spark: SparkSession) -> DataFrame:
        return tables.read_or_empty(spark, self.rejects_path, "value string")


class LiveStation:
    """V11 as one job (T2, T6): each micro-batch of lines is read once and feeds location_data, the reject
    table, the panes and the windows that it closes, all under one batch number; one failure stops them
    all. The stored panes are the state: no state store is kept.

    A row whose minute ended by the watermark of the batch before (the newest time seen less the
    delay) is too late for the trends; it is counted, and stored in location_data all the same."""

    def __init__(self, root: str, intervals=INTERVALS, delay_s: int = 600, slide_s: int = SLIDE_S, signed: bool = True):
        self.raw = LiveLocationData(root)
        self.trends = LiveTrends(root, intervals, f"{delay_s} seconds", slide_s, signed)
        self.delay_s, self.slide_s = delay_s, slide_s
        self.checkpoint = os.path.join(root, "_checkpoint_station")
        self.spark = None

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = self.spark or batch.sparkSession
        run = run_id(spark)
        staged = read_lines(batch)
        self.raw.take(staged, run, batch_id)
        # among the lines of one second: the batch, then the place in it
        order = Window.partitionBy("location", "ts").orderBy("arrived")
        obs = observations_of(staged.withColumnRenamed("seq", "arrived"), "arrived").withColumn(
            "seq", F.lit(batch_id).cast("long") * (1 << 24) + F.row_number().over(order))
        facts = self.trends.panes_table(spark).manifest().facts
        # [batch, rows so far] by run, and the newest time that the batches before `since` had seen
        late, seen = facts.get("late", {}), facts.get("seen", {})
        before = seen.get("before") if seen.get("run") == run and seen.get("batch") == batch_id else seen.get("newest")
        newest = staged.filter(codecs.is_epoch("p.timestamp")).agg(F.max("p.timestamp")).first()[0]
        newest = max((x for x in (before, newest) if x is not None), default=None)
        if newest is None:
            return
        if before is not None:
            behind = F.unix_seconds("ts") - F.pmod(F.unix_seconds("ts"), F.lit(self.slide_s)) + self.slide_s <= before - self.delay_s
            n = obs.filter(behind).count()
            obs = obs.filter(~behind)
            if n and late.get(run, [-1, 0])[0] < batch_id:
                late = late | {run: [batch_id, late.get(run, [-1, 0])[1] + n]}
        self.trends.spark = spark
        self.trends.take(windows.panes(obs, self.slide_s), run, batch_id, newest - self.delay_s, open_panes=True, facts={
            "late": late, "seen": {"run": run, "batch": batch_id, "before": before, "newest": newest}})

    def start(self, line_stream: DataFrame, trigger: str | None = "10 seconds"):
        self.spark = self.raw.spark = line_stream.sparkSession
        return (line_stream.writeStream.foreachBatch(self.process_batch)
                .option("checkpointLocation", self.checkpoint)
                .trigger(**trigger_kwargs(trigger)).start())


MANUAL = "manual"  # the run of batches that no stream delivers


def run_id(spark: SparkSession) -> str:
    """The id of the stream whose micro-batch is being processed: the same for all runs from one
    checkpoint, another one for a new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or MANUAL


def _watermark_s(progress) -> int | None:
    """Epoch seconds of a finished batch's watermark."""
    text = (progress.eventTime or {}).get("watermark") if progress else None
    if not text:
        return None
    s = int(dt.datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp())
    return s if s > 0 else None


def _dropped(progress) -> int:
    return int(sum(op.numRowsDroppedByWatermark for op in progress.stateOperators))


def late_rows(query) -> int:
    """Rows that the recent micro-batches of a query dropped for being behind the watermark of the
    previous batch; `LiveTrends.late_rows` counts all."""
    return sum(map(_dropped, query.recentProgress or []))


def observation_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """S12 analogue for files: a folder of Parquet observation files as a stream."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


class LiveIngest:
    """V10 + V9: broker messages -> raw-observation table (upsert by location and unix_date) -> daily table
    (re-aggregated for the days written since its last commit)."""

    def __init__(self, root: str):
        self.raw_path = os.path.join(root, "raw")
        self.daily_path = os.path.join(root, "daily")
        self.rejects_path = os.path.join(root, "rejected_messages")
        self.checkpoint = os.path.join(root, "_checkpoint")
        self.spark = None

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = self.spark or batch.sparkSession
        run = run_id(spark)
        messages = batch.select("value", codecs.arrival(batch).alias("seq"))
        staged = codecs.raw_observations(messages, keep=("value",)).checkpoint(eager=True)  # read once
        good = codecs.is_epoch("unix_date")
        tables.write_rejects(staged.filter(~good), self.rejects_path, run, batch_id)
        new = staged.filter(good).drop("value").withColumn("day", epoch_to_date("unix_date"))
        raw = KeyedTable(spark, self.raw_path, ["location", "unix_date"], "day")
        raw.upsert(new.withColumnRenamed("seq", "_order"), ["_order"], writer=run, batch=batch_id, keep_order=False)
        if raw.manifest().entries:
            daily_incremental(spark, self.raw_path, self.daily_path)

    def start(self, message_stream: DataFrame, trigger: str | None = "10 seconds"):
        self.spark = message_stream.sparkSession
        return (message_stream.writeStream.foreachBatch(self.process_batch)
                .option("checkpointLocation", self.checkpoint)
                .trigger(**trigger_kwargs(trigger)).start())

    def daily(self, spark: SparkSession) -> DataFrame:
        return tables.read_table(spark, self.daily_path).drop("year")

    def rejects(self, spark: SparkSession) -> DataFrame:
        return tables.read_or_empty(spark, self.rejects_path, "value string")


__all__ = ["LiveTrends", "LiveTrendsUpdate", "LiveIngest", "LiveLocationData", "LiveStation", "late_rows",
           "observation_stream", "parse_messages", "parse_observations", "stream_panes", "trigger_kwargs"]
