"""V6-V9: the batch jobs, end to end (read -> transform -> write). Each is a function of paths so
that spark-submit wrappers stay one line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.columns import epoch_to_date
from obslake.operators import history, rollup
from obslake.sources import tables
from obslake.sources.keyed import KeyedTable


def _with_year(daily: DataFrame) -> DataFrame:
    return daily.withColumn("year", F.year(epoch_to_date("unix_date")))


def history_bootstrap(spark: SparkSession, json_path: str, daily_path: str, partitions: int | None = None,
                      multiline: bool = False) -> None:
    """V8: nested JSON history (S1) -> daily rollup (F1-F3, P1, G1) -> new daily table."""
    nested = tables.read_history_json(spark, json_path, multiline=multiline)
    tables.create_table(_with_year(rollup.history_daily(nested)), daily_path, "unix_date", "year", partitions)


ROLLED_UP = "rolled up"  # of a daily table: the newest write per day of each raw table that it holds


def daily_incremental(spark: SparkSession, raw_path: str, daily_path: str) -> None:
    """V9: raw-observation table (S3) -> midnight epoch (F5) -> daily rollup (G2) -> upsert into
    the daily table (S5). The table may be one that the history job created (V8); its days are
    replaced by those of the raw observations.

    Of a keyed raw table by day only the days written since the last run are read and rolled up; with
    none the job ends there. What was rolled up is committed together with the rows."""
    raw, daily = KeyedTable(spark, raw_path), KeyedTable(spark, daily_path, ["unix_date"], "year")
    facts = None
    if raw.exists() and raw.manifest().partition_by == "day":
        m = raw.manifest()
        now: dict[str, int] = {}
        for e in m.entries:
            now[e.part] = max(e.seq, now.get(e.part, -1))
        done = daily.manifest().facts.get(ROLLED_UP, {})
        changed = {p for p, seq in now.items() if done.get(raw_path, {}).get(p) != seq}
        if not changed:
            return
        rows, facts = raw.read(m.version, changed), {ROLLED_UP: done | {raw_path: now}}
    else:
        rows = tables.read_table(spark, raw_path)
    rows = rows.select("unix_date", "clouds", "humidity", "pressure", "temp", "temp_min", "temp_max", "deg", "speed")
    daily.upsert(_with_year(rollup.observations_daily(rows)), facts=facts, unique=True)


def _season_table(spark: SparkSession, daily_path: str, split_summer: bool = False) -> DataFrame:
    daily = tables.read_table(spark, daily_path).drop("year")
    seas = rollup.season_rollup(daily, split_summer)
    seas.createOrReplaceTempView("year_season")  # S19
    return spark.table("year_season")


def records_job(spark: SparkSession, daily_path: str, out_path: str, order: str = "extreme",
                split_summer: bool = False) -> None:
    """V6: daily table -> season rollup -> records per (season, measure) -> CSV, one file per
    season folder (F21: season=<name> instead of a file name per season)."""
    rec = history.records(_season_table(spark, daily_path, split_summer), order=order)
    (rec.coalesce(1).write.mode("overwrite").partitionBy("season")
     .option("header", True).csv(out_path))


def trends_job(spark: SparkSession, daily_path: str, out_path: str, n: int = 4,
               split_summer: bool = False) -> None:
    """V7: daily table -> season rollup -> latest n years -> yearly trend -> CSV per season."""
    tr = history.trends(_season_table(spark, daily_path, split_summer), n=n).drop("has_prev")
    (tr.coalesce(1).write.mode("overwrite").partitionBy("season")
     .option("header", True).csv(out_path))


def read_products(spark: SparkSession, path: str, trends: bool, season: str | None = None) -> DataFrame:
    """S8 + V4/V5: read a product folder back; a season filter prunes to that folder."""
    cols = "year int, measure string, value double" + (", trend double" if trends else "") + ", season string"
    df = spark.read.option("header", True).schema(cols).csv(path)
    if season is not None:
        df = df.filter(F.col("season") == season)
    order = ["season", "year", "measure", "value"] + (["trend"] if trends else [])
    return df.select(*order)
