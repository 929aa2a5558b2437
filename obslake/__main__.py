"""Command line for spark-submit: `spark-submit --py-files obslake.zip -m obslake <job> ...`
or `python -m obslake <job> ...` locally.

Jobs
  bootstrap  --json PATH --daily PATH [--multiline]       V8: nested JSON history -> new daily table
  daily      --raw PATH --daily PATH           V9: raw observations -> daily table (upsert)
  records    --daily PATH --out PATH [--order reference] [--split-summer]   V6: records CSV per season
  trends     --daily PATH --out PATH [--years 4] [--split-summer]           V7: trends CSV per season
  live-trends --source PATH --root PATH [--trigger "10 seconds"] [--watermark "10 minutes"]
              [--mode append|update]           V11: Parquet observation stream -> live trends
                                               (append: final windows; update: live, provisional)
  live-lines  --source PATH --root PATH [--delay SECONDS]   V11: tuple-line text stream -> location_data,
                                               rejects and trends, from one read
  live-messages --source PATH --root PATH      V11: MESSAGE JSON (value, offset) stream -> live trends
  serve       --root PATH --as-of TS --out PATH [--records PATH] [--trends PATH]   V1-V5: JSON of the stored
                                               trends view, observations and season products
  ingest      --source PATH --root PATH        V10: (offset, value) message stream -> raw + daily tables
  expire      --table PATH --as-of TS [--written-at written_at]   T9 compaction of a keyed table
  live-maintain --root PATH --as-of TS         compact the live tables, expire results and panes
"""

from __future__ import annotations

import argparse

from obslake.plans import jobs, serve
from obslake.schemas import BROKER, OBSERVATION
from obslake.session import build_session
from obslake.sources import tables
from obslake.sources.codecs import line_stream
from obslake.streaming import live


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="obslake")
    ap.add_argument("job")
    for opt in ("--json", "--daily", "--raw", "--out", "--source", "--root", "--table", "--as-of", "--records", "--trends"):
        ap.add_argument(opt)
    ap.add_argument("--order", default="extreme")
    ap.add_argument("--years", type=int, default=4)
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--watermark", default="10 minutes")
    ap.add_argument("--delay", type=int, default=600)
    ap.add_argument("--written-at", default="written_at")
    ap.add_argument("--mode", default="append", choices=["append", "update"])
    ap.add_argument("--multiline", action="store_true")
    ap.add_argument("--split-summer", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session(app=f"obslake-{a.job}")
    trig = None if a.trigger == "available-now" else a.trigger

    if a.job == "bootstrap":
        jobs.history_bootstrap(spark, a.json, a.daily, multiline=a.multiline)
    elif a.job == "daily":
        jobs.daily_incremental(spark, a.raw, a.daily)
    elif a.job == "records":
        jobs.records_job(spark, a.daily, a.out, order=a.order, split_summer=a.split_summer)
    elif a.job == "trends":
        jobs.trends_job(spark, a.daily, a.out, n=a.years, split_summer=a.split_summer)
    elif a.job == "live-trends":
        lt = live.LiveTrends(a.root, watermark=a.watermark, mode=a.mode)
        q = lt.start(live.observation_stream(spark, a.source, OBSERVATION), trigger=trig)
        q.awaitTermination()
        lt.finish(spark, q)
    elif a.job == "live-lines":
        live.LiveStation(a.root, delay_s=a.delay).start(line_stream(spark, a.source), trigger=trig).awaitTermination()
    elif a.job == "live-messages":
        messages = spark.readStream.schema(BROKER).parquet(a.source)
        lt = live.LiveTrends(a.root, watermark=a.watermark, mode=a.mode)
        q = lt.start(live.parse_messages(messages), trigger=trig)
        q.awaitTermination()
        lt.finish(spark, q)
    elif a.job == "serve":
        serve.serve_job(spark, a.root, a.as_of, a.out, a.records, a.trends)
    elif a.job == "ingest":
        stream = spark.readStream.schema(BROKER).parquet(a.source)
        live.LiveIngest(a.root).start(stream, trigger=trig).awaitTermination()
    elif a.job == "live-maintain":
        lt = live.LiveTrends(a.root)
        lt.compact_results(spark)
        lt.expire_results(spark, a.as_of)
    elif a.job == "expire":
        tables.compact_expired(spark, a.table, a.as_of, written_at=a.written_at)
    else:
        ap.error(f"unknown job {a.job!r}")
    spark.stop()  # Q21: actually stop the session


if __name__ == "__main__":
    main()
