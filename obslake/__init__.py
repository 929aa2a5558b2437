"""obslake: weather-observation analytics as Spark DataFrame / SQL / Structured Streaming code.

Layers:
  functions/  column expressions (calendar, season, percent change, labels, exact means)
  sources/    readers, writers, message codecs, keyed tables (upsert, expiry)
  operators/  rollups, records, yearly trends, sliding first/last windows
  streaming/  Structured Streaming jobs (live trends, raw ingest)
  plans/      end-to-end jobs, serving views, the named query catalogue

The main entry points are re-exported here.
"""

__version__ = "0.1.0"

from obslake.operators.history import latest_years, records, trends, yearly_trend  # noqa: E402
from obslake.operators.rollup import (daily_rollup, history_daily, observations_daily,  # noqa: E402
                                      season_rollup, to_long)
from obslake.operators.windows import (interval_trends, panes, window_ends,  # noqa: E402
                                       window_ends_direct, window_ends_join, window_ends_panes)
from obslake.session import build_session, checkpoint_dir  # noqa: E402
from obslake.sources.keyed import KeyedTable  # noqa: E402
from obslake.sources.tables import compact_expired, expire, merge_upsert, upsert_latest  # noqa: E402
from obslake.streaming.live import LiveIngest, LiveLocationData, LiveStation, LiveTrends, LiveTrendsUpdate  # noqa: E402

__all__ = [
    "build_session", "checkpoint_dir",
    "daily_rollup", "history_daily", "observations_daily", "season_rollup", "to_long",
    "records", "latest_years", "yearly_trend", "trends",
    "panes", "window_ends", "window_ends_join", "window_ends_panes", "window_ends_direct", "interval_trends",
    "upsert_latest", "merge_upsert", "expire", "compact_expired",
    "LiveTrends", "LiveTrendsUpdate", "LiveIngest", "LiveLocationData", "LiveStation",
    "KeyedTable",
]
