"""Plan-shape guards for the scale design (no data is compared here)."""

from obslake import fixtures
from obslake.operators import windows
from obslake.plans import catalog
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_ends_has_two_exchanges_and_no_result_sized_shuffle(spark):
    plan = _plan(windows.interval_trends(windows.window_ends(fixtures.observations(spark, SF_SMALL))))
    assert plan.count("Exchange") == 2            # events -> panes, panes -> (location, end bucket)
    assert "hashpartitioning(location" in plan and "ebucket" in plan


def test_scans_are_pruned_and_ranged(spark):
    plan = _plan(catalog.q_latest_trends_view(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan   # as-of range reaches Parquet
    daily = _plan(catalog.q_daily_rollup(spark, SF_SMALL))
    assert "l_comment" not in daily and "l_tax" not in daily                # unused columns pruned
    assert daily.count("Exchange") == 1                                    # partial + final aggregate
