"""Driver contract and oracle parity on the small tables."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# quick ones; the full list runs through tools/oracle_check.py at sf0.01
PARITY = ["daily_rollup", "season_rollup", "records_extreme", "records_reference_order", "yearly_trend",
          "window_ends_600", "interval_trends", "interval_trends_join", "line_parse", "corrupt_split",
          "upsert_latest", "latest_trends_view", "trends_view_json", "stream_daily_rollup"]


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["season", "year", "measure", "value", "trend", "has_prev"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    from __spark_entry__ import oracle_sql, queries
    from obslake.plans.catalog import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", PARITY)
def test_oracle_parity(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, SF_SMALL)
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, cur.fetchall())
