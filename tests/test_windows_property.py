"""Property: the bucketed emission equals the window definition on adversarial inputs
(panes at bucket edges, gaps longer than a bucket, ties on ts, several locations)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from obslake.operators import windows
from obslake.schemas import OBSERVATION

EPOCH = dt.datetime(1970, 1, 1)
BASE = dt.datetime(2024, 1, 2)  # midnight: bucket edge
DAY = 86400

# offsets in seconds around bucket edges and far apart
offsets = st.one_of(
    st.integers(min_value=-7 * 3600, max_value=7 * 3600),                 # around the first midnight
    st.integers(min_value=DAY - 7 * 3600, max_value=DAY + 7 * 3600),      # around the next one
    st.integers(min_value=3 * DAY, max_value=3 * DAY + 600),              # after a gap > 1 bucket
    st.sampled_from([0, -60, 60, -21600, 21600, DAY - 21600, DAY, DAY + 59]),
)
rows_st = st.lists(st.tuples(st.sampled_from(["A", "B"]), offsets, st.integers(0, 3)),
                   min_size=1, max_size=40)


def brute(rows, w):
    out = {}
    for loc, ts, seq in rows:
        sec = int((ts - EPOCH).total_seconds())
        p = sec - sec % 60
        for end in range(p + 60, p + w + 1, 60):
            lo, hi = out.get((loc, end), ((ts, seq), (ts, seq)))
            out[(loc, end)] = (min(lo, (ts, seq)), max(hi, (ts, seq)))
    return {k: (lo[1], hi[1]) for k, (lo, hi) in out.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_st)
def test_bucketed_emission_matches_definition(spark, raw):
    rows, seen = [], set()
    for i, (loc, off, frac) in enumerate(raw):
        ts = BASE + dt.timedelta(seconds=off, microseconds=frac * 250000)
        rows.append((loc, ts, i))
        seen.add((loc, ts))
    df = spark.createDataFrame([(l, t, s, 1.0, 1.0, 1.0, "x") for l, t, s in rows], OBSERVATION)
    ivs = (60, 600, 21600)
    got = {}
    for r in windows.flat_ends(windows.window_ends(df, ivs)).collect():
        got[(r.interval_s, r.location, int((r.window_end - EPOCH).total_seconds()))] = (r.first_seq, r.last_seq)
    want = {}
    for w in ivs:
        for (loc, end), v in brute(rows, w).items():
            want[(w, loc, end)] = v
    assert got == want
