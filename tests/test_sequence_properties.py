"""Randomised checks of the time-split windows against a single plain window.

Timestamps are drawn around bucket edges and at exactly the horizon, where an off-by-one in the
look-ahead or the bucket arithmetic would show."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayfold.operators.sequence import lead_all, lead_split, neighbours_within
from dayfold.schemas import TRANSACTIONS

BASE = dt.datetime(2021, 3, 1)
WITHIN = dt.timedelta(minutes=10)
SPLIT = 2  # buckets of 20 minutes

# offsets (seconds) near multiples of the bucket width and the horizon, plus sub-second jitter
edge = st.sampled_from([0, 1, 599, 600, 601, 1199, 1200, 1201, 1799, 1800, 2400, 3599, 3600, 7200, 86399, 86400])
offset = st.tuples(st.integers(0, 5), edge, st.sampled_from([0, 250000, 999999])).map(
    lambda t: dt.timedelta(minutes=20 * t[0], seconds=t[1], microseconds=t[2]))


@st.composite
def events(draw, nulls=False):
    rows = []
    for i, off in enumerate(draw(st.lists(offset, min_size=1, max_size=25))):
        card = draw(st.sampled_from(["A", "B", None] if nulls else ["A", "B"]))
        at = None if nulls and draw(st.integers(0, 5)) == 0 else BASE + off
        rows.append((f"{i:03d}", at, Decimal(draw(st.integers(1, 9))), card, "P",
                     draw(st.sampled_from(["REJECT", "SUCCESS"])), "T"))
    return rows


def rows_within(df, offsets):
    near = [F.when(F.col(f"next{i}_trans_date") - F.col("trans_date") <= F.lit(WITHIN), F.col(f"next{i}_{c}"))
            for i in range(1, offsets + 1) for c in ("amt", "trans_date")]
    return sorted(tuple(r) for r in df.select("trans_id", *near).collect())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events())
def test_neighbours_within_equals_plain_window_inside_the_horizon(spark, rows):
    df = spark.createDataFrame(rows, TRANSACTIONS)
    got = neighbours_within(df, "card_num", "trans_date", "trans_id", ["amt", "trans_date"], 3, WITHIN, SPLIT)
    ref = lead_all(df, "card_num", "trans_date", "trans_id", ["amt", "trans_date"], 3)
    assert got.count() == len(rows)
    assert rows_within(got, 3) == rows_within(ref, 3)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events(nulls=True))
def test_lead_split_equals_plain_window(spark, rows):
    df = spark.createDataFrame(rows, TRANSACTIONS)
    cols = ["amt", "trans_date"]
    got = lead_split(df, "card_num", "trans_date", "trans_id", cols, 3, dt.timedelta(minutes=20))
    ref = lead_all(df, "card_num", "trans_date", "trans_id", cols, 3)
    assert sorted(map(str, got.collect())) == sorted(map(str, ref.select(*got.columns).collect()))


def test_epoch_seconds_ignore_session_time_zone_and_dst(spark):
    from dayfold.functions import epoch_seconds

    vals = [dt.datetime(2021, 3, 14, 1, 59, 59, 500000), dt.datetime(2021, 3, 14, 2, 30),
            dt.datetime(2021, 3, 14, 3, 0, 1), dt.datetime(2021, 11, 7, 1, 30), dt.datetime(1969, 12, 31, 23, 59, 59)]
    want = [int((v - dt.datetime(1970, 1, 1)).total_seconds() // 1) for v in vals]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(v,) for v in vals], "ts timestamp_ntz")
        assert [r[0] for r in df.select(epoch_seconds("ts")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
