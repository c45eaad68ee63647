"""SCD2 merge: hand-written cases (FIXTURES.md, section C) and property tests against a per-key fold."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from dayfold.operators import scd2

INF = dt.datetime(9999, 12, 31)
T0 = dt.datetime(2023, 1, 1)
RUN = dt.datetime(2024, 1, 3)
RUN2 = dt.datetime(2024, 1, 4)
ONE = dt.timedelta(seconds=1)

HIST = StructType([StructField("k", LongType()), StructField("a", StringType()), StructField("b", DoubleType()),
                   StructField("effective_from", TimestampNTZType()), StructField("effective_to", TimestampNTZType()),
                   StructField("deleted_flg", StringType())])
CHG = StructType([StructField("k", LongType()), StructField("a", StringType()), StructField("b", DoubleType()),
                  StructField("create_dt", TimestampNTZType()), StructField("update_dt", TimestampNTZType())])
KEYS = StructType([StructField("k", LongType())])


def sk(r):
    return tuple((v is None, 0 if v is None else v) for v in r)


def srt(rows):
    return sorted(rows, key=sk)


def run(spark, hist, chg, keys, at=RUN, **kw):
    h = spark.createDataFrame(hist, HIST)
    c = spark.createDataFrame(chg, CHG)
    k = spark.createDataFrame([(x,) for x in keys], KEYS) if keys is not None else None
    return sorted((tuple(r) for r in scd2.merge(h, c, k, "k", ["a", "b"], at, **kw).collect()), key=sk)


def test_recaptured_change_does_not_duplicate(spark):
    hist = [(1, "x", 1.0, T0, INF, "n")]
    chg = [(1, "y", 1.0, T0, dt.datetime(2024, 1, 2, 10))]
    first = run(spark, hist, chg, [1])
    again = run(spark, first, chg, [1], RUN2)
    assert first == again
    assert first == srt([(1, "x", 1.0, T0, dt.datetime(2024, 1, 2, 10) - ONE, "n"),
                            (1, "y", 1.0, dt.datetime(2024, 1, 2, 10), INF, "n")])


def test_null_update_time_closes_at_run_date(spark):
    out = run(spark, [(1, "x", 1.0, T0, INF, "n")], [(1, "y", 1.0, T0, None)], [1])
    assert out == srt([(1, "x", 1.0, T0, RUN - ONE, "n"), (1, "y", 1.0, RUN, INF, "n")])


def test_null_safe_comparison(spark):
    hist = [(1, None, 1.0, T0, INF, "n"), (2, "v", 1.0, T0, INF, "n"), (3, None, 1.0, T0, INF, "n")]
    upd = dt.datetime(2024, 1, 2)
    chg = [(1, "v", 1.0, T0, upd), (2, None, 1.0, T0, upd), (3, None, 1.0, T0, upd)]
    out = run(spark, hist, chg, [1, 2, 3])
    opened = [r for r in out if r[3] == upd]
    assert sorted(r[0] for r in opened) == [1, 2]
    assert (3, None, 1.0, T0, INF, "n") in out


def test_deleted_key_returning_is_not_reopened_by_default(spark):
    hist = [(1, "x", 1.0, T0, dt.datetime(2023, 6, 30, 23, 59, 59), "n"), (1, "x", 1.0, dt.datetime(2023, 7, 1), INF, "y")]
    chg = [(1, "z", 2.0, T0, dt.datetime(2024, 1, 2))]
    assert run(spark, hist, chg, [1]) == sorted(hist, key=sk)
    reopened = run(spark, hist, chg, [1], reopen=True)
    assert (1, "x", 1.0, dt.datetime(2023, 7, 1), dt.datetime(2024, 1, 2) - ONE, "y") in reopened
    assert (1, "z", 2.0, dt.datetime(2024, 1, 2), INF, "n") in reopened


def test_new_key_missing_from_key_set_is_opened_then_deleted(spark):
    out = run(spark, [], [(5, "x", 1.0, dt.datetime(2024, 1, 1, 8), None)], [])
    assert out == srt([(5, "x", 1.0, dt.datetime(2024, 1, 1, 8), RUN - ONE, "n"), (5, "x", 1.0, RUN, INF, "y")])


def test_latest_staged_row_wins(spark):
    chg = [(1, "old", 1.0, T0, dt.datetime(2024, 1, 2, 9)), (1, "new", 1.0, T0, dt.datetime(2024, 1, 2, 11))]
    out = run(spark, [(1, "x", 1.0, T0, INF, "n")], chg, [1])
    assert out == srt([(1, "x", 1.0, T0, dt.datetime(2024, 1, 2, 11) - ONE, "n"),
                          (1, "new", 1.0, dt.datetime(2024, 1, 2, 11), INF, "n")])


def test_changed_and_deleted_in_one_run(spark):
    upd = dt.datetime(2024, 1, 2)
    out = run(spark, [(1, "x", 1.0, T0, INF, "n")], [(1, "y", 1.0, T0, upd)], [])
    assert out == srt([(1, "x", 1.0, T0, upd - ONE, "n"), (1, "y", 1.0, upd, RUN - ONE, "n"), (1, "y", 1.0, RUN, INF, "y")])


def test_snapshot_merge_uses_run_date_bounds(spark):
    h = spark.createDataFrame([(1, "x", 1.0, T0, INF, "n"), (2, "q", 1.0, T0, INF, "n")], HIST)
    snap = spark.createDataFrame([(1, "y", 1.0), (3, "n", 1.0)], "k long, a string, b double")
    out = sorted((tuple(r) for r in scd2.merge_snapshot(h, snap, "k", ["a", "b"], RUN).collect()), key=sk)
    assert out == srt([(1, "x", 1.0, T0, RUN - ONE, "n"), (1, "y", 1.0, RUN, INF, "n"),
                          (2, "q", 1.0, T0, RUN - ONE, "n"), (2, "q", 1.0, RUN, INF, "y"), (3, "n", 1.0, RUN, INF, "n")])


# --- properties ---------------------------------------------------------------------------------------

def fold(hist, chg, keys, run_ts):
    """Naive per-key restatement of the merge rules, applied one key at a time."""
    out = [r for r in hist if not (r[4] == INF and r[5] in ("n", "y"))]
    by_key = {}
    for r in hist:
        by_key.setdefault(r[0], []).append(r)
    latest = {}
    for c in chg:
        # same order as the merge's max(struct(order, created, updated, a, b)), NULL lowest
        o = (c[4] or c[3], c[3], c[4] is not None, c[4] or T0, c[1] is not None, c[1] or "", c[2])
        if c[0] not in latest or o > latest[c[0]][0]:
            latest[c[0]] = (o, c)
    for k in set(by_key) | set(latest):
        versions = by_key.get(k, [])
        cur = next((r for r in versions if r[4] == INF and r[5] == "n"), None)
        tomb = [r for r in versions if r[4] == INF and r[5] == "y"]
        out += tomb
        c = latest.get(k, (None, None))[1]
        alive = k in keys
        new = c is not None and not versions
        changed = c is not None and cur is not None and (cur[1], cur[2]) != (c[1], c[2])
        at = (c[4] or run_ts) if c is not None else None
        deleted = not alive and (cur is not None or new)
        if cur is not None:
            end = at - ONE if changed else (run_ts - ONE if deleted else INF)
            out.append(cur[:4] + (end, "n"))
        if new or changed:
            out.append((k, c[1], c[2], c[3] if new else at, run_ts - ONE if deleted else INF, "n"))
        if deleted:
            src = c if (new or changed) else cur
            out.append((k, src[1], src[2], run_ts, INF, "y"))
    return sorted(out, key=sk)


keys_st = st.integers(0, 6)
attr_st = st.sampled_from([None, "p", "q"])
bal_st = st.sampled_from([1.0, 2.0])
hour_st = st.integers(0, 47)


@st.composite
def scenario(draw):
    hist = []
    for k in draw(st.sets(keys_st, max_size=5)):
        a, b = draw(attr_st), draw(bal_st)
        if draw(st.booleans()):
            hist.append((k, a, b, T0, INF, "n"))
        else:
            end = dt.datetime(2023, 6, 30, 23, 59, 59)
            hist += [(k, a, b, T0, end, "n"), (k, a, b, end + ONE, INF, "y")]
    chg = [(k, draw(attr_st), draw(bal_st), dt.datetime(2024, 1, 1),
            draw(st.one_of(st.none(), hour_st.map(lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)))))
           for k in draw(st.lists(keys_st, max_size=6))]
    keys = draw(st.sets(keys_st))
    return hist, chg, keys


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(scenario())
def test_merge_equals_per_key_fold_and_keeps_invariants(spark, sc):
    hist, chg, keys = sc
    out = run(spark, hist, chg, keys)
    assert out == fold(hist, chg, keys, RUN)
    by_key = {}
    for r in out:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        assert sum(1 for r in versions if r[4] == INF) <= 1          # at most one current version
        spans = sorted((r[3], r[4]) for r in versions)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))   # versions do not overlap
    assert run(spark, out, chg, keys) == out                          # re-applying the batch changes nothing


def test_merge_with_closed_history_apart_equals_merge_of_whole_history(spark):
    hist = [(1, "x", 1.0, T0, dt.datetime(2023, 6, 30, 23, 59, 59), "n"), (1, "x", 1.0, dt.datetime(2023, 7, 1), INF, "y"),
            (2, "p", 1.0, T0, dt.datetime(2023, 5, 1), "n"), (2, "q", 1.0, dt.datetime(2023, 5, 1, 0, 0, 1), INF, "n"),
            (3, "z", 2.0, T0, dt.datetime(2023, 2, 1), "n")]  # key 3: closed only, no current version
    chg = [(2, "r", 1.0, T0, dt.datetime(2024, 1, 2)), (3, "w", 1.0, T0, None), (4, "n", 1.0, T0, None)]
    whole = run(spark, hist, chg, [1, 2, 4])
    h = spark.createDataFrame(hist, HIST)
    cur, closed = h.where("effective_to = TIMESTAMP_NTZ'9999-12-31 00:00:00'"), h.where("effective_to < TIMESTAMP_NTZ'9999-12-31 00:00:00'")
    k = spark.createDataFrame([(x,) for x in [1, 2, 4]], KEYS)
    untouched, written = scd2.merge_parts(cur, spark.createDataFrame(chg, CHG), k, "k", ["a", "b"], RUN, closed=closed)
    assert srt(tuple(r) for r in untouched.unionByName(written).collect()) == whole
    assert not any(r[0] == 3 and r[5] == "n" and r[4] == INF for r in whole)  # seen in closed history: not new
