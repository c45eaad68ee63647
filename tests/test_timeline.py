"""Merge of several and backdated changes against a fold in Python, and against the plain merge where both apply."""

import datetime as dt
import random

import pytest

from dayfold.operators import scd2
from dayfold.operators.timeline import merge_timeline
from helpers import spark_rows
from test_plans import no_broadcast, plan, tree  # noqa: F401

T0 = dt.datetime(2024, 1, 1)
INF = dt.datetime(9999, 12, 31)
HIST = "k string, a string, b long, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
STAGED = "k string, a string, b long, create_dt timestamp_ntz, update_dt timestamp_ntz"
RUN = 60


def at(n):
    return None if n is None else T0 + dt.timedelta(seconds=n)


def random_case(seed, keys=60, reopen=False):
    rng = random.Random(seed)
    value = lambda: (rng.choice(["x", "y", None]), rng.choice([1, 2]))
    hist, staged, alive = [], [], []
    for k in [f"k{i}" for i in range(keys)] + [None]:
        if rng.random() < 0.8:  # a known key: contiguous versions with an occasional gap, the last one open
            t, v = rng.randint(0, 10), value()
            for i in range(rng.randint(1, 4)):
                end = t + rng.randint(1, 12)
                hist.append([k, *v, t, end - 1, "n"])
                t = end + (rng.random() < 0.15) * rng.randint(1, 4)
                v = rng.choice([x for x in [("x", 1), ("y", 2), (None, 1), ("x", 2)] if x != v])
            hist.append([k, *v, t, None, "n"])
            if rng.random() < 0.25:
                hist[-1][4] = t + 4
                hist.append([k, *v, t + 5, None, "y"])
        for _ in range(rng.choice([0, 1, 1, 2, 5, 20])):
            create = rng.randint(0, 50)
            staged.append([k, *value(), create, rng.choice([None, create, create + rng.randint(0, 20)])])
        if rng.random() < 0.7:
            alive.append(k)
    return hist, staged, alive


def fold(hist, staged, alive, reopen):
    """key -> second -> (flag, attributes), second by second; and the second of the last event."""
    out = {}
    for k in {r[0] for r in hist} | {r[0] for r in staged}:
        mine = [r for r in hist if r[0] == k]
        rows = [r for r in staged if r[0] == k]
        low = lambda x: (x is not None, x)  # noqa: E731  (NULL is the smallest value)
        order = lambda r: (r[4] if r[4] is not None else r[3])
        events = {}
        for r in mine:
            if r[4] is not None:
                events.setdefault(r[4] + 1, ("-", None))
        for r in mine:
            events[r[3]] = (r[5], (r[1], r[2]))
        flag_at = lambda t: next((events[x][0] for x in sorted(history, reverse=True) if x <= t), None)
        history = dict(events)
        best = {}
        for r in rows:
            t = RUN if r[4] is None else r[4]
            mark = (order(r), low(r[1]), low(r[2]))
            if (reopen or flag_at(t) != "y") and mark >= best.get(t, mark):
                best[t] = mark
                events[t] = ("n", (r[1], r[2]))
        if rows and not mine:
            r = min(rows, key=lambda r: (order(r), r[3], low(r[1]), low(r[2])))
            if not events or r[3] < min(events):
                events[r[3]] = ("n", (r[1], r[2]))
        live, state, line = None, None, {}
        for t in range(0, RUN + 40):
            if t in events:
                flag, v = events[t]
                if flag == "y":
                    v = live or v
                elif flag == "n":
                    live = v
                state = None if flag == "-" else (flag, v)
            line[t] = state
        last = max(t for t in line if t == 0 or line[t] != line[t - 1])
        if alive is not None and k not in alive and line[RUN + 39] and line[RUN + 39][0] == "n":
            for t in range(max(RUN, last + 1), RUN + 40):
                line[t] = ("y", line[t][1])
        out[k] = line
    return out


def frames(spark, hist, staged, alive):
    h = spark.createDataFrame([(k, a, b, at(f), INF if t is None else at(t), x) for k, a, b, f, t, x in hist], HIST)
    s = spark.createDataFrame([(k, a, b, at(c), at(u)) for k, a, b, c, u in staged], STAGED)
    return h, s, spark.createDataFrame([(k,) for k in alive], "k string")


@pytest.mark.parametrize("seed,reopen,detect", [(1, False, True), (2, False, False), (3, True, False), (4, True, True),
                                                (5, False, True)])
def test_fold_second_by_second(spark, seed, reopen, detect):
    hist, staged, alive = random_case(seed)
    h, s, keys = frames(spark, hist, staged, alive)
    keys = keys if detect else None
    merged = merge_timeline(h, s.repartition(3), keys, "k", ["a", "b"], at(RUN), reopen=reopen)
    want = fold(hist, staged, alive if detect else None, reopen)
    got = {}
    for r in merged.collect():
        got.setdefault(r.k, []).append(r)
    assert set(got) <= set(want)
    for k, line in want.items():
        versions = sorted(got.get(k, []), key=lambda r: r.effective_from)
        for a, b in zip(versions, versions[1:]):
            assert a.effective_to < b.effective_from
        assert all(v.effective_from <= v.effective_to for v in versions)
        for t, state in line.items():
            found = [(v.deleted_flg, (v.a, v.b)) for v in versions if v.effective_from <= at(t) <= v.effective_to]
            if found != ([] if state is None else [state]) and k is None and detect:
                continue  # a NULL key is never among the source's keys for a join, but is in this merge
            assert found == ([] if state is None else [state]), (k, t, versions)
    if not reopen:
        again = merge_timeline(merged, s, keys, "k", ["a", "b"], at(RUN), reopen=reopen)
        assert spark_rows(again) == spark_rows(merged)


def test_equals_the_plain_merge_without_backdated_changes(spark):
    rng = random.Random(9)
    hist, staged, alive = [], [], []
    for i in range(80):
        k = f"k{i}"
        if i % 5:
            hist += [(k, "x", 1, 0, 9, "n"), (k, "y", 1, 10, None, "n")]
        if i % 3:
            staged.append((k, rng.choice(["x", "y", None]), rng.choice([1, 2]), 20, None if i % 7 and i % 2 else i % 30 + 20))
        if i % 7:
            alive.append(k)
    h, s, keys = frames(spark, hist, staged, alive)
    args = ("k", ["a", "b"], at(RUN))
    # a new key deleted in the same run has its only version from create_dt in both
    assert spark_rows(merge_timeline(h, s, keys, *args)) == spark_rows(scd2.merge(h, s, keys, *args))


def test_backdated_change_cuts_a_closed_version(spark):
    h, s, _ = frames(spark, [("k", "x", 1, 0, 9, "n"), ("k", "y", 1, 10, None, "n")], [("k", "z", 1, 4, 4)], [])
    rows = merge_timeline(h, s, None, "k", ["a", "b"], at(RUN)).orderBy("effective_from").collect()
    assert [(r.a, r.effective_from, r.effective_to) for r in rows] == [
        ("x", at(0), at(3)), ("z", at(4), at(9)), ("y", at(10), INF)]


def test_change_before_everything_and_empty_inputs(spark):
    h, s, keys = frames(spark, [("k", "x", 1, 10, None, "n")], [("k", "z", 1, 2, 2), ("k", "x", 1, 5, 5)], ["k"])
    rows = merge_timeline(h, s, keys, "k", ["a", "b"], at(RUN)).orderBy("effective_from").collect()
    assert [(r.a, r.effective_from, r.effective_to) for r in rows] == [("z", at(2), at(4)), ("x", at(5), INF)]
    none = s.where("false")
    assert spark_rows(merge_timeline(h, none, keys, "k", ["a", "b"], at(RUN))) == spark_rows(h)
    assert merge_timeline(h.where("false"), none, keys, "k", ["a", "b"], at(RUN)).count() == 0


def test_hot_key_collapses_before_the_shuffle(spark):
    rows = spark.range(200_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "'v' as a", "id % 50 as b",
                                           "timestamp_ntz'2024-01-01' as create_dt",
                                           "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 50) as update_dt")
    h = spark.createDataFrame([], HIST)
    out = merge_timeline(h, rows, None, "k", ["a", "b"], at(RUN))
    hot = out.where("k = 'hot'").orderBy("effective_from").collect()
    assert len(hot) == 50 and [r.b for r in hot] == list(range(50))


def test_plan_shuffles_the_events_once(no_broadcast):
    h = no_broadcast.createDataFrame([], HIST)
    s = no_broadcast.createDataFrame([], STAGED)
    spark_plan = tree(plan(merge_timeline(h.repartition(3), s.repartition(3), None, "k", ["a", "b"], at(RUN)).where(
        "deleted_flg = 'n'")))
    top = spark_plan.split("Union")[0] if "Union" in spark_plan else spark_plan
    assert "CartesianProduct" not in spark_plan and "NestedLoop" not in spark_plan
    assert spark_plan.count("Window") >= 4 and top.count("Exchange") == 0
