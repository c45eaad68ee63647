"""Sequence patterns against a backward walk in Python, and the amount-probing rule as a special case."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dayfold.operators.patterns import FALLING, PROBING, Step, match_chains, probing_chains
from dayfold.plans import contract
from dayfold.plans import fixtures as fx
from helpers import spark_rows
from test_plans import no_broadcast, plan, tree  # noqa: F401

T0 = dt.datetime(2024, 1, 1)
ROWS = "id string, k string, t timestamp_ntz, r string, amt long"


def random_rows(seed, n=1500):
    rng = random.Random(seed)
    rows = [(f"{i:05d}", rng.choice(["hot", "hot", "a", "b", None]),
             rng.choice([None] + [T0 + dt.timedelta(seconds=rng.randint(0, 8 * n), microseconds=rng.choice([0, 0, 500_000]))] * 30),
             rng.choice("RRRSSX") if rng.random() > 0.02 else None, rng.choice([None] + [*range(1, 60)] * 2)) for i in range(n)]
    t = T0 + dt.timedelta(days=3)
    for i in range(9):  # a chain of eight rejections that ends well, one step a second, over a bucket's edge
        rows.append((f"x{i}", "long", t + dt.timedelta(seconds=i), "S" if i == 8 else "R", 100 - i))
    return rows


def walk(rows, steps, match, within, falling):
    """id of each chain's last row -> (start, rows, repeats of the first step)."""
    out = {}
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key and r[2] is not None), key=lambda r: (r[2], r[0]))
        label = [next((i for i, m in enumerate(match) if r[3] is not None and r[3] in m), None) for r in mine]

        def linked(i):
            if not falling:
                return i > 0
            a, b = mine[i - 1][4] if i else None, mine[i][4]
            return i > 0 and a is not None and b is not None and b < a

        def run_start(i):
            while i > 0 and linked(i) and label[i - 1] == label[i]:
                i -= 1
            return i

        for e, r in enumerate(mine):
            if label[e] != len(steps) - 1 or e - run_start(e) + 1 != steps[-1].low:
                continue
            first, ok = run_start(e), True
            for s in range(len(steps) - 2, 0, -1):
                p = first - 1
                if not (linked(first) and label[p] == s):
                    ok = False
                    break
                f = run_start(p)
                if not steps[s].low <= p - f + 1 <= (steps[s].high or 10**9):
                    ok = False
                    break
                first = f
            if not ok or not linked(first) or label[first - 1] != 0:
                continue
            begin = run_start(first - 1)
            while begin < first and (mine[begin][2] < r[2] - within or first - begin > (steps[0].high or 10**9)):
                begin += 1
            if first - begin >= steps[0].low:
                out[r[0]] = (mine[begin][2], e - begin + 1, first - begin)
    return out


R, S, X = "r = 'R'", "r = 'S'", "r = 'X'"


@pytest.mark.parametrize("steps,match,falling", [
    ([Step(R, 2, None), Step(S)], "RS", True), ([Step(R, 1, 2), Step(S)], "RS", True),
    ([Step(R, 2, None), Step(S, 2, 2)], "RS", False), ([Step(R, 1, None), Step(X, 1, 2), Step(S)], "RXS", False),
    ([Step(R, 2, 3), Step(S, 1, None), Step(X)], "RSX", False)])
def test_patterns_equal_a_backward_walk(spark, steps, match, falling):
    rows = random_rows(len(steps) + falling)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    total = 0
    for within in (dt.timedelta(seconds=40), dt.timedelta(minutes=30)):
        got = match_chains(df, steps, "k", "t", "id", within, "amt < previous_amt" if falling else "true", ["amt"])
        want = walk(rows, steps, match, within, falling)
        assert {r.id: (r.chain_start, r.chain_rows, r.chain_repeats) for r in got.collect()} == want
        total += len(want)
    assert total > 0


def test_long_chain_is_one_match(spark):
    df = spark.createDataFrame(random_rows(1), ROWS).withColumnsRenamed({"r": "x"}).withColumn(
        "oper_result", F.expr("CASE x WHEN 'R' THEN 'REJECT' WHEN 'S' THEN 'SUCCESS' END"))
    rows = match_chains(df, PROBING, "k", "t", "id", dt.timedelta(minutes=20), FALLING, ["amt"]).where("k = 'long'").collect()
    assert [(r.id, r.chain_rows, r.chain_repeats) for r in rows] == [("x8", 9, 8)]
    assert match_chains(df.where("false"), PROBING, "k", "t", "id", dt.timedelta(minutes=20), FALLING, ["amt"]).count() == 0
    with pytest.raises(ValueError):
        match_chains(df, [Step(R), Step(S, 1, None)], "k", "t", "id", dt.timedelta(minutes=20))


def test_amount_probing_is_a_special_case(spark):
    ends = probing_chains(fx.transactions(spark, SF_SMALL), contract.PROBE)
    rule = contract.fraud_amount_probing_replay(spark, SF_SMALL)
    assert spark_rows(ends.select("trans_date")) == spark_rows(rule.select("event_dt")) and rule.count() > 0


def test_one_shuffle_for_all_steps(no_broadcast):
    df = no_broadcast.createDataFrame([], ROWS).repartition(3, "id")
    t = tree(plan(match_chains(df, [Step(R, 2, None), Step(X), Step(S)], "k", "t", "id", dt.timedelta(minutes=5))))
    assert t.count("Exchange hashpartitioning") + t.count("Exchange (") <= 2 and "Join" not in t
