"""The sweep against the interval join, and delete detection by digests against the anti-join."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from dayfold.operators import keydigest, scd2
from dayfold.operators.sweep import sweep_join
from dayfold.operators.temporal import dim_view, temporal_join
from helpers import spark_rows
from test_plans import no_broadcast, plan, tree  # noqa: F401

T0 = dt.datetime(2024, 1, 1)
INF = dt.datetime(9999, 12, 31)
DIM = "k string, a string, n long, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
FACTS = "id long, k string, t timestamp_ntz, a string"


def random_inputs(spark, seed, overlap=False):
    rng = random.Random(seed)
    at = lambda s: T0 + dt.timedelta(seconds=s)
    dims = []
    for k in ["hot", "a", "b", "c", None]:
        t = rng.randint(0, 100_000)
        for i in range(300 if k == "hot" else rng.randint(0, 6)):
            n = rng.randint(1, 4000)
            dims.append((k, f"{k}{i}", i, at(t), at(t + n - 1), "n"))
            t += n + rng.choice([0, 0, 0, rng.randint(0, 100_000)])
        dims.append((k, None, -1, at(t), INF, rng.choice("ny")))
    dims.append(("a", "no start", 0, None, INF, "n"))
    if overlap:
        dims.append(("hot", "clash", 0, at(150_000), at(250_000), "n"))
    facts = [(i, rng.choice(["hot", "hot", "a", "b", "c", "unknown", None]),
              rng.choice([None] + [at(rng.randint(0, 900_000))] * 30), "fact's own") for i in range(3000)]
    facts += [(9000 + i, k, f, "edge") for i, (k, _, _, f, _, _) in enumerate(dims) if k]
    facts += [(19000 + i, k, t, "edge") for i, (k, _, _, _, t, _) in enumerate(dims) if k and t != INF]
    return (spark.createDataFrame(facts, FACTS).repartition(3), dim_view(spark.createDataFrame(dims, DIM), "k", ["n"], "_d"))


@pytest.mark.parametrize("bucket", [dt.timedelta(hours=1), dt.timedelta(days=1), dt.timedelta(days=400)])
def test_sweep_equals_the_interval_join(spark, bucket):
    facts, view = random_inputs(spark, bucket.days)
    want = temporal_join(facts, view, "k", "t", "_d", keep_validity=True)
    assert spark_rows(sweep_join(facts, view, "k", "t", "_d", bucket, keep_validity=True)) == spark_rows(want)


def test_sweep_of_empty_sides(spark):
    facts, view = random_inputs(spark, 2)
    none = sweep_join(facts, view.where("false"), "k", "t", "_d")
    assert none.count() == facts.count() and none.where("n is not null").count() == 0
    assert sweep_join(facts.where("false"), view, "k", "t", "_d").count() == 0


def test_sweep_refuses_overlapping_versions(spark):
    facts, view = random_inputs(spark, 3, overlap=True)
    with pytest.raises(Exception, match="overlapping versions of key hot"):
        sweep_join(facts, view, "k", "t", "_d").collect()


def test_sweep_cuts_a_hot_key_and_moves_facts_once(no_broadcast):
    facts, view = random_inputs(no_broadcast, 4)
    joined = sweep_join(facts, view, "k", "t", "_d", dt.timedelta(hours=6))
    t = tree(plan(joined))
    assert "SortMergeJoin" in t and "NestedLoop" not in t
    side = t.split("SortMergeJoin", 1)[1].split("SortMergeJoin")[0]
    assert len(re.findall(r"Window \(", side.split("Union")[0])) >= 1  # the window's output is joined as it lies
    groups = facts.where("k = 'hot'").select(F.expr("date_trunc('HOUR', t)")).distinct().count()
    assert groups > 100


# --- digests ------------------------------------------------------------------------------------------------------

def history(spark, n):
    return spark.range(n).selectExpr(
        "concat('k', id) as k", "cast(id as string) as a", "id as n", "timestamp_ntz'2023-01-01' as effective_from",
        "if(id % 10 = 0, timestamp_ntz'2023-06-01', timestamp_ntz'9999-12-31') as effective_to", "'n' as deleted_flg")


def test_only_keys_of_unequal_buckets_are_read(spark):
    h = history(spark, 40_000)
    live = scd2.current(h)
    keys = live.where("n % 4001 <> 7").select("k").repartition(3)
    some = keydigest.differing(keydigest.digests(live, "k"), keydigest.digests(keys, "k"))
    gone = scd2.deleted_keys(h, keys, "k", ["a"], "2024-01-03")
    assert 0 < some.count() <= gone.count() < 12
    read = keydigest.in_buckets(keys, "k", some).count()
    print(f"{read / keys.count():.5f} of the source's keys are compared")
    assert read < 0.001 * keys.count()
    assert spark_rows(keydigest.deleted_keys(h, keys, "k", ["a"], "2024-01-03")) == spark_rows(gone)


def test_digests_of_odd_key_sets(spark):
    h = history(spark, 300).unionByName(history(spark, 1).withColumn("k", F.lit(None).cast("string")).withColumn(
        "effective_to", F.expr("timestamp_ntz'9999-12-31'")))
    keys = scd2.current(h).select("k").where("k <> 'k5'")
    odd = keys.unionByName(keys.limit(20)).unionByName(keys.selectExpr("concat('new', k) as k")).unionByName(
        keys.selectExpr("cast(null as string) as k"))
    want = spark_rows(scd2.deleted_keys(h, odd, "k", ["a", "n"], "2024-01-03"))
    for parents, children in ((256, 256), (4, 2), (1, 1)):
        got = keydigest.deleted_keys(h, odd, "k", ["a", "n"], "2024-01-03", parents=parents, children=children)
        assert spark_rows(got) == want and len(want) == 2
    assert keydigest.deleted_keys(h.where("false"), odd, "k", ["a"], "2024-01-03").count() == 0
    everything = keydigest.deleted_keys(h, keys.where("false"), "k", ["a"], "2024-01-03")
    assert everything.count() == scd2.current(h).count()


def test_digests_are_carried_from_run_to_run(spark):
    live = scd2.current(history(spark, 500)).select("k")
    opened = spark.range(500, 540).selectExpr("concat('k', id) as k")
    closed = live.where("k like 'k%3'")
    then = live.unionByName(opened).join(closed, "k", "left_anti")
    carried = keydigest.advanced(keydigest.digests(live, "k"), keydigest.digests(opened, "k"), keydigest.digests(closed, "k"))
    assert spark_rows(carried) == spark_rows(keydigest.digests(then, "k"))
    assert keydigest.differing(carried, keydigest.digests(then.repartition(7), "k")).count() == 0
