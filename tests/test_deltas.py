"""The bucketed layout: same history as the plain merge, writes that follow the changes, reads that move no base row."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from dayfold.operators import scd2
from dayfold.sinks import Attempt, read_commits
from dayfold.sinks.deltas import BucketedHistory, run_tables
from dayfold.functions import inf
from helpers import spark_rows
from test_plans import no_broadcast, plan, tree  # noqa: F401

TS = TimestampNTZType()
DIM = StructType([StructField("k", LongType()), StructField("a", StringType()), StructField("n", LongType()),
                  StructField("effective_from", TS), StructField("effective_to", TS), StructField("deleted_flg", StringType())])
START = dt.date(2024, 1, 1)
ROWS, RUNS = 4000, 6


def day(n):
    return START + dt.timedelta(days=n)


def first(spark, rows=ROWS):
    return spark.range(rows).selectExpr("id AS k", "'a0' AS a", "id AS n", "timestamp_ntz'2023-01-01' AS effective_from",
                                        "timestamp_ntz'9999-12-31' AS effective_to", "'n' AS deleted_flg")


def changes(spark, n):
    """40 changed or re-sent keys of that day and two new ones."""
    t = f"timestamp_ntz'{day(n)} 08:00:00'"
    old = spark.range(40).selectExpr(f"(id * 97 + {n} * 31) % {ROWS} AS k", f"if(id % 5 = 0, 'a0', 'a{n}') AS a",
                                     f"(id * 97 + {n} * 31) % {ROWS} AS n", f"{t} AS create_dt", f"{t} AS update_dt")
    new = spark.range(2).selectExpr(f"{ROWS} + 2 * {n} + id AS k", "'new' AS a", "id AS n", f"{t}", "CAST(NULL AS timestamp_ntz)")
    return old.union(new)


def keys(spark, n):
    """Each fifth day two more keys are gone."""
    gone = [3 * i + 1 for i in range(2 * (n // 5))]
    return spark.range(ROWS + 2 * n + 2).selectExpr("id AS k").where(~F.col("k").isin(gone or [-1]))


def size(root, table, run):
    top = f"{root}/{table}/run={run}"
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet"))


def cols(df):
    return df.select(*DIM.names)


def load(spark, store, root, n, commit=True, **kw):
    commits, run = read_commits(spark, root), Attempt(spark, root, day(n))
    out = store.load(run, commits, commits.last(before=day(n)), changes(spark, n), keys(spark, n), ["a", "n"], **kw)
    if commit:
        run.commit([])
    return out


def test_runs_write_what_they_change(spark, tmp_path):
    root = str(tmp_path)
    store = BucketedHistory(spark, root, "dim", "k", DIM, buckets=8, max_deltas=4, share=0.4, digest=(16, 16))
    run = Attempt(spark, root, START)
    store.start(run, first(spark))
    run.commit([])
    base = size(root, "dim_base", START)
    written, folded = [], 0
    for n in range(1, RUNS + 1):
        commits, run = read_commits(spark, root), Attempt(spark, root, day(n))
        out = store.load(run, commits, commits.last(), changes(spark, n), keys(spark, n) if n % 5 == 0 else None, ["a", "n"])
        run.commit([])
        folded += out["folded"]
        written.append((out["folded"], sum(size(root, f"dim{p}", day(n)) for p in ("_delta", "_closed"))))
        assert out["delta"] <= 42 + 2 * (n // 5) and out["closed"] <= 42 + 2 * (n // 5)
    quiet = [b for f, b in written if not f]
    assert len(quiet) >= RUNS // 2 and max(b for _, b in written) < base  # a complete set is the base's size every day
    assert 0 < folded <= 2 * ROWS  # rewritten every fourth run, not every run
    commits = read_commits(spark, root)
    layout = store.layout(commits, day(RUNS))
    assert all(len(deltas) < 4 for _, _, deltas, _ in layout.values())
    want = first(spark)
    for n in range(1, RUNS + 1):
        want = scd2.merge(want, changes(spark, n), keys(spark, n) if n % 5 == 0 else None, "k", ["a", "n"], day(n)).checkpoint()
    assert spark_rows(cols(store.history(commits, day(RUNS)))) == spark_rows(cols(want))


def test_failed_and_repeated_runs(spark, tmp_path):
    root = str(tmp_path)
    store = BucketedHistory(spark, root, "dim", "k", DIM, buckets=4, digest=(4, 4))
    assert store.current(read_commits(spark, root), None).count() == 0
    run = Attempt(spark, root, START)
    store.load(run, read_commits(spark, root), None, first(spark, 50).selectExpr(
        "k", "a", "n", "effective_from AS create_dt", "CAST(NULL AS timestamp_ntz) AS update_dt"), None, ["a", "n"])
    run.commit([])  # a first run without a base folds everything at once
    assert spark_rows(cols(store.current(read_commits(spark, root), START))) == spark_rows(first(spark, 50))
    load(spark, store, root, 1, commit=False)
    seen = read_commits(spark, root)
    assert seen.last() == START and store.current(seen, START).count() == 50
    load(spark, store, root, 1)
    one = spark_rows(store.history(read_commits(spark, root), day(1)))
    load(spark, store, root, 1)
    seen = read_commits(spark, root)
    assert spark_rows(store.history(seen, day(1))) == one
    assert spark_rows(cols(store.history(seen, START))) == spark_rows(first(spark, 50))  # as of the run before
    again = scd2.merge(first(spark, 50), changes(spark, 1), keys(spark, 1), "k", ["a", "n"], day(1))
    assert one == spark_rows(cols(again))
    since = store.history(seen, day(1), since=day(1))
    assert since.where(F.to_date("effective_to") < F.lit(day(1))).count() == 0


def test_reads_move_no_base_row(no_broadcast, tmp_path):
    spark, root = no_broadcast, str(tmp_path)
    store = BucketedHistory(spark, root, "dim", "k", DIM, buckets=4, digest=(4, 4))
    run = Attempt(spark, root, START)
    store.start(run, first(spark, 400))
    run.commit([])
    load(spark, store, root, 1)
    commits = read_commits(spark, root)
    assert any(deltas for _, _, deltas, _ in store.layout(commits, day(1)).values())
    for df in (store.current(commits, day(1)), store.of_keys(commits, day(1), spark.range(9).selectExpr("id AS k"))):
        t = tree(plan(df))
        above = t[:t.index("dayfold_")]
        first_join = above[above.rindex("SortMergeJoin"):]
        assert "Exchange" not in first_join, t  # the base side is scanned, filtered and joined where it lies
    assert "NestedLoop" not in t and len(run_tables("dim")) == 7
