"""The daily run: capture, facts, history dimensions, fraud report, watermarks — on a warehouse root.

``run_day`` is one cron run of the original job, expressed as Spark writes into the run-keyed layout of
``dayfold.sinks.writers``. Everything that comes from outside is staged under the run first — a source's increment
before its keys, so a row inserted in between is not taken for deleted — and the merge, the facts and the watermarks
read what was staged. The commit is written last; until then nothing of the run is visible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions import as_date
from dayfold.operators import rules, scd2, watermark
from dayfold.operators.temporal import card_profile
from dayfold.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, DIM_ACCOUNTS, DIM_CARDS, DIM_CLIENTS, \
    DIM_TERMINALS, FACTS, REJECTS, REPORT, TERMINALS_DIM, DimSpec
from dayfold.sinks import writers as W
from dayfold.sinks.archive import input_files
from dayfold.sinks.deltas import BucketedHistory
from dayfold.sources import BAD_CELLS, capture_increment, capture_keys

DIM_SCHEMAS = {"cards": DIM_CARDS, "accounts": DIM_ACCOUNTS, "clients": DIM_CLIENTS, "terminals": DIM_TERMINALS}
SPECS = {spec.name: spec for spec in (CARDS, ACCOUNTS, CLIENTS, TERMINALS_DIM)}


@dataclass(frozen=True)
class Warehouse:
    """A warehouse root on shared storage (object store / HDFS), never a machine-local folder.

    ``layout``: ``complete`` writes the complete current set of every dimension with each run, ``buckets`` only what the
    run changed (``sinks.deltas``). A root keeps the layout (and number of buckets) it began with."""

    root: str
    layout: str = "complete"
    buckets: int = 64

    @property
    def base(self) -> str:
        return self.root.rstrip("/")


@dataclass(frozen=True)
class DailyInputs:
    """Where a run's inputs come from. File drops are functions of the run date."""

    transactions: Callable[[dt.date], DataFrame]
    terminals: Callable[[dt.date], DataFrame]
    blacklist: Callable[[dt.date], DataFrame]
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame

    def with_transactions(self, day_df: DataFrame) -> "DailyInputs":
        return replace(self, transactions=lambda _d: day_df)


@dataclass(frozen=True)
class RuleConfig:
    travel_within: dt.timedelta = rules.TRAVEL_WITHIN
    probe_within: dt.timedelta = rules.PROBE_WITHIN
    reopen_deleted: bool = False
    fact_seed: dt.date = watermark.FACT_SEED


def _staged(run: W.Attempt, inputs: DailyInputs, seen: dict[str, dt.date], pool: ThreadPoolExecutor):
    """Write all inputs of the run; returns the staged frames. Sources are independent and staged side by side."""
    seed = watermark.SOURCE_SEED

    def source(spec: DimSpec, src: DataFrame):
        increment = capture_increment(src, seen.get(spec.name, seed), spec.created, spec.updated)
        cols = [spec.key, *spec.attrs, spec.created, spec.updated]
        return (run.write(f"_staging/{spec.name}", increment.select(*cols)),
                run.write(f"_staging/{spec.name}_keys", capture_keys(src, spec.key)))

    jobs = {spec.name: pool.submit(source, spec, src) for spec, src in (
        (CARDS, inputs.cards), (ACCOUNTS, inputs.accounts), (CLIENTS, inputs.clients))}
    drops = {"transactions": inputs.transactions, "terminals": inputs.terminals, "blacklist": inputs.blacklist}
    drops = {name: drop(run.run) for name, drop in drops.items()}
    run.files |= input_files(*drops.values(), apart_from=run.root)
    jobs |= {name: pool.submit(run.write, f"_staging/{name}", df) for name, df in drops.items()}
    return {name: job.result() for name, job in jobs.items()}


def bucketed(spark: SparkSession, wh: Warehouse, name: str) -> BucketedHistory:
    return BucketedHistory(spark, wh.base, f"dim_{name}_hist", SPECS[name].key, DIM_SCHEMAS[name], wh.buckets)


def read_dimension(spark: SparkSession, wh: Warehouse, name: str, run: dt.date, commits: W.Committed | None = None,
                   since: dt.date | None = None) -> DataFrame:
    commits = commits or W.read_commits(spark, wh.base)
    if wh.layout == "buckets":
        return bucketed(spark, wh, name).history(commits, run, since)
    return W.read_history(spark, wh.base, f"dim_{name}_hist", DIM_SCHEMAS[name], commits, run, since)


def read_facts(spark: SparkSession, wh: Warehouse, first_day: dt.date | None = None, last_day: dt.date | None = None,
               commits: W.Committed | None = None) -> DataFrame:
    """Committed facts of ``first_day..last_day``, from the runs that wrote rows of those days."""
    commits = commits or W.read_commits(spark, wh.base)
    df = W.read_runs(spark, wh.base, "fact_transactions", FACTS, commits.attempts,
                     commits.runs("fact_transactions", first_day, last_day))
    if first_day is not None:
        df = df.where(F.col("trans_day") >= F.lit(first_day))
    return df if last_day is None else df.where(F.col("trans_day") <= F.lit(last_day))


def read_blacklist(spark: SparkSession, wh: Warehouse) -> DataFrame:
    commits = W.read_commits(spark, wh.base)
    return W.read_runs(spark, wh.base, "fact_passport_blacklist", BLACKLIST, commits.attempts,
                       commits.runs("fact_passport_blacklist"))


def read_rejects(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Transactions that were not loaded: no operation time, or cells that could not be parsed."""
    commits = W.read_commits(spark, wh.base)
    return W.read_runs(spark, wh.base, "rejected_transactions", REJECTS, commits.attempts,
                       commits.runs("rejected_transactions"))


def read_report(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The accumulated report of all committed runs."""
    commits = W.read_commits(spark, wh.base)
    return W.read_runs(spark, wh.base, "rep_fraud", REPORT, commits.attempts,
                       commits.runs("rep_fraud")).select(*rules.REPORT_COLS)


def run_day(spark: SparkSession, wh: Warehouse, inputs: DailyInputs, run_date=None,
            config: RuleConfig = RuleConfig()) -> dt.date:
    """Load one day and append its fraud report. Returns the run date.

    Without ``run_date`` the day after the fact watermark is loaded (its seed before the first run). Re-running the
    last run replaces it; an older one is refused, since later runs are built on it: replay from there (``backfill``
    with ``replay=True``)."""
    commits = W.read_commits(spark, wh.base)
    if run_date is None:
        last = commits.last()
        seen = commits.marks.get(last, {})
        run_date = seen.get("fact_transactions", config.fact_seed) + dt.timedelta(days=1)
    d = as_date(run_date)
    if (last := commits.last()) is not None and d < last:
        raise ValueError(f"run {d} is older than committed run {last}: replay from {d}")
    return _run(spark, wh, inputs, d, config, commits)


def _run(spark: SparkSession, wh: Warehouse, inputs: DailyInputs, d: dt.date, config: RuleConfig,
         commits: W.Committed) -> dt.date:
    prev = commits.last(before=d)
    seen = commits.marks.get(prev, {})
    seed = watermark.SOURCE_SEED
    run = W.Attempt(spark, wh.base, d)
    with ThreadPoolExecutor(max_workers=6) as pool:  # independent jobs: their stages run side by side
        staged = _staged(run, inputs, seen, pool)
        # 1. facts of the drop, whatever days they carry; rows without a time or with bad cells are kept apart
        drop = staged["transactions"]
        bad = F.col("trans_date").isNull()
        if BAD_CELLS in drop.columns:
            bad = bad | (F.size(BAD_CELLS) > 0)
        else:
            drop = drop.withColumn(BAD_CELLS, F.array().cast("array<string>"))
        good = drop.where(~bad).drop(BAD_CELLS).withColumn("trans_day", F.to_date("trans_date"))
        jobs = [pool.submit(run.write, "fact_transactions", good.select(*FACTS.names), "trans_day"),
                pool.submit(run.write, "rejected_transactions", drop.where(bad).select(*REJECTS.names))]
        # 2. blacklist entries newer than the watermark
        new_bl = W.new_entries(staged["blacklist"], seen.get("passport_blacklist", seed))
        jobs.append(pool.submit(run.write, "fact_passport_blacklist", new_bl.select(*BLACKLIST.names), "entry_dt"))
        # 3. history dimensions. Every key the merge has ever seen has a current version, live or deleted, so the
        #    closed versions are not read
        for spec in (CARDS, ACCOUNTS, CLIENTS, TERMINALS_DIM):
            changes, keys = staged[spec.name] if spec.created else (staged["terminals"], None)
            if wh.layout == "buckets":
                jobs.append(pool.submit(bucketed(spark, wh, spec.name).load, run, commits, prev, changes, keys, spec.attrs,
                                        spec.created, spec.updated, config.reopen_deleted))
                continue
            table = f"dim_{spec.name}_hist"
            current = W.read_current(spark, wh.base, table, DIM_SCHEMAS[spec.name], commits, prev)
            cols = [spec.key, *spec.attrs] + ([spec.created, spec.updated] if spec.created else [])
            _, versions = scd2.merge_parts(current, changes.select(*cols), keys, spec.key, spec.attrs, d, spec.created,
                                           spec.updated, config.reopen_deleted and keys is not None)
            jobs.append(pool.submit(run.write_history, table, versions))
        for job in jobs:
            job.result()

    # what readers will see once this run is committed
    own = {(d, name): bounds for name, bounds in run.written.items()}
    view = W.Committed(commits.attempts | {d: run.attempt}, commits.marks,
                       {k: v for k, v in commits.tables.items() if k[0] != d} | own)
    # 4. card profile: card -> account -> client as validity segments over the instants this run looks
    #    up, built from the dimensions only, so the day's facts need one temporal join instead of three
    start = dt.datetime.combine(d, dt.time())
    since = start - config.probe_within
    dims = [read_dimension(spark, wh, n, d, view, since.date()) for n in ("cards", "accounts", "clients", "terminals")]
    last = start + dt.timedelta(days=1) - dt.timedelta(microseconds=1)
    profile = run.write("dim_card_profile", card_profile(*dims[:3], window=(since, last)))
    # 5. report: facts of the day (and the probing window before it), dimensions as of this run
    facts = read_facts(spark, wh, since.date(), d, view)
    report = rules.build_report(facts, *dims, staged["blacklist"], d, config.travel_within, config.probe_within,
                                profile=profile)
    run.write("rep_fraud", report, "report_dt")
    # 6. the commit, from what was staged
    marks = watermark.advance_facts(drop.where(~bad), "fact_transactions", d)
    marks = marks.unionByName(watermark.advance_entries(staged["blacklist"], "passport_blacklist",
                                                        seen.get("passport_blacklist", seed)))
    for spec in (CARDS, ACCOUNTS, CLIENTS):
        marks = marks.unionByName(watermark.advance_source(staged[spec.name][0], spec.name, seen.get(spec.name, seed)))
    run.commit([(r.table_name, r.max_date) for r in marks.collect()])  # one row per source
    return d


def backfill(spark: SparkSession, wh: Warehouse, inputs: DailyInputs, days, config: RuleConfig = RuleConfig(),
             replay: bool = False):
    """Run consecutive days in order (each day reads what the previous one committed). ``replay`` allows days before
    the last committed run; all runs from the first of ``days`` on must then be among them."""
    days = [as_date(x) for x in days]
    if not replay:
        return [run_day(spark, wh, inputs, day, config) for day in days]
    later = {x for x in W.read_commits(spark, wh.base).attempts if days and x >= min(days)}
    if later - set(days):
        raise ValueError(f"a replay must include the later runs {sorted(later - set(days))}")
    return [_run(spark, wh, inputs, day, config, W.read_commits(spark, wh.base)) for day in sorted(days)]
