"""Contract queries: every operator applied to the fixture tables derived from the driver's Parquet.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match the DuckDB oracle in
``dayfold.plans.oracle``. Report day 2024-01-20; the amount-probing window is one day here because 20
minutes finds nothing in the synthetic events (the library default stays 20 minutes).
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions import full_name, inf, ntz, one_second, on_day
from dayfold.operators import keydigest, rules, scd2, watermark
from dayfold.operators.sequence import lead_split
from dayfold.operators.patterns import probing_chains
from dayfold.operators.profile import refresh_profile
from dayfold.operators.sweep import sweep_join
from dayfold.operators.temporal import card_profile, dim_view, enrich, enrich_profile, temporal_join
from dayfold.operators.timeline import merge_timeline
from dayfold.plans import fixtures as fx
from dayfold.schemas import ACCOUNTS, CARDS, CLIENTS, TRANSACTIONS
from dayfold.sinks.deltas import BucketedHistory
from dayfold.sinks.writers import Attempt, read_commits
from dayfold.sources import capture_increment, capture_keys, drop_date, parse_text_columns

D = fx.REPORT_DAY
D4 = dt.date(2024, 1, 18)  # a day with amount probing
PROBE = dt.timedelta(days=1)
TRAVEL = rules.TRAVEL_WITHIN
VERSION = ["k", "a", "b", "effective_from", "effective_to", "deleted_flg"]


class Bank:
    """The fixture tables of one scale factor (lazy DataFrames)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tx = fx.transactions(spark, sf_dir)
        self.cards = fx.cards_hist(spark, sf_dir)
        self.accounts = fx.accounts_hist(spark, sf_dir)
        self.clients = fx.clients_hist(spark, sf_dir)
        self.terminals = fx.terminals_hist(spark, sf_dir)
        self.blacklist = fx.blacklist(spark, sf_dir)
        self.spark, self.sf_dir = spark, sf_dir

    def dims(self):
        return self.cards, self.accounts, self.clients


def _merge1(spark, sf_dir) -> DataFrame:
    return scd2.merge(fx.scd2_history(spark, sf_dir), fx.scd2_changes(spark, sf_dir), fx.scd2_keys(spark, sf_dir),
                      "k", ["a", "b"], fx.SCD2_RUN)


def capture_transactions(spark, sf_dir):
    text = fx.transactions_text(spark, sf_dir)
    typed = parse_text_columns(text, TRANSACTIONS)
    return typed.withColumn("trans_day", F.to_date("trans_date"))


def capture_increment_q(spark, sf_dir):
    return capture_increment(fx.src_clients(spark, sf_dir), "2024-01-15")


def capture_keys_q(spark, sf_dir):
    return capture_keys(fx.cards_hist(spark, sf_dir), "card_num")


def fact_append(spark, sf_dir):
    """Re-running day D on a full fact table: every row was loaded by the run of its day, some of D's rows late by the
    run of the next day. The corrected drop differs from what it replaces, and carries rows of the day before."""
    from dayfold.sinks import replace_run

    tx = fx.transactions(spark, sf_dir)
    late = F.expr("CAST(trans_id AS BIGINT) % 7 = 0")
    run = F.when(late, F.date_add(F.to_date("trans_date"), 1)).otherwise(F.to_date("trans_date"))
    loaded = tx.withColumn("trans_day", F.to_date("trans_date")).withColumn("run", run)
    drop = tx.where(F.col("trans_date") >= ntz(D - dt.timedelta(days=1))).where(F.col("trans_date") < ntz(
        D + dt.timedelta(days=1))).where(~late).withColumn("amt", (F.col("amt") * 2).cast("decimal(18,2)"))
    return replace_run(loaded, drop, D)


def drop_dates(spark, sf_dir):
    """Dates of file names, one in five without a date."""
    n = fx.table(spark, sf_dir, "nation")
    day = F.date_format(F.expr("DATE '2021-03-01' + CAST(n_nationkey AS INT)"), "ddMMyyyy")
    name = F.concat("n_name", F.lit("_"), F.when(F.col("n_nationkey") % 5 != 0, day).otherwise("2021"), F.lit(".txt"))
    return n.select(F.concat_ws("_", "n_name", "n_nationkey").alias("file_name"), drop_date(name).alias("drop_date"))


def blacklist_increment(spark, sf_dir):
    from dayfold.sinks import new_entries

    return new_entries(fx.blacklist(spark, sf_dir), dt.date(2024, 1, 12))


def watermark_advance(spark, sf_dir):
    b = Bank(spark, sf_dir)
    clients = capture_increment(fx.src_clients(spark, sf_dir), "2024-01-15")
    return (watermark.advance_facts(b.tx, "fact_transactions", D)
            .unionByName(watermark.advance_entries(b.blacklist, "passport_blacklist", watermark.SOURCE_SEED))
            .unionByName(watermark.advance_source(clients, "clients", watermark.SOURCE_SEED)))


def processing_date(spark, sf_dir):
    """Facts loaded through the day before D (the previous run): the next day to process is D."""
    tx = fx.transactions(spark, sf_dir).where(F.col("trans_date") < ntz(D))
    wm = watermark.advance_facts(tx, "fact_transactions", D - dt.timedelta(days=1))
    return watermark.processing_date(wm)


def scd2_new_keys(spark, sf_dir):
    return scd2.new_keys(fx.scd2_history(spark, sf_dir), fx.scd2_changes(spark, sf_dir), "k", ["a", "b"])


def scd2_changed_keys(spark, sf_dir):
    return scd2.changed_keys(fx.scd2_history(spark, sf_dir), fx.scd2_changes(spark, sf_dir), "k", ["a", "b"],
                             run_ts=fx.SCD2_RUN)


def scd2_deleted_keys(spark, sf_dir):
    return scd2.deleted_keys(fx.scd2_history(spark, sf_dir), fx.scd2_keys(spark, sf_dir), "k", ["a", "b"],
                             fx.SCD2_RUN)


def scd2_deleted_by_digest(spark, sf_dir):
    """Deletions through digests of key buckets; the keys that the run opens are expected on both sides."""
    history = fx.scd2_history(spark, sf_dir)
    opened = scd2.new_keys(history, fx.scd2_changes(spark, sf_dir), "k", ["a", "b"])
    return keydigest.deleted_keys(history, fx.scd2_keys(spark, sf_dir), "k", ["a", "b"], fx.SCD2_RUN, opened=opened)


def scd2_merge(spark, sf_dir):
    return _merge1(spark, sf_dir)


def scd2_merge_snapshot(spark, sf_dir):
    snap = fx.scd2_changes(spark, sf_dir).select("k", "a", "b")
    return scd2.merge_snapshot(fx.scd2_history(spark, sf_dir), snap, "k", ["a", "b"], fx.SCD2_RUN)


def scd2_current(spark, sf_dir):
    return scd2.current(_merge1(spark, sf_dir)).select(*VERSION)


def scd2_as_of(spark, sf_dir):
    return scd2.as_of(_merge1(spark, sf_dir), "2024-01-02 12:00:00").select(*VERSION)


def scd2_two_day_replay(spark, sf_dir):
    day1 = _merge1(spark, sf_dir)
    return scd2.merge(day1, fx.scd2_changes_2(spark, sf_dir), fx.scd2_keys_2(spark, sf_dir), "k", ["a", "b"],
                      fx.SCD2_RUN_2)


def _scratch(spark) -> str:
    """A new folder in the cluster's shared one (spark.checkpoint.dir); a local one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(tempfile.gettempdir(), "dayfold")
    return f"{root.rstrip('/')}/warehouse-{uuid.uuid4().hex}"


def history_base_delta(spark, sf_dir):
    """Two daily runs on the bucketed layout: a base of the starting history, what each run changed, folded buckets."""
    root, history = _scratch(spark), fx.scd2_history(spark, sf_dir)
    store = BucketedHistory(spark, root, "dim_customer_hist", "k", history.schema, buckets=16)
    run = Attempt(spark, root, dt.date(2024, 1, 2))
    store.start(run, history)
    run.commit([])
    for day, changes, keys in ((fx.SCD2_RUN, fx.scd2_changes, fx.scd2_keys), (fx.SCD2_RUN_2, fx.scd2_changes_2, fx.scd2_keys_2)):
        commits, run = read_commits(spark, root), Attempt(spark, root, dt.date.fromisoformat(day[:10]))
        store.load(run, commits, commits.last(), changes(spark, sf_dir), keys(spark, sf_dir), ["a", "b"])
        run.commit([])
    commits = read_commits(spark, root)
    return store.history(commits, commits.last()).select(*VERSION)


def scd2_timeline(spark, sf_dir):
    """Several, repeated and backdated changes per key, deleted and new keys."""
    return merge_timeline(fx.timeline_history(spark, sf_dir), fx.timeline_changes(spark, sf_dir),
                          fx.scd2_keys(spark, sf_dir), "k", ["a", "b"], fx.TIMELINE_RUN)


def scd2_timeline_reopened(spark, sf_dir):
    """The same with changes of deleted keys that reopen them, without delete detection."""
    return merge_timeline(fx.timeline_history(spark, sf_dir), fx.timeline_changes(spark, sf_dir), None, "k", ["a", "b"],
                          fx.TIMELINE_RUN, reopen=True)


def temporal_join_q(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    view = dim_view(fx.cards_hist(spark, sf_dir), "card_num", ["account_num"], "_cd", trim_key=True)
    return temporal_join(tx, view, "card_num", "trans_date", "_cd").select(
        "trans_id", "trans_date", "card_num", "account_num")


def temporal_sweep(spark, sf_dir):
    """A card with half of all facts and a thousand versions, by a sweep over (card, day)."""
    view = dim_view(fx.hot_cards_hist(spark, sf_dir), "card_num", ["account_num"], "_cd", trim_key=True)
    return sweep_join(fx.hot_transactions(spark, sf_dir), view, "card_num", "trans_date", "_cd").select(
        "trans_id", "trans_date", "card_num", "account_num")


def enriched_transactions(spark, sf_dir):
    b = Bank(spark, sf_dir)
    e = enrich(b.tx, *b.dims(), b.terminals)
    return e.select("trans_id", "trans_date", "amt", "card_num", "oper_result", "terminal_city", "account_num",
                    "valid_to", "client", "passport_num", "passport_valid_to", full_name().alias("fio"), "phone")


def transactions_of_day(spark, sf_dir):
    return fx.transactions(spark, sf_dir).where(on_day("trans_date", D))


def _with_city(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    view = dim_view(fx.terminals_hist(spark, sf_dir), "terminal_id", ["terminal_city"], "_tm")
    return temporal_join(tx, view, "terminal", "trans_date", "_tm")


def lead_next_event(spark, sf_dir):
    n = lead_split(_with_city(spark, sf_dir), "card_num", "trans_date", "trans_id",
                 ["terminal_city", "trans_date", "oper_result", "amt"], 1)
    return n.select("trans_id", F.col("next1_terminal_city").alias("next_city"),
                    F.col("next1_trans_date").alias("next_date"), F.col("next1_oper_result").alias("next_result"),
                    F.col("next1_amt").alias("next_amt"))


def lead_sequence(spark, sf_dir):
    cols = ["oper_result", "amt", "trans_date"]
    n = lead_split(fx.transactions(spark, sf_dir), "card_num", "trans_date", "trans_id", cols, 3)
    return n.select("trans_id", *[f"next{i}_{c}" for i in (1, 2, 3) for c in cols])


def travel_last_hit(spark, sf_dir):
    b = Bank(spark, sf_dir)
    hits = rules.travel_hits(enrich(b.tx, *b.dims(), b.terminals), TRAVEL)
    return rules.travel_last_hit(hits)


def full_name_q(spark, sf_dir):
    return fx.clients_hist(spark, sf_dir).select("client_id", full_name().alias("fio"))


def validity_bounds(spark, sf_dir):
    s = fx.scd2_changes(spark, sf_dir)
    change_at = F.coalesce(F.col("update_dt"), ntz(fx.SCD2_RUN))
    return s.select(
        "k", (change_at - one_second()).alias("closes_at"), change_at.alias("opens_at"),
        F.to_timestamp_ntz(F.date_format("create_dt", "ddMMyyyy"), F.lit("ddMMyyyy")).alias("created_day"),
        inf().alias("open_end"))


def gap_to_next(spark, sf_dir):
    n = lead_split(fx.transactions(spark, sf_dir), "card_num", "trans_date", "trans_id", ["trans_date"], 1)
    nxt, cur = F.col("next1_trans_date"), F.col("trans_date")
    return n.select("trans_id", F.timestamp_diff("MICROSECOND", cur, nxt).alias("gap_us"),
                    ((nxt - cur) <= F.lit(dt.timedelta(hours=1))).alias("within_hour"))


def fraud_passport(spark, sf_dir):
    b = Bank(spark, sf_dir)
    day = rules.facts_of_day(b.tx, D)
    return rules.expired_or_blocked(enrich(day, *rules.dims_for_run(D, *b.dims())), b.blacklist, D)


def fraud_contract(spark, sf_dir):
    b = Bank(spark, sf_dir)
    day = rules.facts_of_day(b.tx, D)
    return rules.contract_expired(enrich(day, *rules.dims_for_run(D, *b.dims())), D)


def fraud_travel(spark, sf_dir):
    b = Bank(spark, sf_dir)
    day = rules.facts_of_day(b.tx, D)
    return rules.impossible_travel(enrich(day, *rules.dims_for_run(D, *b.dims(), b.terminals)), D, TRAVEL)


def fraud_amount_probing(spark, sf_dir):
    b = Bank(spark, sf_dir)
    return rules.amount_probing(b.tx, *b.dims(), D4, PROBE)


def fraud_report(spark, sf_dir):
    b = Bank(spark, sf_dir)
    return rules.build_report(b.tx, *b.dims(), b.terminals, b.blacklist, D, TRAVEL, PROBE)


def fraud_report_profile(spark, sf_dir):
    """The report as the daily run makes it: through the card profile, on a day with hits of all rules."""
    b = Bank(spark, sf_dir)
    start = dt.datetime.combine(D4, dt.time())
    profile = card_profile(*b.dims(), window=(start - PROBE, start + dt.timedelta(days=1, microseconds=-1)))
    return rules.build_report(b.tx, *b.dims(), b.terminals, b.blacklist, D4, TRAVEL, PROBE, profile=profile)


def fraud_report_accumulated(spark, sf_dir):
    b = Bank(spark, sf_dir)
    return rules.build_report(b.tx, *b.dims(), b.terminals, b.blacklist, None, TRAVEL, PROBE)


def probing_chains_q(spark, sf_dir):
    """Chains of falling rejections of any length within a week, each once."""
    return probing_chains(fx.probing_transactions(spark, sf_dir), dt.timedelta(days=7)).select(
        "trans_id", "card_num", "chain_start", F.col("trans_date").alias("chain_end"), "chain_rows")


def card_profile_incremental(spark, sf_dir):
    """Facts through a profile that a run refreshed after changes of cards, accounts and clients."""
    b = Bank(spark, sf_dir)
    staged = fx.changed_cards(spark, sf_dir), fx.changed_accounts(spark, sf_dir), fx.changed_clients(spark, sf_dir)
    root = _scratch(spark)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    specs = (CARDS, ACCOUNTS, CLIENTS)
    profile = stored(card_profile(*b.dims()), "profile")  # a warehouse has both as tables
    after = [stored(scd2.merge(h, s, None, spec.key, spec.attrs, fx.CHAIN_RUN), spec.name)
             for h, s, spec in zip(b.dims(), staged, specs)]
    profile = refresh_profile(profile, *after, *[s.select(spec.key) for s, spec in zip(staged, specs)])
    return enrich_profile(b.tx, profile).select("trans_id", "trans_date", "card_num", "account_num", "valid_to", "client",
                                                "passport_num", full_name().alias("fio"), "phone")


def fraud_amount_probing_replay(spark, sf_dir):
    b = Bank(spark, sf_dir)
    return rules.amount_probing(b.tx, *b.dims(), None, PROBE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "capture_transactions": capture_transactions,
    "capture_increment": capture_increment_q,
    "capture_keys": capture_keys_q,
    "fact_append": fact_append,
    "drop_dates": drop_dates,
    "blacklist_increment": blacklist_increment,
    "processing_date": processing_date,
    "watermark_advance": watermark_advance,
    "scd2_new_keys": scd2_new_keys,
    "scd2_changed_keys": scd2_changed_keys,
    "scd2_deleted_keys": scd2_deleted_keys,
    "scd2_deleted_by_digest": scd2_deleted_by_digest,
    "scd2_merge": scd2_merge,
    "scd2_merge_snapshot": scd2_merge_snapshot,
    "scd2_current": scd2_current,
    "scd2_as_of": scd2_as_of,
    "scd2_two_day_replay": scd2_two_day_replay,
    "history_base_delta": history_base_delta,
    "scd2_timeline": scd2_timeline,
    "scd2_timeline_reopened": scd2_timeline_reopened,
    "temporal_join": temporal_join_q,
    "temporal_sweep": temporal_sweep,
    "enriched_transactions": enriched_transactions,
    "transactions_of_day": transactions_of_day,
    "lead_next_event": lead_next_event,
    "lead_sequence": lead_sequence,
    "travel_last_hit": travel_last_hit,
    "full_name": full_name_q,
    "validity_bounds": validity_bounds,
    "gap_to_next": gap_to_next,
    "fraud_passport": fraud_passport,
    "fraud_contract": fraud_contract,
    "fraud_travel": fraud_travel,
    "fraud_amount_probing": fraud_amount_probing,
    "fraud_report": fraud_report,
    "fraud_report_profile": fraud_report_profile,
    "fraud_report_accumulated": fraud_report_accumulated,
    "probing_chains": probing_chains_q,
    "card_profile_incremental": card_profile_incremental,
    "fraud_amount_probing_replay": fraud_amount_probing_replay,
}
