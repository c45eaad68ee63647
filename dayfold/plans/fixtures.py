"""Bank tables derived from the driver's Parquet tables (derivations in FIXTURES.md, section B).

The same derivations are written as DuckDB SQL in ``dayfold.plans.oracle``; both sides read the whole
input tables, so every contract query grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions import FLAG_DELETED, FLAG_LIVE, inf, ntz
from dayfold.schemas import AMOUNT

# Fixed values of the derived fixture (FIXTURES.md, section B).
T0 = "2020-01-01 00:00:00"
REPORT_DAY = dt.date(2024, 1, 20)
CARD_SWITCH_END = "2024-01-14 23:59:59"
CARD_SWITCH_START = "2024-01-15 00:00:00"
REJECTED_EVENTS = ("error", "view", "click")
SCD2_FROM = "2023-01-01 00:00:00"
SCD2_CLOSED_END = "2023-06-30 23:59:59"
SCD2_TOMB_FROM = "2023-07-01 00:00:00"
SCD2_CREATED = "2024-01-01 08:00:00"
SCD2_UPDATED = "2024-01-02 10:00:00"
SCD2_RUN = "2024-01-03 00:00:00"
SCD2_CREATED_2 = "2024-01-02 08:00:00"
SCD2_UPDATED_2 = "2024-01-03 09:30:00"
SCD2_RUN_2 = "2024-01-04 00:00:00"


_TABLES: dict[tuple, DataFrame] = {}


def _memo(fn):
    """Derive each fixture once per session and scale factor (like registering a view once)."""
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (fn.__name__, id(spark), sf_dir)
        df = _TABLES.get(key)
        if df is None or df.sparkSession is not spark:
            df = _TABLES[key] = fn(spark, sf_dir)
        return df
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table, read once per session (file listing and footer reads are not repeated)."""
    path = f"{sf_dir}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _str(c: Column) -> Column:
    return c.cast("string")


def _plus_days(day: str, n: Column) -> Column:
    return F.date_add(F.lit(dt.date.fromisoformat(day)), n.cast("int"))


@_memo
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        _str(F.col("event_id")).alias("trans_id"),
        F.col("ts").alias("trans_date"),
        F.col("value").cast(AMOUNT).alias("amt"),
        _str(F.col("user_id")).alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type").isin(*REJECTED_EVENTS), "REJECT").otherwise("SUCCESS").alias("oper_result"),
        _str(F.col("event_id") % 25).alias("terminal"),
    )


@_memo
def transactions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions as the daily text drop carries them: every field text, amounts with a decimal comma."""
    t = transactions(spark, sf_dir)
    return t.select(
        "trans_id",
        _str(F.col("trans_date")).alias("trans_date"),
        F.regexp_replace(_str(F.col("amt")), r"\.", ",").alias("amt"),
        "card_num", "oper_type", "oper_result", "terminal",
    )


def _customer(spark, sf_dir):
    return table(spark, sf_dir, "customer")


def _validity(frm: Column, to: Column, flag: str = FLAG_LIVE) -> list[Column]:
    return [frm.alias("effective_from"), to.alias("effective_to"), F.lit(flag).alias("deleted_flg")]


@_memo
def cards_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customer(spark, sf_dir)
    k = F.col("c_custkey")
    switched = (k % 3) == 0
    first = c.select(
        F.concat(_str(k), F.lit("  ")).alias("card_num"),
        F.concat(F.lit("A"), _str(k)).alias("account_num"),
        *_validity(ntz(T0), F.when(switched, ntz(CARD_SWITCH_END)).otherwise(inf())),
    )
    second = c.where(switched).select(
        F.concat(_str(k), F.lit("  ")).alias("card_num"),
        F.concat(F.lit("A"), _str(k + 1)).alias("account_num"),
        *_validity(ntz(CARD_SWITCH_START), inf()),
    )
    return first.unionByName(second)


@_memo
def accounts_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _customer(spark, sf_dir).select(
        F.concat(F.lit("A"), _str(k)).alias("account_num"),
        _plus_days("2024-01-01", k % 60).alias("valid_to"),
        F.concat(F.lit("C"), _str(k)).alias("client"),
        *_validity(ntz(T0), inf()),
    )


@_memo
def clients_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _customer(spark, sf_dir).select(
        F.concat(F.lit("C"), _str(k)).alias("client_id"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_name").alias("first_name"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.lit("X")).alias("patronymic"),
        _plus_days("1960-01-01", k % 15000).alias("date_of_birth"),
        F.concat(F.lit("P"), _str(k)).alias("passport_num"),
        F.when(k % 5 == 0, F.lit(None).cast("date")).otherwise(_plus_days("2024-01-10", k % 40)).alias("passport_valid_to"),
        F.concat(F.lit("T"), _str(k)).alias("phone"),
        *_validity(ntz(T0), inf()),
    )


@_memo
def terminals_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        _str(F.col("n_nationkey")).alias("terminal_id"),
        F.lit("ATM").alias("terminal_type"),
        F.col("r_name").alias("terminal_city"),
        F.col("n_name").alias("terminal_address"),
        *_validity(ntz(T0), inf()),
    )


@_memo
def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _customer(spark, sf_dir).where(k % 11 == 0).select(
        F.concat(F.lit("P"), _str(k)).alias("passport_num"),
        _plus_days("2024-01-05", k % 20).alias("entry_dt"),
    )


@_memo
def src_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational clients table with create/update times spread over January 2024."""
    k = F.col("c_custkey")
    created = ntz("2024-01-01 00:00:00") + F.make_dt_interval((k % 30).cast("int"), (k % 24).cast("int"))
    updated = F.when(k % 4 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        created + F.make_dt_interval((k % 5).cast("int")))
    c = clients_hist(spark, sf_dir).drop("effective_from", "effective_to", "deleted_flg")
    base = _customer(spark, sf_dir).select(F.concat(F.lit("C"), _str(k)).alias("_id"), created.alias("create_dt"),
                                           updated.alias("update_dt"))
    return c.join(base, c.client_id == base._id).drop("_id")


# --- generic SCD2 fixture: key k, attributes a (string) and b (double) ---------------------------------

@_memo
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customer(spark, sf_dir).where(F.col("c_custkey") % 10 != 0)
    k = F.col("c_custkey")
    a = F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    closed = (k % 13) == 0
    first = c.select(k.alias("k"), a.alias("a"), F.col("c_acctbal").alias("b"),
                     *_validity(ntz(SCD2_FROM), F.when(closed, ntz(SCD2_CLOSED_END)).otherwise(inf())))
    tomb = c.where(closed).select(k.alias("k"), a.alias("a"), F.col("c_acctbal").alias("b"),
                                  *_validity(ntz(SCD2_TOMB_FROM), inf(), FLAG_DELETED))
    return first.unionByName(tomb)


@_memo
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    a = (F.when(k % 19 == 0, F.lit(None).cast("string")).when(k % 3 == 0, F.lit("NEW"))
         .when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")))
    return _customer(spark, sf_dir).where(k % 4 != 1).select(
        k.alias("k"), a.alias("a"), F.col("c_acctbal").alias("b"),
        ntz(SCD2_CREATED).alias("create_dt"),
        F.when(k % 10 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(ntz(SCD2_UPDATED)).alias("update_dt"),
    )


@_memo
def scd2_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer(spark, sf_dir).where(F.col("c_custkey") % 23 != 0).select(F.col("c_custkey").alias("k"))


@_memo
def scd2_changes_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second day's changes: some keys move to 'TWO', some balances grow by one, others are re-sent unchanged."""
    k = F.col("c_custkey")
    a = F.when(k % 5 == 0, F.lit("TWO")).when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    b = F.col("c_acctbal") + F.when(k % 8 == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return _customer(spark, sf_dir).where(k % 6 != 2).select(
        k.alias("k"), a.alias("a"), b.alias("b"),
        ntz(SCD2_CREATED_2).alias("create_dt"), ntz(SCD2_UPDATED_2).alias("update_dt"),
    )


@_memo
def scd2_keys_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer(spark, sf_dir).where(F.col("c_custkey") % 29 != 0).select(F.col("c_custkey").alias("k"))


# --- several and backdated changes per key ------------------------------------------------------------

TIMELINE_RUN = "2024-03-01 00:00:00"


def _day_of(day: Column, hour: Column | None = None) -> Column:
    """2023-01-01 plus days and hours."""
    return ntz("2023-01-01 00:00:00") + F.make_dt_interval(day.cast("int"), (F.lit(0) if hour is None else hour).cast("int"))


@_memo
def timeline_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to four versions per key, 60 days apart; the last one is open, or closed after 30 days and deleted. One key
    in ten has no history yet."""
    k, i = F.col("k"), F.col("i")
    v = _customer(spark, sf_dir).where(F.col("c_custkey") % 10 != 0).select(
        F.col("c_custkey").alias("k"), "c_mktsegment", "c_acctbal", F.explode(F.expr("sequence(0L, c_custkey % 4)")).alias("i"))
    frm = 60 * i + k % 7
    last = i == k % 4
    gone = k % 13 == 0
    a = F.when((k + i) % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    live = v.select("k", a.alias("a"), (F.col("c_acctbal") + i).alias("b"), *_validity(
        _day_of(frm), F.when(last & ~gone, inf()).otherwise(
            _day_of(F.when(last, frm + 30).otherwise(frm + 60)) - F.expr("INTERVAL 1 SECOND"))))
    tomb = v.where(last & gone).select("k", a.alias("a"), (F.col("c_acctbal") + i).alias("b"),
                                       *_validity(_day_of(frm + 30), inf(), FLAG_DELETED))
    return live.unionByName(tomb)


@_memo
def timeline_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a staged change of its customer, at a time of the 14 months from 2023 on; one in nine has no update."""
    n = F.col("o_orderkey")
    day = n * 37 % 420
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"),
        F.when(n % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("a"),
        (n % 2).cast("double").alias("b"), (_day_of(day) - F.expr("INTERVAL 1 DAY")).alias("create_dt"),
        F.when(n % 9 != 0, _day_of(day, n % 24)).alias("update_dt"))


# --- a card with half of all facts and a thousand versions --------------------------------------------

HOT_VERSIONS, HOT_SECONDS = 1000, 2592


@_memo
def hot_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second transaction is made with one card."""
    hot = F.col("trans_id").cast("long") % 2 == 0
    return transactions(spark, sf_dir).withColumn("card_num", F.when(hot, F.lit("HOT")).otherwise(F.col("card_num")))


@_memo
def hot_cards_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cards, and a thousand versions of that card over January 2024; each fiftieth ends early and leaves a gap."""
    i = F.col("id")
    start = ntz("2024-01-01 00:00:00") + F.expr(f"make_dt_interval(0, 0, 0, id * {HOT_SECONDS})")
    to = F.when(i == HOT_VERSIONS - 1, inf()).otherwise(start + F.expr(
        f"make_dt_interval(0, 0, 0, IF(id % 50 = 7, 1000, {HOT_SECONDS} - 1))"))
    hot = spark.range(HOT_VERSIONS).select(F.lit("HOT").alias("card_num"), F.concat(F.lit("H"), _str(i)).alias("account_num"),
                                           *_validity(start, to))
    return cards_hist(spark, sf_dir).unionByName(hot)


# --- one run's changes of cards, accounts and clients -------------------------------------------------

CHAIN_RUN = "2024-01-19 00:00:00"
CHAIN_CHANGES = {"cards": (20, "2024-01-16 10:00:00"), "accounts": (25, "2024-01-17 09:00:00"),
                 "clients": (30, "2024-01-18 12:00:00")}  # every n-th key, changed at


def _chain_change(spark: SparkSession, sf_dir: str, name: str, *cols: Column) -> DataFrame:
    each, at = CHAIN_CHANGES[name]
    return _customer(spark, sf_dir).where(F.col("c_custkey") % each == 0).select(
        *cols, ntz(T0).alias("create_dt"), ntz(at).alias("update_dt"))


@_memo
def changed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _chain_change(spark, sf_dir, "cards", F.concat(_str(k), F.lit("  ")).alias("card_num"),
                         F.concat(F.lit("A"), _str(k + 2)).alias("account_num"))


@_memo
def changed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _chain_change(spark, sf_dir, "accounts", F.concat(F.lit("A"), _str(k)).alias("account_num"),
                         _plus_days("2024-01-01", k % 60).alias("valid_to"),
                         F.concat(F.lit("C"), _str(k + 1)).alias("client"))


@_memo
def changed_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    each, at = CHAIN_CHANGES["clients"]
    now = clients_hist(spark, sf_dir).drop("effective_from", "effective_to", "deleted_flg")
    some = F.expr(f"CAST(substring(client_id, 2) AS BIGINT) % {each} = 0")
    return now.where(some).withColumn("phone", F.concat(F.lit("N"), F.expr("substring(client_id, 2)"))).select(
        "*", ntz(T0).alias("create_dt"), ntz(at).alias("update_dt"))


@_memo
def probing_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions, a third of the cards with amounts that fall all month: long chains of rejections."""
    t = transactions(spark, sf_dir)
    fall = F.expr("CAST(3000000 - (CAST(dayofmonth(trans_date) AS BIGINT) * 86400 + hour(trans_date) * 3600"
                  " + minute(trans_date) * 60 + floor(second(trans_date))) AS DECIMAL(18, 2))")
    return t.withColumn("amt", F.when(F.col("card_num").cast("long") % 3 == 0, fall).otherwise(F.col("amt")))
