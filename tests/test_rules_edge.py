"""Hand-written edge cases for the temporal joins and the four rules (FIXTURES.md, section C)."""

import datetime as dt
from decimal import Decimal

import pytest

from dayfold.operators import rules
from dayfold.operators.temporal import enrich
from dayfold.schemas import BLACKLIST, DIM_ACCOUNTS, DIM_CARDS, DIM_CLIENTS, DIM_TERMINALS, TRANSACTIONS

T0 = dt.datetime(2020, 1, 1)
INF = dt.datetime(9999, 12, 31)
DAY = dt.date(2021, 3, 1)


def ts(s):
    return dt.datetime.fromisoformat(s)


class Bank:
    """A one-client bank: card C1 -> account A1 -> client K1 (passport P1); terminals by city."""

    def __init__(self, spark, *, card_key="C1", card_to=INF, valid_to=dt.date(2030, 1, 1), passport_to=None,
                 patronymic="Ivanovich", blacklist=(), clients=None):
        self.spark = spark
        self.cards = spark.createDataFrame([(card_key, "A1", T0, card_to, "n")], DIM_CARDS)
        self.accounts = spark.createDataFrame([("A1", valid_to, "K1", T0, INF, "n")], DIM_ACCOUNTS)
        rows = clients or [("K1", "Ivanov", "Ivan", patronymic, dt.date(1980, 1, 1), "P1", passport_to, "+7", T0, INF, "n")]
        self.clients = spark.createDataFrame(rows, DIM_CLIENTS)
        self.terminals = spark.createDataFrame(
            [("T1", "POS", "Moscow", "a", T0, INF, "n"), ("T2", "POS", "Kazan", "b", T0, INF, "n"),
             ("T3", "POS", "Moscow", "c", T0, INF, "n")], DIM_TERMINALS)
        self.blacklist = spark.createDataFrame(list(blacklist), BLACKLIST)

    def tx(self, rows):
        """rows: (id, time, amount, result, terminal) for card C1."""
        return self.spark.createDataFrame(
            [(i, ts(t), Decimal(a), "C1", "PAYMENT", r, term) for i, t, a, r, term in rows], TRANSACTIONS)

    def enriched(self, tx):
        return enrich(tx, self.cards, self.accounts, self.clients, self.terminals)


def one(tx_time="2021-03-01 10:00:00", term="T1"):
    return [("1", tx_time, "10.00", "SUCCESS", term)]


def test_trailing_blanks_in_dimension_key_still_join(spark):
    b = Bank(spark, card_key="C1  ")
    e = b.enriched(b.tx(one())).collect()
    assert e[0]["account_num"] == "A1" and e[0]["passport_num"] == "P1"


def test_sub_second_gap_between_versions_matches_nothing(spark):
    b = Bank(spark, card_to=ts("2021-03-01 09:59:59"))
    e = b.enriched(b.tx(one("2021-03-01 09:59:59.500000"))).collect()
    assert e[0]["account_num"] is None


@pytest.mark.parametrize("t,flagged", [("2021-03-01 10:00:00", True), ("2021-03-01 00:00:00", False)])
def test_contract_expires_after_midnight_of_valid_to(spark, t, flagged):
    b = Bank(spark, valid_to=DAY)
    out = rules.contract_expired(b.enriched(b.tx(one(t))), DAY).collect()
    assert (len(out) == 1) == flagged


def test_null_passport_validity_not_blacklisted_is_not_flagged(spark):
    b = Bank(spark, passport_to=None)
    assert rules.expired_or_blocked(b.enriched(b.tx(one())), b.blacklist, DAY).count() == 0


def test_expired_passport_is_flagged(spark):
    b = Bank(spark, passport_to=dt.date(2021, 2, 1))
    out = rules.expired_or_blocked(b.enriched(b.tx(one())), b.blacklist, DAY).collect()
    assert [(r.passport, r.event_type, r.report_dt) for r in out] == [("P1", "1", DAY)]


@pytest.mark.parametrize("entry,flagged", [(dt.date(2021, 3, 2), False), (DAY, True), (dt.date(2021, 2, 1), True)])
def test_blacklist_entry_must_not_be_after_the_operation(spark, entry, flagged):
    b = Bank(spark, blacklist=[("P1", entry), ("P9", dt.date(2020, 1, 1))])
    n = rules.expired_or_blocked(b.enriched(b.tx(one())), b.blacklist, DAY).count()
    assert n == (1 if flagged else 0)


def test_null_patronymic_keeps_row_with_null_name(spark):
    b = Bank(spark, valid_to=dt.date(2021, 1, 1), patronymic=None)
    out = rules.contract_expired(b.enriched(b.tx(one())), DAY).collect()
    assert len(out) == 1 and out[0]["fio"] is None


def probe(start, gaps_sec, amounts, results):
    t = ts(start)
    rows = []
    for i, (g, a, r) in enumerate(zip(gaps_sec, amounts, results)):
        t = t + dt.timedelta(seconds=g)
        rows.append((str(i), t.isoformat(sep=" "), a, r, "T1"))
    return rows


R = ["REJECT", "REJECT", "REJECT", "SUCCESS"]


@pytest.mark.parametrize("span,hit", [(1200, True), (1201, False)])
def test_amount_probing_window_is_inclusive(spark, span, hit):
    b = Bank(spark)
    rows = probe("2021-03-01 10:00:00", [0, 400, 400, span - 800], ["50", "40", "30", "20"], R)
    out = rules.amount_probing(b.tx(rows), b.cards, b.accounts, b.clients, DAY).collect()
    assert len(out) == (1 if hit else 0)
    if hit:
        assert out[0]["event_dt"] == ts("2021-03-01 10:20:00") and out[0]["event_type"] == "4"


@pytest.mark.parametrize("amounts,results", [
    (["50", "40", "40", "20"], R),
    (["50", "40", "30", "20"], ["SUCCESS", "REJECT", "REJECT", "SUCCESS"]),
])
def test_amount_probing_needs_falling_amounts_and_three_rejects(spark, amounts, results):
    b = Bank(spark)
    rows = probe("2021-03-01 10:00:00", [0, 60, 60, 60], amounts, results)
    assert rules.amount_probing(b.tx(rows), b.cards, b.accounts, b.clients, DAY).count() == 0


def test_amount_probing_across_midnight_reports_on_the_run_date(spark):
    b = Bank(spark)
    rows = probe("2021-02-28 23:50:00", [0, 300, 240, 360], ["50", "40", "30", "20"], R)
    out = rules.amount_probing(b.tx(rows), b.cards, b.accounts, b.clients, DAY).collect()
    assert [r.event_dt for r in out] == [ts("2021-03-01 00:05:00")]
    # the previous day's run does not see it: the last operation is not on that day
    assert rules.amount_probing(b.tx(rows), b.cards, b.accounts, b.clients, dt.date(2021, 2, 28)).count() == 0


def test_amount_probing_uses_only_the_last_four_of_a_longer_chain(spark):
    b = Bank(spark)
    rows = probe("2021-03-01 10:00:00", [0, 60, 60, 60, 60], ["90", "50", "40", "30", "20"], ["REJECT"] + R)
    out = rules.amount_probing(b.tx(rows), b.cards, b.accounts, b.clients, DAY).collect()
    assert [r.event_dt for r in out] == [ts("2021-03-01 10:04:00")]


@pytest.mark.parametrize("second,term,hit", [
    ("2021-03-01 11:00:00", "T2", True),   # exactly one hour, other city
    ("2021-03-01 11:00:01", "T2", False),  # more than one hour
    ("2021-03-01 10:30:00", "T3", False),  # same city, other terminal
])
def test_impossible_travel_pairs(spark, second, term, hit):
    b = Bank(spark)
    tx = b.tx([("1", "2021-03-01 10:00:00", "10.00", "SUCCESS", "T1"), ("2", second, "10.00", "SUCCESS", term)])
    out = rules.impossible_travel(b.enriched(tx), DAY).collect()
    assert len(out) == (1 if hit else 0)
    if hit:
        assert out[0]["event_dt"] == ts("2021-03-01 10:00:00") and out[0]["event_type"] == "3"


def test_impossible_travel_across_midnight_is_missed(spark):
    b = Bank(spark)
    tx = b.tx([("1", "2021-02-28 23:40:00", "10.00", "SUCCESS", "T1"), ("2", "2021-03-01 00:10:00", "10.00", "SUCCESS", "T2")])
    assert rules.impossible_travel(b.enriched(tx), DAY).count() == 0
    assert rules.impossible_travel(b.enriched(tx), dt.date(2021, 2, 28)).count() == 0


def test_impossible_travel_keeps_only_the_persons_latest_hit(spark):
    b = Bank(spark)
    tx = b.tx([("1", "2021-03-01 10:00:00", "1.00", "SUCCESS", "T1"), ("2", "2021-03-01 10:20:00", "1.00", "SUCCESS", "T2"),
               ("3", "2021-03-01 15:00:00", "1.00", "SUCCESS", "T1"), ("4", "2021-03-01 15:30:00", "1.00", "SUCCESS", "T2")])
    out = rules.impossible_travel(b.enriched(tx), DAY).collect()
    assert [r.event_dt for r in out] == [ts("2021-03-01 15:00:00")]


def test_time_split_window_equals_plain_lead_on_a_hot_card(spark):
    """One card with many operations across bucket boundaries: split window == single window."""
    from pyspark.sql import functions as F

    from dayfold.operators.sequence import lead_all, neighbours_within

    base = ts("2021-03-01 00:00:00")
    rows = [(str(i), base + dt.timedelta(seconds=97 * i + (i % 7) * 13), Decimal(i % 11), "C1", "P",
             "REJECT" if i % 3 else "SUCCESS", f"T{1 + i % 2}") for i in range(600)]
    df = spark.createDataFrame(rows, TRANSACTIONS)
    within = dt.timedelta(minutes=5)
    got = neighbours_within(df, "card_num", "trans_date", "trans_id", ["amt", "trans_date"], 3, within, split=2)
    ref = lead_all(df, "card_num", "trans_date", "trans_id", ["amt", "trans_date"], 3)
    near = lambda i: F.col(f"next{i}_trans_date") - F.col("trans_date") <= F.lit(within)
    cols = ["trans_id"] + [f"next{i}_{c}" for i in (1, 2, 3) for c in ("amt", "trans_date")]

    def within_rows(d):
        return sorted(tuple(r) for r in d.select(
            "trans_id", *[F.when(near(i), F.col(f"next{i}_{c}")).alias(f"x{i}{c}")
                          for i in (1, 2, 3) for c in ("amt", "trans_date")]).collect())

    assert within_rows(got) == within_rows(ref)
    assert got.count() == 600 and set(got.columns) == set(df.columns) | set(cols)


@pytest.mark.parametrize("bucket_min", [7, 60, 24 * 60])
def test_split_lead_equals_single_window_at_any_distance(spark, bucket_min):
    """A hot card spread over many buckets (some empty) plus a quiet one: split lead == plain window."""
    from dayfold.operators.sequence import lead_all, lead_split

    base = ts("2021-03-01 00:00:00")
    rows = [(str(i), base + dt.timedelta(seconds=(i * i * 37) % 200000 + i), Decimal(i % 13), "HOT", "P",
             "REJECT" if i % 4 else "SUCCESS", "T1") for i in range(500)]
    rows += [(f"q{i}", base + dt.timedelta(hours=5 * i), Decimal(i), "QUIET", "P", "SUCCESS", "T1") for i in range(4)]
    df = spark.createDataFrame(rows, TRANSACTIONS)
    cols = ["amt", "trans_date", "oper_result"]
    got = lead_split(df, "card_num", "trans_date", "trans_id", cols, 3, dt.timedelta(minutes=bucket_min))
    ref = lead_all(df, "card_num", "trans_date", "trans_id", cols, 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select(*got.columns).collect()))


def test_report_with_separate_probing_equals_fused(spark):
    """The daily report with R4 run on its own gives the same rows as the fused pass."""
    from conftest import SF_SMALL
    from dayfold.plans import contract
    from helpers import spark_rows

    b = contract.Bank(spark, SF_SMALL)
    args = (b.tx, *b.dims(), b.terminals, b.blacklist, contract.D, rules.TRAVEL_WITHIN, contract.PROBE)
    assert spark_rows(rules.build_report(*args, fuse_probing=False)) == spark_rows(rules.build_report(*args))
