"""card_profile + one temporal join == the card -> account -> client left-join chain, row for row."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from dayfold.operators.temporal import card_profile, enrich, enrich_profile
from dayfold.plans import fixtures as fx
from dayfold.schemas import DIM_ACCOUNTS, DIM_CARDS, DIM_CLIENTS, TRANSACTIONS
from helpers import spark_rows

B = dt.datetime(2021, 3, 1)
INF = dt.datetime(9999, 12, 31)
S = dt.timedelta(seconds=1)

# validity bounds on a coarse grid with the 1-second holes the merge produces
bound = st.sampled_from([B, B + dt.timedelta(hours=1), B + dt.timedelta(hours=1) - S, B + dt.timedelta(hours=2),
                         B + dt.timedelta(hours=2) - S, B + dt.timedelta(hours=3), INF, None])
moment = st.sampled_from([B, B + dt.timedelta(minutes=30), B + dt.timedelta(hours=1) - S,
                          B + dt.timedelta(hours=1) - S / 2, B + dt.timedelta(hours=1), B + dt.timedelta(hours=2),
                          B + dt.timedelta(hours=2, minutes=59), B + dt.timedelta(days=3)])


def interval(draw):
    a, b = draw(bound), draw(bound)
    if a is not None and b is not None and a > b:
        a, b = b, a
    return a, b


@st.composite
def world(draw):
    cards = [(draw(st.sampled_from(["1", "1  ", "2", None])), draw(st.sampled_from(["A", "B", None])),
              *interval(draw), "n") for _ in range(draw(st.integers(0, 4)))]
    accs = [(draw(st.sampled_from(["A", "B"])), draw(st.sampled_from([dt.date(2021, 1, 1), None])),
             draw(st.sampled_from(["K", "L", None])), *interval(draw), "n") for _ in range(draw(st.integers(0, 4)))]
    cls = [(draw(st.sampled_from(["K", "L"])), "Ln", "Fn", draw(st.sampled_from(["P", None])), None,
            draw(st.sampled_from(["X1", "X2"])), None, "+7", *interval(draw), "n") for _ in range(draw(st.integers(0, 4)))]
    facts = [(str(i), draw(moment), Decimal(1), draw(st.sampled_from(["1", "2", "3"])), "P", "SUCCESS", "T")
             for i in range(draw(st.integers(1, 6)))]
    return cards, accs, cls, facts


COLS = ["trans_id", "trans_date", "card_num", "account_num", "valid_to", "client", "last_name", "first_name",
        "patronymic", "passport_num", "passport_valid_to", "phone"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(world(), st.sampled_from([(B, B + dt.timedelta(hours=1, microseconds=-1)),
                                 (B + dt.timedelta(minutes=30), B + dt.timedelta(hours=2, minutes=59)),
                                 (B - dt.timedelta(days=1), B + dt.timedelta(days=4))]))
def test_windowed_profile_equals_join_chain_inside_the_window(spark, w, window):
    from pyspark.sql import functions as F

    cards, accs, cls, facts = w
    c = spark.createDataFrame(cards, DIM_CARDS)
    a = spark.createDataFrame(accs, DIM_ACCOUNTS)
    k = spark.createDataFrame(cls, DIM_CLIENTS)
    f = spark.createDataFrame(facts, TRANSACTIONS).where(F.col("trans_date").between(*window))
    chain = enrich(f, c, a, k).select(*COLS)
    prof = enrich_profile(f, card_profile(c, a, k, window=window)).select(*COLS)
    assert spark_rows(prof) == spark_rows(chain)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(world())
def test_profile_join_equals_join_chain(spark, w):
    cards, accs, cls, facts = w
    c = spark.createDataFrame(cards, DIM_CARDS)
    a = spark.createDataFrame(accs, DIM_ACCOUNTS)
    k = spark.createDataFrame(cls, DIM_CLIENTS)
    f = spark.createDataFrame(facts, TRANSACTIONS)
    chain = enrich(f, c, a, k).select(*COLS)
    prof = enrich_profile(f, card_profile(c, a, k)).select(*COLS)
    assert spark_rows(prof) == spark_rows(chain)


def test_profile_on_the_fixture(spark):
    tx = fx.transactions(spark, SF_SMALL)
    dims = fx.cards_hist(spark, SF_SMALL), fx.accounts_hist(spark, SF_SMALL), fx.clients_hist(spark, SF_SMALL)
    assert spark_rows(enrich_profile(tx, card_profile(*dims)).select(*COLS)) == \
        spark_rows(enrich(tx, *dims).select(*COLS))


def test_refreshed_profile_equals_the_full_rebuild(spark):
    """Ten runs of random changes, each refreshing the profile of the run before."""
    import random

    from dayfold.operators import scd2
    from dayfold.operators.profile import changed_between, reached_cards, refresh_profile
    from dayfold.schemas import ACCOUNTS, CARDS, CLIENTS

    rng = random.Random(11)
    ts = "create_dt timestamp_ntz, update_dt timestamp_ntz"
    pick = lambda p, n: f"{p}{rng.randrange(n)}"

    def card():
        return pick("c", 12) + "  ", rng.choice([None, pick("A", 9)])

    def account():
        return pick("A", 9), dt.date(2021, 1, rng.randint(1, 9)), rng.choice([None, pick("K", 7)])

    def client():
        return pick("K", 7), "L", "F", rng.choice([None, "M"]), None, pick("P", 4), None, pick("+", 3)

    make = {CARDS: (card, DIM_CARDS), ACCOUNTS: (account, DIM_ACCOUNTS), CLIENTS: (client, DIM_CLIENTS)}
    dims = {s: spark.createDataFrame([], schema) for s, (_, schema) in make.items()}
    profile = card_profile(*dims.values()).checkpoint()
    untouched = 0
    for n in range(10):
        run = B + dt.timedelta(days=n + 1)
        after = {}
        for spec, (row, schema) in make.items():
            k = 14 if n == 0 else rng.choice([0, 1, 1, 2])
            at = run - dt.timedelta(hours=rng.randint(1, 20))
            staged = [(*row(), at, rng.choice([None, at])) for _ in range(k)]
            cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields[:-3])
            staged = spark.createDataFrame(staged, f"{cols}, {ts}")
            alive = dims[spec].select(spec.key).union(staged.select(spec.key)).distinct().where(
                f"abs(hash({spec.key}, {n})) % 20 <> 0")
            after[spec] = scd2.merge(dims[spec], staged, alive, spec.key, spec.attrs, run).checkpoint()
        changed = [changed_between(dims[s], after[s], s.key) for s in make]
        cards = reached_cards(profile, *changed)
        untouched += profile.join(cards, profile["_pf_key"] == cards["card"], "left_anti").count()
        profile = refresh_profile(profile, *after.values(), *changed).checkpoint()
        dims = after
        want = card_profile(*dims.values())
        if n % 3 == 0:
            assert spark_rows(profile) == spark_rows(want.select(*profile.columns))
    assert untouched > 0
