"""Keeping a card profile up to date: only cards that a run touched are cut again.

``temporal.card_profile`` cuts every card's versions by those of its accounts, and the pieces by those of the accounts'
clients. A run changes few keys of the three dimensions. The segments of a card depend on that card's versions, on the
versions of the accounts these name, and on the versions of the clients those accounts name; all three names stand in
the card's segments. So the profile itself tells, without reading a dimension, which cards a changed account or client
reaches; a card that now names another account has itself changed, and an account that now names another client too.

The rules of a refresh, for keys whose versions a run opened, closed or altered:

1. a card is reached if it changed, or if one of its segments names a changed account or a changed client;
2. the segments of cards that are not reached are kept as they are;
3. the segments of reached cards are dropped and cut again from their versions, those of the accounts they name, and
   those of the clients these name.

The result equals ``card_profile`` of the dimensions after the run. Joins are by key: the profile is read once per
dimension that changed, reached cards (a set of keys) are what moves, and Spark broadcasts it only if it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.operators.temporal import card_profile


def changed_between(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key) whose versions differ between two states of a history; a store has them from what a run wrote instead."""
    old, new = before.select(*after.columns), after
    return old.exceptAll(new).unionByName(new.exceptAll(old)).select(key).distinct()


def reached_cards(profile: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """(card) that a run reaches. ``cards``, ``accounts``, ``clients``: changed keys, each a frame of one column."""
    own = cards.select(F.trim(F.col(cards.columns[0])).alias("card"))
    by = [profile.join(keys.select(F.col(keys.columns[0]).alias("_key")), F.col(name) == F.col("_key"), "left_semi").select(
        F.col("_pf_key").alias("card")) for name, keys in (("account_num", accounts), ("client", clients))]
    return own.unionByName(by[0]).unionByName(by[1]).distinct()


def refresh_profile(profile: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                    changed_cards: DataFrame, changed_accounts: DataFrame, changed_clients: DataFrame) -> DataFrame:
    """The profile after a run, from the one before it. ``cards``, ``accounts``, ``clients``: the histories after the
    run; ``changed_*``: the keys whose versions it changed (more keys cost time and change nothing)."""
    reached = reached_cards(profile, changed_cards, changed_accounts, changed_clients)
    kept = profile.join(reached, F.col("_pf_key").eqNullSafe(F.col("card")), "left_anti")
    some = cards.join(reached, F.trim("card_num").eqNullSafe(F.col("card")), "left_semi")
    theirs = accounts.join(some.select("account_num").distinct(), "account_num", "left_semi")
    owners = clients.join(theirs.select(F.col("client").alias("client_id")).distinct(), "client_id", "left_semi")
    return kept.unionByName(card_profile(some, theirs, owners).select(*kept.columns))
