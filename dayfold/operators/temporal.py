"""Temporal (validity-interval) joins against SCD2 history dimensions.

``fact ⟕ dim ON fact.key = dim.key AND fact.at BETWEEN dim.effective_from AND dim.effective_to``.
The equality on the key lets Spark plan a hash/sort-merge join with the interval as a residual
condition (never a nested loop); many versions per key only multiply work inside that key. Whether
the dimension side is broadcast is left to Spark's size checks (``autoBroadcastJoinThreshold`` on
plan statistics, and AQE on the actual shuffle size), so a dimension that outgrows the threshold
falls back to a shuffled join instead of failing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dim_view(dim: DataFrame, key: str, attrs: list[str], prefix: str, trim_key: bool = False) -> DataFrame:
    """Project a history dimension for a temporal join.

    The key becomes ``{prefix}_key`` (trimmed when the dimension stores padded keys: ``'abc' = 'abc '`` is
    false in Spark), validity becomes ``{prefix}_from``/``{prefix}_to``; only ``attrs`` are carried, so the
    scan reads just those columns.
    """
    k = f"trim({key})" if trim_key else key
    return dim.selectExpr(f"{k} AS {prefix}_key", *attrs, f"effective_from AS {prefix}_from",
                          f"effective_to AS {prefix}_to")


def temporal_join(facts: DataFrame, view: DataFrame, fact_key: str, at: str, prefix: str,
                  how: str = "left", keep_validity: bool = False) -> DataFrame:
    """Join each fact to the dimension version(s) valid at ``at`` (inclusive bounds)."""
    cond = F.expr(f"{fact_key} = {prefix}_key AND {at} BETWEEN {prefix}_from AND {prefix}_to")
    out = facts.join(view, cond, how)
    drop = [f"{prefix}_key"] + ([] if keep_validity else [f"{prefix}_from", f"{prefix}_to"])
    return out.drop(*drop)


CLIENT_ATTRS = ["last_name", "first_name", "patronymic", "passport_num", "passport_valid_to", "phone"]


def enrich(facts: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
           terminals: DataFrame | None = None, at: str = "trans_date", card_key: str = "card_num",
           terminal_key: str = "terminal") -> DataFrame:
    """fact → (terminal) → card → account → client, every step as of ``at``, left outer throughout.

    Adds ``account_num, valid_to, client, last_name, first_name, patronymic, passport_num,
    passport_valid_to, phone`` (and ``terminal_city`` when terminals are given).
    """
    out = facts
    if terminals is not None:
        out = temporal_join(out, dim_view(terminals, "terminal_id", ["terminal_city"], "_tm"), terminal_key, at, "_tm")
    out = temporal_join(out, dim_view(cards, "card_num", ["account_num"], "_cd", trim_key=True), card_key, at, "_cd")
    out = temporal_join(out, dim_view(accounts, "account_num", ["valid_to", "client"], "_ac"), "account_num", at, "_ac")
    out = temporal_join(out, dim_view(clients, "client_id", CLIENT_ATTRS, "_cl"), "client", at, "_cl")
    return out


# --- card profile: card -> account -> client pre-joined as validity segments -------------------------

_US = dt.timedelta(microseconds=1)


def _overlay(base: DataFrame, base_cols: list[str], join_col: str, view: DataFrame, attrs: list[str]) -> DataFrame:
    """Split each base segment ``[_seg_from, _seg_to]`` by the versions of ``view`` valid inside it.

    Output per base segment: one segment per overlapping version (their intersection, with the version's
    ``attrs``) plus the uncovered gaps (``attrs`` NULL), so that for every instant t the segments covering
    t are exactly the rows a left join ``... ON key = _vk AND t BETWEEN _vf AND _vt`` would give for it.
    """
    ident = base_cols + ["_seg_from", "_seg_to"]
    # identical base segments stay distinct rows (a join would keep both)
    b = base.withColumn("_dup", F.row_number().over(Window.partitionBy(*ident).orderBy(*ident)))
    sid = ident + ["_dup"]
    overlap = ((F.col(join_col) == F.col("_vk")) & (F.col("_vf") <= F.col("_seg_to"))
               & (F.col("_vt") >= F.col("_seg_from")))
    j = b.join(view, overlap, "left")
    cs, ce = F.greatest("_seg_from", "_vf"), F.least("_seg_to", "_vt")
    j = j.withColumn("_cs", cs).withColumn("_ce", ce)
    w = Window.partitionBy(*sid).orderBy("_cs", "_ce")
    whole = Window.partitionBy(*sid)
    us = F.lit(_US)
    j = j.select(
        "*",
        F.max("_ce").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"),
        F.max("_ce").over(whole).alias("_all_end"),
        F.row_number().over(w).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_cnt"),
    )
    matched = F.col("_vk").isNotNull()
    nulls = [F.lit(None).cast(view.schema[a].dataType).alias(a) for a in attrs]
    keep = [F.col(c) for c in base_cols]

    def seg(vals, frm, to):
        return F.struct(*keep, *vals, frm.alias("_seg_from"), to.alias("_seg_to"))

    gap_from = F.coalesce(F.col("_prev") + us, F.col("_seg_from"))
    pieces = F.array(
        F.when(matched, seg([F.col(a) for a in attrs], F.col("_cs"), F.col("_ce"))),
        F.when(matched & (gap_from <= F.col("_cs") - us), seg(nulls, gap_from, F.col("_cs") - us)),
        F.when(matched & (F.col("_rn") == F.col("_cnt")) & (F.col("_all_end") < F.col("_seg_to")),
               seg(nulls, F.col("_all_end") + us, F.col("_seg_to"))),
        F.when(~matched, seg(nulls, F.col("_seg_from"), F.col("_seg_to"))),
    )
    return j.select(F.inline(F.filter(pieces, lambda x: x.isNotNull())))


def card_profile(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 window: tuple[dt.datetime, dt.datetime] | None = None) -> DataFrame:
    """Card -> account -> client as validity segments per (trimmed) card number.

    For every card and instant t, the segments covering t equal the rows of
    ``card ⟕ account ⟕ client`` (each ``t BETWEEN effective_from AND effective_to``, left outer), NULLs
    included. Facts then need one temporal join on the card number instead of three chained ones, so a
    day's facts are shuffled once for enrichment; the profile is built from the dimensions only.

    ``window`` (inclusive bounds) restricts the profile to the instants a run can look up: only versions
    valid in it take part and card segments are clipped to it, so the profile holds about one segment per
    card alive in the window instead of one per overlapping version pair over all history.
    """
    cards_ = cards
    lo = hi = None
    if window is not None:
        lo, hi = (f"TIMESTAMP_NTZ '{w.strftime('%Y-%m-%d %H:%M:%S.%f')}'" for w in window)
        live = f"effective_to >= {lo} AND effective_from <= {hi}"
        cards_, accounts, clients = cards.where(live), accounts.where(live), clients.where(live)
    frm = f"greatest(effective_from, {lo})" if lo else "effective_from"
    to = f"least(effective_to, {hi})" if hi else "effective_to"
    base = cards_.selectExpr("trim(card_num) AS _card", "account_num", f"{frm} AS _seg_from", f"{to} AS _seg_to")
    acc = accounts.selectExpr("account_num AS _vk", "valid_to", "client", "effective_from AS _vf",
                              "effective_to AS _vt")
    level1 = _overlay(base, ["_card", "account_num"], "account_num", acc, ["valid_to", "client"])
    cl = clients.selectExpr("client_id AS _vk", *CLIENT_ATTRS, "effective_from AS _vf", "effective_to AS _vt")
    level2 = _overlay(level1, ["_card", "account_num", "valid_to", "client"], "client", cl, CLIENT_ATTRS)
    return level2.selectExpr("_card AS _pf_key", "account_num", "valid_to", "client", *CLIENT_ATTRS,
                             "_seg_from AS _pf_from", "_seg_to AS _pf_to")


def enrich_profile(facts: DataFrame, profile: DataFrame, terminals: DataFrame | None = None,
                   at: str = "trans_date", card_key: str = "card_num", terminal_key: str = "terminal") -> DataFrame:
    """``enrich`` through a ``card_profile``: same rows and columns, one temporal join for the chain."""
    out = facts
    if terminals is not None:
        out = temporal_join(out, dim_view(terminals, "terminal_id", ["terminal_city"], "_tm"), terminal_key, at, "_tm")
    return temporal_join(out, profile, card_key, at, "_pf")
