"""The four fraud rules and the accumulating report.

Output columns everywhere: ``event_dt, passport, fio, phone, event_type, report_dt``.

Daily form (``run_date`` = D): facts must not contain rows after D (``trans_date < D + 1 day``); the
rules then read only a bounded slice of the fact table, which is exact:

* R1, R2 emit rows of day D only.
* R3 emits rows of day D whose next transaction (same card) is in another city within ``within``, kept
  only when its time equals some person's latest hit time. Rows of D look forward only, and a person's
  latest hit lies on D exactly when that person has a hit on D, so day D alone gives the same rows as the
  whole history.
* R4 emits the last of four rows, at or after D 00:00, whose first row is at most ``within`` earlier,
  so facts from ``D 00:00 - within`` suffice.

Accumulated form (one pass over many days, equal to the sum of the daily runs): R1/R2 without the day
filter, R3 per (day, card) and (day, person), R4 over all facts; ``report_dt`` = day of the event.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions import FULL_NAME_SQL, as_date, full_name, ntz, on_day
from dayfold.operators.sequence import neighbours_within
from dayfold.operators.temporal import enrich, enrich_profile

# Fixed values from the task statement: rule windows and result codes.
TRAVEL_WITHIN = dt.timedelta(hours=1)
PROBE_WITHIN = dt.timedelta(minutes=20)
REJECT, SUCCESS = "REJECT", "SUCCESS"
EXPIRED_PASSPORT, EXPIRED_CONTRACT, IMPOSSIBLE_TRAVEL, AMOUNT_PROBING = "1", "2", "3", "4"

REPORT_COLS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]


FIO_SQL = "last_name || ' ' || first_name || ' ' || patronymic"


def report_rows(df: DataFrame, event_dt: str, event_type: str, report_dt: str) -> DataFrame:
    """Project rule hits to the report's columns (``report_dt``: a SQL expression)."""
    return df.selectExpr(f"{event_dt} AS event_dt", "passport_num AS passport", f"{FIO_SQL} AS fio", "phone",
                         f"'{event_type}' AS event_type", f"{report_dt} AS report_dt")


def _report_dt(run_date, at: str) -> str:
    return f"DATE '{as_date(run_date)}'" if run_date is not None else f"to_date({at})"


def dims_for_run(run_date, *dims: DataFrame, since: dt.timedelta = dt.timedelta(0)) -> tuple[DataFrame, ...]:
    """History dimensions cut to versions valid in ``[run_date - since, run_date + 1 day)``.

    Only those versions can match the run's facts, so the cut is exact; it reaches the dimension scans
    and leaves a temporal join about one version per key to compare."""
    d = as_date(run_date)
    lo = dt.datetime.combine(d, dt.time()) - since
    live = (f"effective_to >= TIMESTAMP_NTZ '{lo:%Y-%m-%d %H:%M:%S}'"
            f" AND effective_from < TIMESTAMP_NTZ '{d + dt.timedelta(days=1)} 00:00:00'")
    return tuple(x.where(live) for x in dims)


def facts_of_day(facts: DataFrame, run_date, ts: str = "trans_date") -> DataFrame:
    return facts.where(on_day(ts, run_date))


def facts_until(facts: DataFrame, run_date, since: dt.timedelta | None = None, ts: str = "trans_date") -> DataFrame:
    """Facts before ``run_date + 1 day`` (and from ``run_date - since`` when given)."""
    d = as_date(run_date)
    cond = F.col(ts) < ntz(d + dt.timedelta(days=1))
    if since is not None:
        cond = cond & (F.col(ts) >= ntz(dt.datetime.combine(d, dt.time()) - since))
    return facts.where(cond)


def first_listing(blacklist: DataFrame) -> DataFrame:
    """Earliest entry per passport: ``p IN (SELECT passport_num ... WHERE t >= entry_dt)`` holds exactly
    when the passport's earliest entry is not after ``t``. Pre-aggregating turns the correlated IN into
    an equi left join against at most one row per passport (map-side partial aggregation)."""
    return blacklist.groupBy(F.col("passport_num").alias("_bl_passport")).agg(F.min("entry_dt").alias("_bl_first"))


def passport_flag(blacklist: DataFrame | None) -> Column:
    """Passport expired before the operation (a date compares as its midnight), or listed no later."""
    expired = "passport_valid_to IS NOT NULL AND passport_valid_to < trans_date"
    return F.expr(expired if blacklist is None else f"({expired}) OR _bl_first <= trans_date")


def with_blacklist(enriched: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    if blacklist is None:
        return enriched
    return enriched.join(first_listing(blacklist), F.col("passport_num") == F.col("_bl_passport"), "left")


def expired_or_blocked(enriched: DataFrame, blacklist: DataFrame | None, run_date=None) -> DataFrame:
    """R1: passport expired before the operation, or listed no later than it."""
    df = enriched if run_date is None else facts_of_day(enriched, run_date)
    df = with_blacklist(df, blacklist).where(passport_flag(blacklist))
    return report_rows(df, "trans_date", EXPIRED_PASSPORT, _report_dt(run_date, "trans_date"))


def contract_expired(enriched: DataFrame, run_date=None) -> DataFrame:
    """R2: the account's contract ended before the operation (a date compares as its midnight)."""
    df = enriched if run_date is None else facts_of_day(enriched, run_date)
    df = df.where(F.col("valid_to") < F.col("trans_date"))
    return report_rows(df, "trans_date", EXPIRED_CONTRACT, _report_dt(run_date, "trans_date"))


def travel_neighbours(enriched: DataFrame, within: dt.timedelta = TRAVEL_WITHIN, per_day: bool = False) -> DataFrame:
    """Adds the next transaction's city and time (same card; per day in the accumulated form) and ``_hit``."""
    keys = ["card_num"] + (["_day"] if per_day else [])
    df = enriched.selectExpr("*", "to_date(trans_date) AS _day")
    n = neighbours_within(df, keys, "trans_date", "trans_id", ["terminal_city", "trans_date"], 1, within)
    secs = int(within.total_seconds())
    return n.selectExpr("*", "coalesce(terminal_city <> next1_terminal_city AND next1_trans_date - trans_date"
                             f" <= make_dt_interval(0, 0, 0, {secs}), false) AS _hit")


def travel_hits(enriched: DataFrame, within: dt.timedelta = TRAVEL_WITHIN, per_day: bool = False) -> DataFrame:
    """Rows whose next transaction of the same card is in a different city no later than ``within``."""
    return travel_neighbours(enriched, within, per_day).where(F.col("_hit"))


HIT_COLS = ["trans_date", "passport_num", "last_name", "first_name", "patronymic", "phone"]


def travel_last_hit(hits: DataFrame, per_day: bool = False) -> DataFrame:
    """Latest hit time per displayed full name (NULL names form one group, as GROUP BY does)."""
    keys = ["fio"] + (["_day"] if per_day else [])
    return hits.withColumn("fio", full_name()).groupBy(*keys).agg(F.max("trans_date").alias("last_hit"))


def keep_latest_hits(hits: DataFrame, per_day: bool, cols: list[str] | None = None) -> DataFrame:
    """``trans_date IN (SELECT max(trans_date) ... GROUP BY fio)`` — not tied to the person (parity, Q10).

    The latest time per person comes from the max of a struct led by the time (map-side partial
    aggregation, so a hot name such as all NULL names collapses before the shuffle). Both consumers of
    ``hits`` reference the same columns, so Spark plans the enrichment and the window once and reuses
    its exchange for the aggregate instead of computing the day twice."""
    cols = cols or (HIT_COLS + (["_day"] if per_day else []))
    # explicit, so the join's inferred `IS NOT NULL` constraints add nothing that makes the branches differ
    hits = hits.select(*cols).where("trans_date IS NOT NULL")
    keys = [F.expr(f"{FULL_NAME_SQL} AS fio")] + ([F.col("_day")] if per_day else [])
    last = hits.groupBy(*keys).agg(F.expr(f"max(struct({', '.join(cols)})) AS _m")).selectExpr(
        "_m.trans_date AS _last", *(["_m._day AS _last_day"] if per_day else []))
    cond = "trans_date = _last" + (" AND _day = _last_day" if per_day else "")
    return hits.join(last, F.expr(cond), "left_semi")


def impossible_travel(enriched: DataFrame, run_date=None, within: dt.timedelta = TRAVEL_WITHIN) -> DataFrame:
    """R3. ``enriched`` needs ``terminal_city``. Daily form: pass the enriched facts of ``run_date``."""
    per_day = run_date is None
    df = enriched if per_day else facts_of_day(enriched, run_date)
    kept = keep_latest_hits(travel_hits(df, within, per_day), per_day)
    return report_rows(kept, "trans_date", IMPOSSIBLE_TRAVEL, _report_dt(run_date, "trans_date"))


def probing_chains(facts: DataFrame, within: dt.timedelta = PROBE_WITHIN, since=None) -> DataFrame:
    """Four consecutive operations of a card: REJECT, REJECT, REJECT, SUCCESS, each amount below the
    previous, last no later than ``within`` after the first. One row per chain, at its first operation."""
    n = neighbours_within(facts, "card_num", "trans_date", "trans_id",
                          ["oper_result", "amt", "trans_date"], 3, within)
    cond = (f"oper_result = '{REJECT}' AND next1_oper_result = '{REJECT}' AND next2_oper_result = '{REJECT}'"
            f" AND next3_oper_result = '{SUCCESS}' AND next1_amt < amt AND next2_amt < next1_amt"
            f" AND next3_amt < next2_amt"
            f" AND next3_trans_date - trans_date <= make_dt_interval(0, 0, 0, {int(within.total_seconds())})")
    if since is not None:
        cond += f" AND next3_trans_date >= TIMESTAMP_NTZ '{since} 00:00:00'"
    return n.where(cond).selectExpr("card_num", "next3_trans_date AS event_ts")


def amount_probing(facts: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                   run_date=None, within: dt.timedelta = PROBE_WITHIN) -> DataFrame:
    """R4: the successful last operation of a probing chain, client looked up as of that time.

    Daily form reads facts from ``run_date - within`` only. The terminal lookup of the original rule
    selects nothing and, with non-overlapping terminal versions, cannot change the row count: omitted.
    """
    if run_date is not None:
        facts = facts_until(facts, run_date, since=within)
        since = as_date(run_date)
    else:
        since = None
    chains = probing_chains(facts, within, since)
    hits = enrich(chains, cards, accounts, clients, at="event_ts")
    return report_rows(hits, "event_ts", AMOUNT_PROBING, _report_dt(run_date, "event_ts"))


def build_report(facts: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 terminals: DataFrame, blacklist: DataFrame | None, run_date=None,
                 travel_within: dt.timedelta = TRAVEL_WITHIN, probe_within: dt.timedelta = PROBE_WITHIN,
                 profile: DataFrame | None = None, fuse_probing: bool = True) -> DataFrame:
    """R5: all four rules for ``run_date`` (or accumulated over all facts when ``run_date`` is None).

    Daily form, one pass: facts from ``run_date - probe_within`` are enriched once (terminal, card,
    account, client, blacklist, each as of the operation) and one time-split window with horizon
    ``max(travel_within, probe_within)`` serves R3 and R4 (exact for both). R1-R3 flag rows of the day;
    R4 flags chain starts and takes the client of the chain's last operation as ``LEAD(..., 3)`` of the
    enriched rows, which is the client as of that operation. The hits of all rules are emitted from the
    same rows with ``inline`` (Spark does not share an enrichment across a union of separately written
    rules). The terminal lookup cannot multiply rows because merged terminal versions never overlap.

    Accumulated form: R1-R3 in one pass with the travel window per (day, card); R4 separately, since its
    chains may cross midnight.

    ``profile`` (a ``temporal.card_profile`` of the same dimensions) replaces the card -> account -> client
    join chain by one temporal join; the result is the same.

    Fusing R4 into the enriched window assumes a fact matches at most one version per dimension (versions
    of a key never overlap — what ``scd2.merge`` maintains); the original rule runs its window on the raw
    facts. ``fuse_probing=False`` runs R4 on its own (exact for any dimension contents).
    """

    def enriched_of(df: DataFrame) -> DataFrame:
        if profile is None:
            return with_blacklist(enrich(df, cards, accounts, clients, terminals), blacklist)
        # the listing joins the profile, not the facts: one shuffle of the facts less
        return enrich_profile(df, with_blacklist(profile, blacklist), terminals)

    per_day = run_date is None
    if per_day:
        n = travel_neighbours(enriched_of(facts), travel_within, per_day=True)
        r4 = amount_probing(facts, cards, accounts, clients, None, probe_within)
        return _emit(n, blacklist, [], True, None).unionByName(r4)

    d = as_date(run_date)
    cards, accounts, clients, terminals = dims_for_run(d, cards, accounts, clients, terminals, since=probe_within)
    if not fuse_probing:
        n = travel_neighbours(enriched_of(facts_of_day(facts, d)), travel_within)
        r4 = amount_probing(facts, cards, accounts, clients, d, probe_within)
        return _emit(n, blacklist, [], False, d).unionByName(r4)
    window_facts = facts_until(facts, d, since=probe_within)
    enriched = enriched_of(window_facts)
    probe_cols = ["oper_result", "amt", "trans_date"]
    client_cols = ["passport_num", "last_name", "first_name", "patronymic", "phone"]
    n = neighbours_within(enriched.selectExpr("*", "to_date(trans_date) AS _day"), "card_num", "trans_date",
                          "trans_id", ["terminal_city", *probe_cols, *client_cols], 3,
                          max(travel_within, probe_within))
    day_sql = f"trans_date >= TIMESTAMP_NTZ '{d} 00:00:00'"
    probe_s, travel_s = int(probe_within.total_seconds()), int(travel_within.total_seconds())
    chain = (f"oper_result = '{REJECT}' AND next1_oper_result = '{REJECT}' AND next2_oper_result = '{REJECT}'"
             f" AND next3_oper_result = '{SUCCESS}' AND next1_amt < amt AND next2_amt < next1_amt"
             f" AND next3_amt < next2_amt AND next3_trans_date - trans_date <= make_dt_interval(0, 0, 0, {probe_s})"
             f" AND next3_trans_date >= TIMESTAMP_NTZ '{d} 00:00:00'")
    travel = (f"{day_sql} AND terminal_city <> next1_terminal_city"
              f" AND next1_trans_date - trans_date <= make_dt_interval(0, 0, 0, {travel_s})")
    n = n.selectExpr("*", f"coalesce({travel}, false) AS _hit", f"coalesce({chain}, false) AS _r4")
    r4_cols = ["next3_trans_date"] + [f"next3_{x}" for x in client_cols]
    return _emit(n, blacklist, r4_cols, False, d, day_sql)


def _emit(n: DataFrame, blacklist: DataFrame | None, r4_cols: list[str], per_day: bool, run_date,
          day_sql: str | None = None) -> DataFrame:
    """R1-R3 (and the fused R4) rows from windowed, enriched facts carrying ``_hit`` (and ``_r4``).

    Built from SQL expressions: one driver call per step instead of one per column expression."""
    day_only = day_sql or "true"
    passport = "passport_valid_to IS NOT NULL AND passport_valid_to < trans_date"
    if blacklist is not None:
        passport = f"({passport}) OR _bl_first <= trans_date"
    cols = HIT_COLS + (["_day"] if per_day else []) + ["_r1", "_r2", "_hit"] + (["_r4", *r4_cols] if r4_cols else [])
    flag_any = "_r1 OR _r2 OR _hit" + (" OR _r4" if r4_cols else "")
    flagged = (n.selectExpr("*", f"coalesce({day_only} AND ({passport}), false) AS _r1",
                            f"coalesce({day_only} AND valid_to < trans_date, false) AS _r2")
               .where(flag_any).select(*cols).where("trans_date IS NOT NULL"))
    # Latest hit time per person (per day), distinct so the left join below cannot multiply rows. The
    # aggregate takes the latest whole row (max of a struct led by the time), so both consumers of
    # `flagged` need the same columns, are the same plan up to the window, and Spark reuses that
    # exchange instead of enriching the day twice. It only sees hit rows, with map-side partial merging.
    keys = [F.expr(f"{FULL_NAME_SQL} AS fio")] + ([F.col("_day")] if per_day else [])
    last = (flagged.where("_hit").groupBy(*keys).agg(F.expr(f"max(struct({', '.join(cols)})) AS _m"))
            .selectExpr("_m.trans_date AS _last", *(["_m._day AS _last_day"] if per_day else [])).distinct())
    cond = "trans_date = _last" + (" AND _day = _last_day" if per_day else "")
    marked = flagged.join(last, F.expr(cond), "left").selectExpr("*", "_hit AND _last IS NOT NULL AS _r3")
    rd = _report_dt(run_date, "trans_date")

    def hit(flag: str, code: str, p: str = "", at: str = "trans_date") -> str:
        fio = f"{p}last_name || ' ' || {p}first_name || ' ' || {p}patronymic"
        return (f"IF({flag}, named_struct('event_dt', {at}, 'passport', {p}passport_num, 'fio', {fio}, "
                f"'phone', {p}phone, 'event_type', '{code}', 'report_dt', {rd}), NULL)")

    hits = [hit("_r1", EXPIRED_PASSPORT), hit("_r2", EXPIRED_CONTRACT), hit("_r3", IMPOSSIBLE_TRAVEL)]
    if r4_cols:
        hits.append(hit("_r4", AMOUNT_PROBING, "next3_", "next3_trans_date"))
    return marked.selectExpr(f"inline(filter(array({', '.join(hits)}), x -> x IS NOT NULL))")
