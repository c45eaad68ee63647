"""Sequence patterns with repetition: steps like ``REJECT{3,} SUCCESS`` over a key's consecutive rows.

A pattern is a list of steps, each a condition on a row and how often it may repeat; ``link`` is a condition between
every two neighbours of a chain (``amt < previous_amt``), and ``within`` bounds the time from a chain's first row to its
last. The pattern is compiled to an automaton whose state is (step, where the chain began, where its second step began,
how often the current step has held). Rows of a key are read in order; a row belongs to the first step whose condition
holds, and the state after it follows from the one before. Each step is one window expression over the same sort: a run
of rows of a step is entered from a row of the step before in an accepting state, and carries that chain along.

A chain is reported once, by its last row, at its longest: the first step begins as early as the conditions, its
maximum and the time limit allow. So a chain of eight is one match of eight rows, not five of four.

Hot keys: rows are cut into (key, time bucket) groups of ``split * within``, and a row in the last ``within`` of its
bucket is also looked back at by the next one (about 1 + 1/split rows are shuffled, once). A chain ends in one bucket
and begins at most ``within`` earlier, so every group sees all of the chains it reports.

Defined results: rows without a time belong to no chain; a NULL key is a key like others; a condition that is NULL does
not hold; rows of one time are ordered by the tie-break; times are compared to the microsecond.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions import epoch_seconds_sql


@dataclass(frozen=True)
class Step:
    """A condition (SQL over a row) that holds for at least ``low`` and at most ``high`` consecutive rows."""

    when: str
    low: int = 1
    high: int | None = 1

    def __post_init__(self):
        if self.low < 1 or (self.high is not None and self.high < self.low):
            raise ValueError("a step holds at least once, and at most as often as its maximum")


#: The amount-probing rule: rejected operations of falling amounts, then one that succeeds.
PROBING = (Step("oper_result = 'REJECT'", 3, None), Step("oper_result = 'SUCCESS'"))
FALLING = "amt < previous_amt"


def match_chains(df: DataFrame, steps: Sequence[Step], keys: str | Sequence[str], ts: str, tiebreak: str,
                 within: dt.timedelta, link: str = "true", linked: Sequence[str] = (), split: int = 4) -> DataFrame:
    """The last row of each chain, with ``chain_start`` (time of its first row), ``chain_rows`` and ``chain_repeats``
    (rows of the first step). ``link`` may use the columns ``linked`` of the row before as ``previous_<column>``. Two
    steps at least; the last one has a fixed number of rows."""
    steps = list(steps)
    if len(steps) < 2 or steps[-1].low != steps[-1].high:
        raise ValueError("a pattern has two steps or more, and the last one a fixed number of rows")
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = int(within.total_seconds())
    if w <= 0 or within.total_seconds() != w:
        raise ValueError("within must be a positive whole number of seconds")
    width = w * split
    sec = epoch_seconds_sql(ts)
    home = f"floor(_sec / {width})"
    late = f"_sec - {home} * {width} >= {width - w}"
    by_time = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)}, _grp ORDER BY _us"
    group = f"{by_time}, `{tiebreak}`"
    in_time = f"({by_time} RANGE BETWEEN {w * 1000000} PRECEDING AND CURRENT ROW)"
    rows = df.where(f"`{ts}` IS NOT NULL").selectExpr("*", f"{sec} AS _sec").selectExpr(
        "*", f"_sec * 1000000 + CAST(date_format(`{ts}`, 'SSSSSS') AS BIGINT) AS _us",
        f"explode(IF({late}, array({home}, {home} + 1), array({home}))) AS _grp")
    label = "CASE " + " ".join(f"WHEN {s.when} THEN {i}" for i, s in enumerate(steps)) + " END"
    rows = rows.selectExpr("*", f"{label} AS _step", f"row_number() OVER ({group}) AS _rn",
                           *[f"lag(`{c}`) OVER ({group}) AS previous_{c}" for c in linked])
    rows = rows.selectExpr("*", f"lag(_step) OVER ({group}) AS _from", f"coalesce({link}, false) AS _linked",
                           f"min(_rn) OVER {in_time} AS _reach", f"min(_us) OVER {in_time} AS _reach_us")
    # where the run of rows of one step began: its row number and time
    rows = rows.selectExpr("*", "_linked AND _from <=> _step AS _goes_on").selectExpr(
        "*", f"last(IF(_goes_on, NULL, named_struct('rn', _rn, 'us', _us)), true) OVER ({group} ROWS BETWEEN UNBOUNDED "
             "PRECEDING AND CURRENT ROW) AS _run")
    # the chain that a row of step s belongs to: begin (row, time) and the row where its second step began
    chain = "IF(_step = 0, named_struct('rn', _run.rn, 'us', _run.us, 'second', CAST(NULL AS INT)), NULL)"
    rows = rows.selectExpr("*", f"{chain} AS _chain")
    for s in range(1, len(steps)):
        before = steps[s - 1]
        held = "_rn - _run.rn + 1"
        accepts = f"{held} >= {before.low}" + (
            f" AND {held} <= {before.high}" if before.high is not None and s > 1 else "")
        second = "_rn + 1" if s == 1 else "_chain.second"
        leaves = f"IF(_step = {s - 1} AND _chain IS NOT NULL AND {accepts}, named_struct('rn', _chain.rn, 'us', _chain.us, " \
                 f"'second', {second}), NULL)"
        rows = rows.selectExpr("*", f"lag({leaves}) OVER ({group}) AS _left")
        enters = f"IF(_step = {s} AND NOT _goes_on, named_struct('c', IF(_linked, _left, NULL)), NULL)"
        rows = rows.selectExpr(*[c for c in rows.columns if c not in ("_left", "_chain")],
                               f"last({enters}, true) OVER ({group} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _in",
                               "_chain AS _old").selectExpr(
            *[c for c in rows.columns if c not in ("_left", "_chain")],
            f"IF(_step = {s}, _in.c, _old) AS _chain")
    end = f"_step = {len(steps) - 1} AND _rn - _run.rn + 1 = {steps[-1].low} AND _chain IS NOT NULL"
    high = steps[0].high
    least = "0" if high is None else f"_chain.second - {high}"
    found = rows.where(f"_grp = {home} AND {end}").selectExpr(
        "*", f"greatest(_chain.rn, _reach, {least}) AS _start").where(f"_chain.second - _start >= {steps[0].low}")
    if high is not None:  # the chain may begin behind its run: the time is that of another row
        times = rows.selectExpr(*[f"`{k}` AS _k{i}" for i, k in enumerate(keys)], "_grp AS _g", "_rn AS _r", "_us AS _at")
        on = " AND ".join([f"`{k}` <=> _k{i}" for i, k in enumerate(keys)] + ["_grp = _g", "_start = _r"])
        found = found.join(times, F.expr(on)).withColumn("_begin", F.col("_at"))
    else:
        found = found.selectExpr("*", "IF(_start = _chain.rn, _chain.us, _reach_us) AS _begin")
    began = "TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(_begin / 1000000 AS DECIMAL(18, 6)))"
    return found.selectExpr(*df.columns, f"{began} AS chain_start", "CAST(_rn - _start + 1 AS BIGINT) AS chain_rows",
                            "CAST(_chain.second - _start AS BIGINT) AS chain_repeats")


def probing_chains(facts: DataFrame, within: dt.timedelta) -> DataFrame:
    """Chains of three or more rejected operations of falling amounts that end in a successful one, on each card."""
    return match_chains(facts, PROBING, "card_num", "trans_date", "trans_id", within, FALLING, ["amt"])
