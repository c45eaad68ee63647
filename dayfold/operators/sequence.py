"""Ordered neighbours per key (``LEAD``) without letting one hot key become one task.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task; a card holding a third of
all transactions would then be a single sorted partition. Rules only look at neighbours within a time
horizon ``within`` (1 hour for travel, 20 minutes for amount probing), so the window can be split by
time instead:

* rows are cut into buckets of ``split * within`` per key;
* a row also joins the *previous* bucket's group when it lies in the first ``within`` of its bucket
  (a look-ahead copy, so about ``1 + 1/split`` rows are shuffled);
* ``LEAD`` runs per ``(key, bucket)`` and only the home copies are kept.

For a home row the following rows of its group are exactly the true following rows up to the group's
horizon (end of the bucket + ``within``), so a lead that lies within ``within`` of the row is always the
true lead; a lead beyond the horizon comes back NULL. Every rule condition requires the neighbour to be
within ``within``, so the result is exact, and a hot key is spread over ``span / (split*within)`` tasks.

``lead_split`` is the unconditional ``LEAD`` at any distance, also split by time (two-level: inside a
bucket, then across buckets through a small per-group table); ``lead_all`` is the plain single window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions import epoch_seconds_sql


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def neighbours_within(df: DataFrame, keys: str | Sequence[str], ts: str, tiebreak: str | None,
                      cols: Sequence[str], offsets: int, within: dt.timedelta, split: int = 4,
                      prefix: str = "next") -> DataFrame:
    """Add ``{prefix}{i}_{c}`` = LEAD(c, i) per ``keys`` ordered by ``(ts, tiebreak)`` for i in 1..offsets.

    Exact whenever the i-th following row is no later than ``ts + within``; otherwise it may be NULL.
    """
    keys = _cols(keys)
    w_sec = int(within.total_seconds())
    if w_sec <= 0 or within.total_seconds() != w_sec:
        raise ValueError("within must be a positive whole number of seconds")
    width = w_sec * split
    sec = epoch_seconds_sql(ts)
    order = ", ".join([ts] + ([tiebreak] if tiebreak else []))
    over = f"OVER (PARTITION BY {', '.join(keys)}, _grp ORDER BY {order})"
    staged = df.selectExpr("*", f"{sec} AS _sec").selectExpr(
        "*", f"explode(IF(_sec - floor(_sec / {width}) * {width} < {w_sec},"
             f" array(floor(_sec / {width}), floor(_sec / {width}) - 1), array(floor(_sec / {width})))) AS _grp")
    leads = [f"lead({c}, {i}) {over} AS {prefix}{i}_{c}" for i in range(1, offsets + 1) for c in cols]
    return (staged.selectExpr("*", *leads)
            .where(F.expr(f"_grp = floor(_sec / {width})"))
            .drop("_sec", "_grp"))


def lead_all(df: DataFrame, keys: str | Sequence[str], ts: str, tiebreak: str | None,
             cols: Sequence[str], offsets: int, prefix: str = "next") -> DataFrame:
    """Unconditional LEAD(c, 1..offsets) in one window (offsets 2, 3 share the window, no nested CTEs)."""
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    w = Window.partitionBy(*[F.col(k) for k in _cols(keys)]).orderBy(*order)
    return df.select("*", *[F.lead(c, i).over(w).alias(f"{prefix}{i}_{c}")
                            for i in range(1, offsets + 1) for c in cols])


def lead_split(df: DataFrame, keys: str | Sequence[str], ts: str, tiebreak: str | None, cols: Sequence[str],
               offsets: int, bucket: dt.timedelta = dt.timedelta(days=1), prefix: str = "next") -> DataFrame:
    """Unconditional LEAD(c, 1..offsets) per ``keys`` ordered by ``(ts, tiebreak)``, exact at any distance,
    with a hot key split into ``(key, time bucket)`` groups.

    1. ``LEAD`` inside each ``(key, bucket)`` group (the only shuffle of the full data);
    2. the first ``offsets`` rows of every group (bounded) are collected per group;
    3. a window over that per-group table (one row per key and non-empty bucket) gives each group the
       heads of its next ``offsets`` non-empty groups — enough rows, since each non-empty group has one;
    4. rows near the end of their group take the missing leads from that continuation, joined on
       ``(key, bucket)``, which is already the partitioning of step 1.
    """
    keys = _cols(keys)
    k = offsets
    b_sec = int(bucket.total_seconds())
    order = ", ".join([ts] + ([tiebreak] if tiebreak else []))
    # A struct is never NULL and compares its fields null-safely, so rows without a key or a time are groups like
    # any other, and the join below stays an equi-join on the window's own partitioning.
    group = ", ".join(f"'k{i}', {c}" for i, c in enumerate(keys))
    over = f"OVER (PARTITION BY _g ORDER BY {order})"
    base = df.selectExpr("*", f"named_struct({group}, 'b', CAST(floor({epoch_seconds_sql(ts)} / {b_sec}) AS BIGINT)) AS _g")
    within = base.selectExpr(
        "*", f"row_number() {over} AS _rn",
        *[f"lead(1, {i}) {over} AS _has{i}" for i in range(1, k + 1)],
        *[f"lead({c}, {i}) {over} AS _in{i}_{j}" for i in range(1, k + 1) for j, c in enumerate(cols)],
    )
    head = ", ".join([f"'_t', {ts}"] + ([f"'_tb', {tiebreak}"] if tiebreak else []) +
                     [f"'_c{j}', {c}" for j, c in enumerate(cols)])
    # `row_number <= k` is planned as a group limit on both sides of its exchange, so this branch
    # shuffles at most k rows per group and map task, not the data.
    heads = (within.where(f"_rn <= {k}").groupBy("_g")
             .agg(F.expr(f"array_sort(collect_list(named_struct({head}))) AS _heads")))
    of_key = ", ".join(f"_g.k{i}" for i in range(len(keys)))
    following = f"OVER (PARTITION BY {of_key} ORDER BY _g.b ROWS BETWEEN 1 FOLLOWING AND {k} FOLLOWING)"
    cont = heads.selectExpr("_g", f"slice(flatten(collect_list(_heads) {following}), 1, {k}) AS _cont")
    joined = within.join(cont, "_g", "left")
    inside = " + ".join(f"IF(_has{i} IS NULL, 0, 1)" for i in range(1, k + 1))
    leads = [f"IF(_has{i} IS NOT NULL, _in{i}_{j}, get(_cont, {i - 1} - ({inside}))._c{j}) AS {prefix}{i}_{c}"
             for i in range(1, k + 1) for j, c in enumerate(cols)]
    return joined.selectExpr(*df.columns, *leads)
