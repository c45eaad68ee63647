"""Type-2 merge of several and backdated changes per key.

``scd2.merge`` takes the latest staged row of a key and changes its open version. Here every staged row counts, and it
counts from its own time, also when that lies before the open version begins: a key's history is a step function of
time, each version start and each staged change is an event that sets it, and the versions are read off the events in
order. So a backdated change cuts the closed version it falls into and holds up to the next known event; neighbours
that become equal are one version; no version ends before it starts and none overlap.

Rules, where ``at = coalesce(update_dt, run_ts)``:

1. a key never seen opens at the ``create_dt`` of its earliest staged row (rows order by ``coalesce(update_dt,
   create_dt)``), or at its first change if that is earlier; its other rows are changes;
2. a change of a known key holds from ``at`` until the next event; at the same second it replaces what is there, and of
   several changes at one second the latest row wins (ties: the larger attribute values);
3. a change dated inside a deleted version is ignored, unless ``reopen=True``: then it opens a live version there;
4. a key whose last version is live and that the source no longer has is closed at ``run_ts - 1 s`` and gets a deleted
   version from ``run_ts``, or a second after its last event if that is later. A deleted version carries the attributes
   of the live version before it, backdated ones included;
5. times are whole seconds (bounds are inclusive, versions a second apart): fractions of events are cut off. Gaps
   between versions stay gaps. Versions of one key must not overlap.

Where no key has more than one change, none is backdated and none is dated ``run_ts`` or later in the run that deletes
its key (there the plain merge ends a version before it starts), the result equals ``scd2.merge``. Re-applying a batch
changes nothing. A NULL key is a key like others; changes without any time are dated ``run_ts``.

Plan: only versions that a change can reach are events: the open ones, and closed ones of staged keys that end after the
key's first change; other closed versions pass through. One shuffle: events are first grouped by (key, second), which
collapses a key with very many staged rows on the map side to one row a second, at most 86,400 for a day of changes;
windows over the key in time order follow on the same partitioning and sort, so nothing is collected per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions import FLAG_DELETED, FLAG_LIVE, INF_TEXT
from dayfold.operators.scd2 import _q, _sql_ts

ONE = "INTERVAL 1 SECOND"


def merge_timeline(history: DataFrame, changes: DataFrame, keys: DataFrame | None, key: str, attrs: Sequence[str],
                   run_ts, created: str = "create_dt", updated: str = "update_dt", reopen: bool = False) -> DataFrame:
    """The history after applying all staged changes and the key set (None: no delete detection)."""
    untouched, written = merge_timeline_parts(history, changes, keys, key, attrs, run_ts, created, updated, reopen)
    return untouched.unionByName(written)


def merge_timeline_parts(history: DataFrame, changes: DataFrame, keys: DataFrame | None, key: str,
                         attrs: Sequence[str], run_ts, created: str = "create_dt", updated: str = "update_dt",
                         reopen: bool = False) -> tuple[DataFrame, DataFrame]:
    """``merge_timeline`` split into (closed versions that no change reaches, versions to be written)."""
    attrs = list(attrs)
    run, inf_ = _sql_ts(run_ts), _sql_ts(INF_TEXT)
    k, c, u = _q(key), _q(created), _q(updated)
    columns = [key, *attrs, "effective_from", "effective_to", "deleted_flg"]
    types = {f.name: f.dataType.simpleString() for f in history.schema.fields}
    fields = ", ".join(f"'v{i}', CAST({_q(a)} AS {types[a]})" for i, a in enumerate(attrs))
    attrs_t = "struct<" + ", ".join(f"v{i}: {types[a]}" for i, a in enumerate(attrs)) + ">"
    ts_t = "timestamp_ntz"
    state_t, staged_t, birth_t = (f"struct<{head}, v: {attrs_t}>" for head in (
        "rank: int, flag: string", f"ord: {ts_t}", f"ord: {ts_t}, created: {ts_t}"))

    def second(expr: str) -> str:
        return f"CAST(date_trunc('SECOND', {expr}) AS TIMESTAMP_NTZ)"

    def event(at="NULL", state="NULL", staged="NULL", birth="NULL", seen="false", alive="false") -> str:
        return (f"named_struct('at', CAST({at} AS {ts_t}), 'state', CAST({state} AS {state_t}), "
                f"'staged', CAST({staged} AS {staged_t}), 'birth', CAST({birth} AS {birth_t}), "
                f"'seen', {seen}, 'alive', {alive})")

    def events(df: DataFrame, *some: str) -> DataFrame:
        return df.selectExpr(k, f"inline(array({', '.join(some)}))")

    # closed versions that a change reaches
    at = second(f"coalesce({u}, {run})")
    first = changes.groupBy(F.col(key).alias("_staged")).agg(F.expr(f"min({at})").alias("_first"))
    is_open = F.expr(f"effective_to = {inf_}")
    closed = history.where(~is_open).join(first, F.col(key).eqNullSafe(F.col("_staged")), "left")
    reached = F.expr(f"coalesce(effective_to >= _first - {ONE}, false)")
    values = f"named_struct({fields})"
    start = event(second("effective_from"), f"named_struct('rank', 1, 'flag', deleted_flg, 'v', {values})")
    end = event(f"{second('effective_to')} + {ONE}", f"named_struct('rank', 0, 'flag', '-', 'v', CAST(NULL AS {attrs_t}))")
    known = event(seen="true")
    order = f"coalesce({u}, {c})"
    rows = [
        events(history.where(is_open), start, known),
        events(closed.where(reached), start, end, known),
        events(closed.where(~reached & F.col("_first").isNotNull()), known),
        events(changes, event(at, staged=f"named_struct('ord', {order}, 'v', {values})"),
               event(birth=f"named_struct('ord', {order}, 'created', {second(f'coalesce({c}, {u}, {run})')}, 'v', {values})")),
    ]
    if keys is not None:
        rows.append(events(keys, event(alive="true")))
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    # one row per key and second; the row without a time comes first and tells what holds for the whole key
    grouped = every.groupBy(key, "at").agg(*[F.expr(f"{f}({n}) AS {n}") for f, n in (
        ("max", "state"), ("max", "staged"), ("min", "birth"), ("max", "seen"), ("max", "alive"))])

    over = f"OVER (PARTITION BY {k} ORDER BY at NULLS FIRST"
    upto = f"{over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    told = grouped.selectExpr(
        k, "at", "state", "staged", "birth", f"max(seen) {upto} AS seen", f"max(alive) {upto} AS alive",
        f"last(state.flag, true) {upto} AS then", f"lead(at) {over}) AS following")
    counts = "true" if reopen else f"NOT (then <=> '{FLAG_DELETED}')"
    told = told.selectExpr(
        "*", "at IS NULL AND NOT seen AND birth IS NOT NULL AND (following IS NULL OR birth.created < following) AS opens",
        f"staged IS NOT NULL AND {counts} AS changes").where("opens OR changes OR state IS NOT NULL")
    told = told.selectExpr(
        k, "alive", "IF(opens, birth.created, at) AS at", f"IF(opens OR changes, '{FLAG_LIVE}', state.flag) AS flag",
        "CASE WHEN opens THEN birth.v WHEN changes THEN staged.v ELSE state.v END AS own")
    told = told.selectExpr(
        k, "alive", "at", "flag",
        f"IF(flag = '{FLAG_DELETED}', coalesce(last(IF(flag = '{FLAG_LIVE}', own, NULL), true) {upto}, own), own) AS v")
    told = told.selectExpr("*", f"lag(named_struct('flag', flag, 'v', v)) {over}) AS before")
    told = told.where("before IS NULL OR NOT (before <=> named_struct('flag', flag, 'v', v))")
    told = told.selectExpr("*", f"lead(at) {over}) AS following")
    gone = f"(following IS NULL AND flag = '{FLAG_LIVE}' AND NOT {'alive' if keys is not None else 'true'})"
    left = f"greatest({run}, at + {ONE})"

    def version(frm: str, to: str, flag: str) -> str:
        vs = ", ".join(f"'{a}', v.v{i}" for i, a in enumerate(attrs))
        return (f"named_struct('{key}', {k}, {vs}, 'effective_from', {frm}, 'effective_to', {to}, "
                f"'deleted_flg', {flag})")

    lasts = version("at", f"CASE WHEN {gone} THEN {left} - {ONE} ELSE coalesce(following - {ONE}, {inf_}) END", "flag")
    tomb = version(left, inf_, f"'{FLAG_DELETED}'")
    written = told.where("flag <> '-'").selectExpr(
        f"inline(filter(array({lasts}, IF({gone}, {tomb}, NULL)), x -> x IS NOT NULL))")
    return closed.where(~reached).select(*columns), written.select(*columns)
