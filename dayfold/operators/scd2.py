"""Type-2 history dimensions: new, changed and deleted keys in one distributed merge.

History rows: ``key, attrs..., effective_from, effective_to, deleted_flg`` with ``effective_to`` =
9999-12-31 for the current version and ``deleted_flg`` ``'n'``/``'y'``. Semantics per run (``run_ts`` =
run date 00:00):

1. a staged key never seen in history opens a version from its ``create_dt``;
2. a staged key whose current live version differs in any attribute (NULL-safe) closes it at
   ``update_dt - 1 s`` and opens a version from ``update_dt`` (``run_ts`` when ``update_dt`` is NULL);
3. a history key missing from the source's key set gets its current live version closed at
   ``run_ts - 1 s`` and a deleted (``'y'``) copy from ``run_ts`` (after 1 and 2, so a key new or changed
   and deleted in the same run gets both);
4. a deleted key sent again is not reopened unless ``reopen=True``.

Several staged rows for one key: the latest by ``coalesce(update_dt, create_dt)`` wins. Re-applying the
same batch changes nothing.

Plan: history's *current* versions, the staged rows and the key set are tagged and unioned, then one
``groupBy(key)`` gives per key (current live version, current deleted version, latest change, seen,
alive); partial aggregation runs map-side, so a key with many staged rows or versions is collapsed
before the shuffle. The 0-4 output versions are built as an array and ``inline``-d. Closed versions are
never shuffled: they only contribute their key to "seen" and pass through unchanged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType

from dayfold.functions import FLAG_DELETED, FLAG_LIVE, INF_TEXT, inf, ntz, null_safe_differs


def _ts(v) -> Column:
    return v if isinstance(v, Column) else ntz(v)


def is_current(flag: str = FLAG_LIVE) -> Column:
    return (F.col("effective_to") == inf()) & (F.col("deleted_flg") == flag)


def current(history: DataFrame) -> DataFrame:
    """Current view: open and not deleted."""
    return history.where(is_current())


def as_of(history: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts`` (inclusive bounds; deleted versions included, as the rules join them)."""
    return history.where(_ts(ts).between(F.col("effective_from"), F.col("effective_to")))


def new_keys(history: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str],
             created: str | None = "create_dt", run_ts=None) -> DataFrame:
    """D1: versions opened for staged keys absent from the whole history."""
    frm = F.col(created) if created else _ts(run_ts)
    return (changes.join(history.select(key), key, "left_anti")
            .select(key, *attrs, frm.alias("effective_from"), inf().alias("effective_to"),
                    F.lit(FLAG_LIVE).alias("deleted_flg")))


def changed_keys(history: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str],
                 updated: str | None = "update_dt", run_ts=None) -> DataFrame:
    """D2: staged rows whose key's current live version differs in some attribute (NULL-safe).

    Returns the key, the new attribute values and ``changed_at`` (the new version's start)."""
    cur = current(history).select(key, *[F.col(a).alias(f"_old_{a}") for a in attrs])
    j = changes.join(cur, key, "inner")
    differs = null_safe_differs([(F.col(a), F.col(f"_old_{a}")) for a in attrs])
    at = F.coalesce(F.col(updated), _ts(run_ts)) if updated else _ts(run_ts)
    return j.where(differs).select(key, *attrs, at.alias("changed_at"))


def deleted_keys(history: DataFrame, keys: DataFrame, key: str, attrs: Sequence[str], run_ts) -> DataFrame:
    """D5: deleted copies of current live versions whose key is missing from the source's key set."""
    return (current(history).join(keys.select(key), key, "left_anti")
            .select(key, *attrs, _ts(run_ts).alias("effective_from"), inf().alias("effective_to"),
                    F.lit(FLAG_DELETED).alias("deleted_flg")))


def merge(history: DataFrame, changes: DataFrame, keys: DataFrame | None, key: str, attrs: Sequence[str],
          run_ts, created: str | None = "create_dt", updated: str | None = "update_dt",
          reopen: bool = False) -> DataFrame:
    """D8: the history after applying one run's staged changes and key set (see module doc).

    ``created``/``updated`` None means a full snapshot without timestamps: ``run_ts`` supplies all bounds,
    and ``keys`` defaults to the snapshot's own keys. ``keys`` None otherwise means "no delete detection".
    """
    untouched, written = merge_parts(history, changes, keys, key, attrs, run_ts, created, updated, reopen)
    return untouched.unionByName(written)


def _sql_ts(v) -> str:
    if isinstance(v, dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(v, dt.date):
        v = v.strftime("%Y-%m-%d 00:00:00")
    return f"TIMESTAMP_NTZ '{v}'"


def _q(name: str) -> str:
    return f"`{name}`"


def merge_parts(history: DataFrame, changes: DataFrame, keys: DataFrame | None, key: str, attrs: Sequence[str],
                run_ts, created: str | None = "create_dt", updated: str | None = "update_dt",
                reopen: bool = False, closed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``merge`` split into (versions that were already closed: unchanged, versions this run writes: the
    complete current set plus the versions it closed). A versioned store appends only the second part.

    ``closed``: when the store keeps closed versions apart, pass them here and only the current versions
    as ``history``; the closed ones are then read for their key column only.

    The per-key logic is generated as SQL expressions (one call each, parsed JVM-side)."""
    attrs = list(attrs)
    run, inf_ = _sql_ts(run_ts), _sql_ts(INF_TEXT)
    snapshot = created is None
    if snapshot and keys is None:
        keys = changes.select(key)
    k = _q(key)

    htypes = {f.name: f.dataType for f in history.schema.fields}
    ctypes = {f.name: f.dataType for f in changes.schema.fields}
    ver_t = StructType([StructField("effective_from", htypes["effective_from"])] +
                       [StructField(a, htypes[a]) for a in attrs]).simpleString()
    chg_fields = [StructField("_ord", TimestampNTZType() if not snapshot else IntegerType())]
    if not snapshot:
        chg_fields += [StructField("_created", ctypes[created]), StructField("_updated", ctypes[updated])]
    chg_t = StructType(chg_fields + [StructField(a, ctypes[a]) for a in attrs]).simpleString()
    no_ver, no_chg = f"CAST(NULL AS {ver_t})", f"CAST(NULL AS {chg_t})"
    attr_fields = ", ".join(f"'{a}', {_q(a)}" for a in attrs)
    ver = f"named_struct('effective_from', effective_from, {attr_fields})"
    if snapshot:
        chg = f"named_struct('_ord', 0, {attr_fields})"
    else:
        c, u = _q(created), _q(updated)
        chg = f"named_struct('_ord', coalesce({u}, {c}), '_created', {c}, '_updated', {u}, {attr_fields})"

    def tag(o: str, y: str, s_: str, seen: str, alive: str) -> list[str]:
        return [k, f"{o} AS _o", f"{y} AS _y", f"{s_} AS _s", f"{seen} AS _seen", f"{alive} AS _alive"]

    tracked = f"coalesce(effective_to = {inf_} AND deleted_flg IN ('{FLAG_LIVE}', '{FLAG_DELETED}'), false)"
    # One scan of the history: current versions travel whole, every other version only as its key.
    parts = history.selectExpr(*tag(f"IF({tracked} AND deleted_flg = '{FLAG_LIVE}', {ver}, {no_ver})",
                                    f"IF({tracked} AND deleted_flg = '{FLAG_DELETED}', {ver}, {no_ver})",
                                    no_chg, "true", "false"))
    if closed is not None:
        parts = parts.unionByName(closed.selectExpr(*tag(no_ver, no_ver, no_chg, "true", "false")))
    parts = parts.unionByName(changes.selectExpr(*tag(no_ver, no_ver, chg, "false", "false")))
    if keys is not None:
        parts = parts.unionByName(keys.selectExpr(*tag(no_ver, no_ver, no_chg, "false", "true")))
    state = parts.groupBy(key).agg(*[F.expr(f"max(_{n}) AS {n}") for n in ("o", "y", "s", "seen", "alive")])

    differs = " OR ".join(f"NOT (o.{_q(a)} <=> s.{_q(a)})" for a in attrs) or "false"
    flags = state.selectExpr(
        "*",
        "s IS NOT NULL AND NOT seen AS _new",
        f"s IS NOT NULL AND o IS NOT NULL AND ({differs}) AS _chg",
        f"{'s IS NOT NULL AND o IS NULL AND y IS NOT NULL' if reopen else 'false'} AS _re",
        f"{run if snapshot else f'coalesce(s._updated, {run})'} AS _at",
    ).selectExpr(
        "*", "_new OR _chg OR _re AS _opens",
        f"NOT {'alive' if keys is not None else 'true'} AND (o IS NOT NULL OR _new OR _chg OR _re) AS _del",
    )

    def version(src: str, frm: str, to: str, flag: str) -> str:
        fields = ", ".join(f"'{a}', {src}.{_q(a)}" for a in attrs)
        return (f"named_struct('{key}', {k}, {fields}, 'effective_from', {frm}, 'effective_to', {to}, "
                f"'deleted_flg', '{flag}')")

    one_s = "INTERVAL 1 SECOND"
    new_from = f"IF(_new, {run if snapshot else 's._created'}, _at)"
    versions = ", ".join([
        f"IF(y IS NOT NULL, {version('y', 'y.effective_from', f'IF(_re, _at - {one_s}, {inf_})', FLAG_DELETED)}, NULL)",
        f"IF(o IS NOT NULL, {version('o', 'o.effective_from', f'CASE WHEN _chg THEN _at - {one_s} WHEN _del THEN {run} - {one_s} ELSE {inf_} END', FLAG_LIVE)}, NULL)",
        f"IF(_opens, {version('s', new_from, f'IF(_del, {run} - {one_s}, {inf_})', FLAG_LIVE)}, NULL)",
        f"IF(_del, IF(_opens, {version('s', run, inf_, FLAG_DELETED)}, {version('o', run, inf_, FLAG_DELETED)}), NULL)",
    ])
    merged = flags.selectExpr(f"inline(filter(array({versions}), v -> v IS NOT NULL))")
    cols = [key, *attrs, "effective_from", "effective_to", "deleted_flg"]
    untouched = history.where(f"NOT {tracked}").select(*cols)
    if closed is not None:
        untouched = untouched.unionByName(closed.select(*cols))
    return untouched, merged.select(*cols)


def merge_snapshot(history: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str], run_ts) -> DataFrame:
    """D7: merge a full snapshot without change timestamps (the run date supplies every bound);
    keys absent from the snapshot are deleted."""
    return merge(history, snapshot.select(key, *attrs), None, key, attrs, run_ts, created=None, updated=None)
