"""As-of join by a sweep: linear in facts and versions, whatever a key's number of versions.

``temporal.temporal_join`` compares every fact with every version of its key. Here facts and versions of a key form one
stream in time order, and each fact takes the version that started last. The stream is cut into (key, time bucket)
groups, so a key with half of all facts is many tasks; the version in force at the start of a group comes from a table
of one row per group, by a window over a key's groups in time order.

This needs versions that don't overlap, as the merges guarantee. The sweep sees every version beside the one before it
and raises an error where they overlap, rather than choosing one.

Same result as ``temporal_join`` (left, inclusive bounds): a fact before, between or after its key's versions, without
a key or without a time gets NULLs; versions without key or start are never found.

Plan: one shuffle of facts and versions by (key, bucket), which the windows and the join with the group table read. The
group table itself is aggregated map-side from keys and times only, and ordered by key in a second, small shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions import epoch_seconds_sql


def sweep_join(facts: DataFrame, view: DataFrame, fact_key: str, at: str, prefix: str,
               bucket: dt.timedelta = dt.timedelta(days=1), keep_validity: bool = False) -> DataFrame:
    """Join each fact to the version valid at ``at``. ``view`` as from ``temporal.dim_view``. ``bucket``: width of a
    group; choose it so that the hottest key's facts of one width fit a task."""
    width = int(bucket.total_seconds())
    if width <= 0:
        raise ValueError("bucket must be at least a second")
    key, frm, to = f"{prefix}_key", f"{prefix}_from", f"{prefix}_to"
    own = [c for c in view.columns if c != key]
    given = [c for c in own if keep_validity or c not in (frm, to)]
    version = "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in own) + ")"
    fact = "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in facts.columns) + ")"
    version_t, fact_t = (view.select(F.expr(version).alias("x")).schema["x"].dataType.simpleString(),
                         facts.select(F.expr(fact).alias("x")).schema["x"].dataType.simpleString())

    def rows(df: DataFrame, k: str, t: str, kind: int, f: str, v: str) -> DataFrame:
        sec = f"floor({epoch_seconds_sql(t)} / {width})"
        return df.selectExpr(f"named_struct('k', `{k}`, 'b', CAST({sec} AS BIGINT)) AS _g", f"`{t}` AS _t",
                             f"{kind} AS _kind", f"{f} AS _f", f"{v} AS _v")

    stream = rows(facts, fact_key, at, 1, fact, f"CAST(NULL AS {version_t})").unionByName(
        rows(view.where(f"`{key}` IS NOT NULL AND `{frm}` IS NOT NULL"), key, frm, 0, f"CAST(NULL AS {fact_t})", version))
    # one shuffle by group; everything below but the small table over groups keeps it
    over = "OVER (PARTITION BY _g ORDER BY _t, _kind ROWS BETWEEN UNBOUNDED PRECEDING AND"
    swept = stream.selectExpr("*", f"last(IF(_kind = 0, _v, NULL), true) {over} CURRENT ROW) AS _in",
                              f"last(IF(_kind = 0, _v, NULL), true) {over} 1 PRECEDING) AS _before")
    ends = stream.groupBy("_g").agg(F.expr("max_by(_v, IF(_kind = 0, _t, NULL)) AS _last"))
    carried = ends.selectExpr("_g", "last(_last, true) OVER (PARTITION BY _g.k ORDER BY _g.b "
                                    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _carry")
    joined = swept.join(carried, "_g", "left")
    clash = f"coalesce(coalesce(_before, _carry).`{to}` >= _t, false)"
    error = "raise_error(concat('overlapping versions of key ', coalesce(CAST(_g.k AS STRING), 'NULL'), ' at ', _t))"
    found = "coalesce(_in, _carry)"
    joined = joined.where(f"IF(_kind = 1, true, IF({clash}, CAST({error} AS BOOLEAN), false))")
    return joined.selectExpr(
        *[f"_f.`{c}` AS `{c}`" for c in facts.columns],
        *[f"IF(_g.k IS NOT NULL AND _t <= {found}.`{to}`, {found}.`{c}`, NULL) AS `{c}`" for c in given])
