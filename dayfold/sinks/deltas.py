"""Histories as bucketed base segments plus the changes of each run.

The complete-set layout of ``writers`` writes all current versions with every run. Here a run writes what it changed:

* ``<table>_base/run=D/attempt=A/``      current versions of whole buckets, a file per bucket, bucketed and sorted by key
* ``<table>_delta/run=D/attempt=A/``     current versions that the run opened or deleted, with their bucket
* ``<table>_closed/run=D/attempt=A/``    versions that the run closed
* ``<table>_segments/run=D/attempt=A/``  a row per bucket: the base segment and the deltas that make it up
* ``<table>_digest/run=D/attempt=A/``    digests of the live keys' buckets (``operators.keydigest``), a bounded table

A key's current version is its newest row among its bucket's base segment and deltas. A bucket is folded into a new base
segment once it has ``max_deltas`` deltas or its delta rows exceed ``share`` of its base rows, so what a run writes
follows what changed: a row is rewritten about 1 / share times in its life, however long the history grows.

Reading joins base segments to the deltas by key on the buckets they are stored in: only the deltas move. A merge asks
for the staged keys and for those that the digests show as missing, again without moving a base row. Everything is
visible by the commit of its run only, as in ``writers``; nothing is ever changed in place. Keys are never NULL: rows
without a key are left out.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegerType, LongType, StringType, StructField, StructType

from dayfold.functions import FLAG_DELETED, FLAG_LIVE, inf
from dayfold.operators import keydigest, scd2
from dayfold.sinks.writers import Attempt, Committed, read_runs, run_path

BUCKET = "_bucket"
_RUN = StructType([StructField("run", DateType()), StructField("attempt", StringType())])
SEGMENTS = StructType([StructField("bucket", IntegerType()), StructField("base", _RUN), StructField("base_rows", LongType()),
                       StructField("deltas", ArrayType(_RUN)), StructField("delta_rows", LongType())])
DIGESTS = StructType([StructField(n, LongType()) for n in ("bucket", "n", "x", "s")])

#: bucket -> (base (run, attempt) or None, base rows, deltas [(run, attempt)], delta rows)
Layout = dict[int, tuple[tuple[dt.date, str] | None, int, list[tuple[dt.date, str]], int]]


class BucketedHistory:
    """One history table. ``buckets`` is fixed for the table's life: choose it so that a bucket's rows fit a task."""

    def __init__(self, spark: SparkSession, root: str, table: str, key: str, dim: StructType, buckets: int = 64,
                 max_deltas: int = 8, share: float = 0.5, digest: tuple[int, int] = (64, 64)):
        self.spark, self.root, self.table, self.key, self.dim = spark, root, table, key, dim
        self.buckets, self.max_deltas, self.share, self.digest = buckets, max_deltas, share, digest
        self.rows = StructType([*dim.fields, StructField(BUCKET, IntegerType())])
        self.live = F.col("deleted_flg") == FLAG_LIVE

    # --- reading ----------------------------------------------------------------------------------------------------

    def layout(self, commits: Committed, run: dt.date | None) -> Layout:
        """What makes up each bucket as of a committed run: at most ``buckets`` rows."""
        name = f"{self.table}_segments"
        if run is None or (run, name) not in commits.tables:
            return {}
        rows = read_runs(self.spark, self.root, name, SEGMENTS, commits.attempts, [run]).collect()
        return {r.bucket: (tuple(r.base) if r.base else None, r.base_rows, [tuple(d) for d in r.deltas], r.delta_rows)
                for r in rows}

    def _segment(self, segment: tuple[dt.date, str], buckets: list[int]) -> DataFrame:
        """A base segment's rows of these buckets, as a bucketed scan: bucket files that are not asked for are skipped
        by their statistics. The table entry that tells Spark the buckets is dropped as soon as it is resolved."""
        path = run_path(self.root, f"{self.table}_base", *segment)
        name = self._entry(path)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.rows.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY (`{self.key}`) "
                       f"SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        df = self.spark.table(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return df if len(buckets) == self.buckets else df.where(F.col(BUCKET).isin(buckets))

    @staticmethod
    def _entry(path: str) -> str:
        return "dayfold_" + hashlib.md5(path.encode()).hexdigest()

    def _parts(self, layout: Layout, only: set[int] | None = None) -> tuple[list[DataFrame], DataFrame | None]:
        """Base segments, and the newest delta row of each key (None without deltas)."""
        segments, deltas = defaultdict(list), defaultdict(list)
        for bucket, (base, _, runs, _) in layout.items():
            if only is None or bucket in only:
                if base:
                    segments[base].append(bucket)
                for run in runs:
                    deltas[run].append(bucket)
        bases = [self._segment(s, sorted(b)) for s, b in sorted(segments.items())]
        newest = None
        for (run, attempt), some in sorted(deltas.items()):
            df = read_runs(self.spark, self.root, f"{self.table}_delta", self.rows, {run: attempt}, [run]).where(
                F.col(BUCKET).isin(sorted(some))).withColumn("_run", F.lit(run))
            newest = df if newest is None else newest.unionByName(df)
        if newest is not None and len(deltas) > 1:
            row = F.struct(*self.rows.names)
            newest = newest.groupBy(self.key).agg(F.max_by(row, "_run").alias("_row")).select("_row.*")
        return bases, None if newest is None else newest.select(*self.rows.names)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.rows)

    def _newest(self, layout: Layout, only: set[int] | None = None, keys: DataFrame | None = None) -> DataFrame:
        bases, deltas = self._parts(layout, only)
        parts = []
        for base in bases:
            base = base if deltas is None else base.join(deltas.select(self.key), self.key, "left_anti")
            parts.append(base if keys is None else base.join(keys, self.key, "left_semi"))
        if deltas is not None:
            parts.append(deltas if keys is None else deltas.join(keys, self.key, "left_semi"))
        out = self._empty()
        for i, part in enumerate(parts):
            part = part.select(*self.rows.names)
            out = part if i == 0 else out.unionByName(part)
        return out

    def current(self, commits: Committed, run: dt.date | None) -> DataFrame:
        """The current versions, live and deleted, as of a committed run."""
        return self._newest(self.layout(commits, run)).drop(BUCKET)

    def of_keys(self, commits: Committed, run: dt.date | None, keys: DataFrame) -> DataFrame:
        """The current versions of some keys; no base row moves."""
        return self._newest(self.layout(commits, run), keys=keys.select(self.key)).drop(BUCKET)

    def history(self, commits: Committed, run: dt.date, since: dt.date | None = None) -> DataFrame:
        """Versions as of a committed run; with ``since``, only those valid on that day or later."""
        name = f"{self.table}_closed"
        closed = read_runs(self.spark, self.root, name, self.dim, commits.attempts,
                           commits.runs(name, low=since, up_to=run))
        if since is not None:
            closed = closed.where(F.to_date("effective_to") >= F.lit(since))
        return self.current(commits, run).unionByName(closed)

    # --- writing ----------------------------------------------------------------------------------------------------

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(self.key).isNotNull()).select(
            *self.dim.names, F.expr(f"CAST(pmod(hash(`{self.key}`), {self.buckets}) AS INT)").alias(BUCKET))

    def _fold(self, run: Attempt, rows: DataFrame) -> dict[int, int]:
        """Write a base segment (a file per bucket); rows per bucket."""
        path = run_path(self.root, f"{self.table}_base", run.run, run.attempt)
        name = self._entry(path)
        (rows.select(*self.rows.names).repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key)
         .sortBy(self.key).format("parquet").option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        back = self.spark.read.schema(self.rows).parquet(path)
        return {r[BUCKET]: r["count"] for r in back.groupBy(BUCKET).count().collect()}

    def _record(self, run: Attempt, layout: Layout, digests: DataFrame) -> None:
        rows = [(b, base, n, deltas, m) for b, (base, n, deltas, m) in sorted(layout.items())]
        run.write(f"{self.table}_segments", self.spark.createDataFrame(rows, SEGMENTS).coalesce(1))
        run.write(f"{self.table}_digest", digests.select(*DIGESTS.names).coalesce(1))

    def start(self, run: Attempt, history: DataFrame) -> None:
        """Take over a complete history as the first base."""
        is_open = F.col("effective_to") == inf()
        run.write(f"{self.table}_closed", history.where(~is_open).select(*self.dim.names), "effective_to")
        now = self._bucketed(history.where(is_open))
        counts = self._fold(run, now)
        me = (run.run, run.attempt)
        layout = {b: (me, counts.get(b, 0), [], 0) for b in range(self.buckets)}
        self._record(run, layout, keydigest.digests(now.where(self.live), self.key, *self.digest))

    def load(self, run: Attempt, commits: Committed, prev: dt.date | None, changes: DataFrame, keys: DataFrame | None,
             attrs: Sequence[str], created: str | None = "create_dt", updated: str | None = "update_dt",
             reopen: bool = False) -> dict[str, int]:
        """Merge a run's staged changes and key set (``scd2.merge``'s rules) and write what changed. ``changes`` and
        ``keys`` are read several times: pass staged tables. Returns the rows written to each part."""
        key, name = self.key, f"{self.table}_digest"
        layout = self.layout(commits, prev)
        changes = changes.where(F.col(key).isNotNull())
        staged = changes.select(key).distinct()
        mine = self._newest(layout, keys=staged).drop(BUCKET)
        known = self.spark.createDataFrame([], DIGESTS)
        if layout:
            known = read_runs(self.spark, self.root, name, DIGESTS, commits.attempts, [prev])
        if created is None and keys is None:
            keys = changes.select(key)
        alive = None
        if keys is not None:
            opened = staged.join(mine.where(self.live).select(key), key, "left_anti")
            lost = keydigest.missing_keys(self._newest(layout).drop(BUCKET).where(self.live), keys.select(key), key,
                                          known, opened, *self.digest)
            mine = mine.unionByName(lost.select(*mine.columns).join(staged, key, "left_anti"))
            alive = keys.select(key).join(staged, key, "left_semi")
        mine = run.write(f"{self.table}_touched", mine.select(*self.dim.names))
        _, versions = scd2.merge_parts(mine, changes, alive, key, attrs, run.run, created, updated,
                                       reopen and keys is not None)
        work = run.write(f"{self.table}_versions", versions.select(*self.dim.names))
        is_open = F.col("effective_to") == inf()
        before = mine.select(key, "effective_from", "deleted_flg")
        delta = run.write(f"{self.table}_delta", self._bucketed(
            work.where(is_open).join(before, before.columns, "left_anti")))
        run.write(f"{self.table}_closed", work.where(~is_open), "effective_to")

        was_live = mine.where(self.live).select(key)
        came = delta.where(self.live).join(was_live, key, "left_anti")
        went = delta.where(F.col("deleted_flg") == FLAG_DELETED).join(was_live, key, "left_semi")
        digests = keydigest.advanced(known, *(keydigest.digests(x, key, *self.digest) for x in (came, went)))
        me = (run.run, run.attempt)
        added = {r[BUCKET]: r["count"] for r in delta.groupBy(BUCKET).count().collect()}
        layout = {b: layout.get(b, (None, 0, [], 0)) for b in range(self.buckets)}
        for b, n in added.items():
            base, rows, deltas, m = layout[b]
            layout[b] = (base, rows, [*deltas, me], m + n)
        due = {b for b, (_, rows, deltas, m) in layout.items()
               if deltas and (len(deltas) >= self.max_deltas or m > self.share * rows)}
        if due:
            folded = self._fold(run, self._newest(layout, only=due))
            layout |= {b: (me, folded.get(b, 0), [], 0) for b in due}
        self._record(run, layout, digests)
        return {"delta": sum(added.values()), "folded": sum(folded.values()) if due else 0,
                "closed": run.written[f"{self.table}_closed"][2]}


def run_tables(table: str) -> list[str]:
    """The tables a bucketed history writes."""
    return [f"{table}_{x}" for x in ("base", "delta", "closed", "segments", "digest", "touched", "versions")]
