"""Run-keyed tables on plain Parquet (no MERGE/UPDATE needed) and their pure DataFrame forms.

Layout under a warehouse root (shared storage, e.g. the cluster's object store):

* ``<table>/run=D/attempt=A/``   everything an attempt at run D wrote to a table, late rows of other days included
* ``_commits/run=D/attempt=A/``  written **last**: watermark rows, and one row per table with the bounds of a date
  column, by which readers choose run directories without listing or opening the others

An attempt never touches what another one wrote. Readers only see directories named by the commits, of each run the
latest attempt: a failed run or re-run leaves nothing visible, and a re-run replaces the whole run, also when its
result has fewer partitions or none. Histories keep ``state=open|closed`` below the attempt: ``closed`` holds the
versions the run closed, ``open`` the complete current set.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from dayfold.functions import as_date, inf

COMMITS = StructType([StructField("run", DateType()), StructField("attempt", StringType()),
                      StructField("kind", StringType()), StructField("name", StringType()),
                      StructField("low", DateType()), StructField("high", DateType()), StructField("rows", LongType())])


# --- pure forms ---------------------------------------------------------------------------------------

def replace_run(facts: DataFrame, drop: DataFrame, run_date, day_col: str = "trans_day", at: str = "trans_date",
                run_col: str = "run") -> DataFrame:
    """The fact table after loading ``drop`` as run ``run_date``: rows of an earlier attempt at that run go, whatever
    day they carry; rows of other runs stay, also those of the days in ``drop``; rows without a time are rejects."""
    d = F.lit(as_date(run_date))
    new = drop.where(F.col(at).isNotNull()).withColumn(day_col, F.to_date(at)).withColumn(run_col, d)
    return facts.where(F.col(run_col) != d).unionByName(new)


def new_entries(staged: DataFrame, watermark, at: str = "entry_dt") -> DataFrame:
    """Entries newer than the watermark (a literal, so it reaches the scan)."""
    return staged.where(F.col(at) > F.lit(as_date(watermark))).select("passport_num", at)


# --- runs ---------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Committed:
    """The committed runs: attempt, watermarks, per table (low, high, rows), and the drop files read (time written)."""

    attempts: dict[dt.date, str] = field(default_factory=dict)
    marks: dict[dt.date, dict[str, dt.date]] = field(default_factory=dict)
    tables: dict[tuple[dt.date, str], tuple[dt.date | None, dt.date | None, int]] = field(default_factory=dict)
    files: dict[dt.date, dict[str, int]] = field(default_factory=dict)

    def last(self, before=None) -> dt.date | None:
        return max((d for d in self.attempts if before is None or d < as_date(before)), default=None)

    def runs(self, table: str, low: dt.date | None = None, high: dt.date | None = None,
             up_to: dt.date | None = None) -> list[dt.date]:
        """Runs up to ``up_to`` that wrote rows of ``table`` with dates in ``[low, high]``."""
        out = []
        for (run, name), (a, b, rows) in sorted(self.tables.items(), key=lambda x: x[0]):
            if name != table or not rows or (up_to is not None and run > up_to):
                continue
            if (low is None or b is None or b >= low) and (high is None or a is None or a <= high):
                out.append(run)
        return out


def read_commits(spark: SparkSession, root: str) -> Committed:
    """A few rows per run: the only thing a run brings to the driver. A warehouse without commits is an empty one; any
    other error in reading them is raised, lest an existing warehouse be taken for empty."""
    try:
        rows = spark.read.schema(COMMITS).parquet(f"{root}/_commits").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Committed()
    attempts: dict[dt.date, str] = {}
    for r in rows:
        attempts[r.run] = max(attempts.get(r.run, ""), r.attempt)
    out = Committed(attempts)
    for r in rows:
        if r.attempt == attempts[r.run]:
            if r.kind == "watermark":
                out.marks.setdefault(r.run, {})[r.name] = r.high
            elif r.kind == "file":
                out.files.setdefault(r.run, {})[r.name] = r.rows
            else:
                out.tables[r.run, r.name] = (r.low, r.high, r.rows)
    return out


def run_path(root: str, table: str, run: dt.date, attempt: str) -> str:
    return f"{root}/{table}/run={run}/attempt={attempt}"


def read_runs(spark: SparkSession, root: str, table: str, schema: StructType, attempts: dict[dt.date, str],
              runs: list[dt.date]) -> DataFrame:
    """The rows that these runs wrote, read from their directories only."""
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(run_path(root, table, d, attempts[d]) for d in runs))


class Attempt:
    """One attempt at a run: writes into directories of its own, visible once ``commit`` is through."""

    def __init__(self, spark: SparkSession, root: str, run_date):
        self.spark, self.root, self.run = spark, root, as_date(run_date)
        self.attempt = f"{time.time_ns():020d}"
        self.written: dict[str, tuple[dt.date | None, dt.date | None, int]] = {}
        self.files: dict[str, int] = {}  # drop files that the run reads, and when each was last written

    def read(self, table: str, schema: StructType) -> DataFrame:
        return read_runs(self.spark, self.root, table, schema, {self.run: self.attempt}, [self.run])

    def write(self, table: str, df: DataFrame, date_col: str | None = None, partition_by: tuple[str, ...] = (),
              counted: str = "true") -> DataFrame:
        """Write ``df`` and read it back; the commit records the bounds of ``date_col`` over rows with ``counted``, which
        are observed while they are written."""
        at = F.to_date(date_col) if date_col else F.lit(None).cast("date")
        seen, own = Observation(), F.expr(counted)
        watched = df.observe(seen, F.min(F.when(own, at)).alias("low"), F.max(F.when(own, at)).alias("high"),
                             F.count(F.when(own, F.lit(1))).alias("rows"))
        watched.write.partitionBy(*partition_by).parquet(run_path(self.root, table, self.run, self.attempt))
        bounds = seen.get
        self.written[table] = (bounds["low"], bounds["high"], bounds["rows"])
        return self.read(table, StructType([f for f in df.schema.fields if f.name not in partition_by]
                                           + [f for f in df.schema.fields if f.name in partition_by]))

    def write_history(self, table: str, versions: DataFrame) -> DataFrame:
        state = F.when(F.col("effective_to") == inf(), "open").otherwise("closed")
        return self.write(table, versions.withColumn("state", state), "effective_to", ("state",), "state = 'closed'")

    def commit(self, watermarks: list[tuple[str, dt.date]]) -> None:
        rows = [(self.run, self.attempt, "watermark", name, None, value, None) for name, value in watermarks]
        rows += [(self.run, self.attempt, "table", name, *bounds) for name, bounds in self.written.items()]
        rows += [(self.run, self.attempt, "file", name, None, None, at) for name, at in self.files.items()]
        df = self.spark.createDataFrame(rows, COMMITS).coalesce(1)
        df.write.parquet(run_path(self.root, "_commits", self.run, self.attempt))


def history_schema(dim: StructType) -> StructType:
    return StructType([*dim.fields, StructField("state", StringType())])


def read_current(spark: SparkSession, root: str, table: str, dim: StructType, commits: Committed,
                 run: dt.date | None) -> DataFrame:
    """The current versions as of a committed run."""
    runs = [] if run is None or (run, table) not in commits.tables else [run]
    df = read_runs(spark, root, table, history_schema(dim), commits.attempts, runs)
    return df.where(F.col("state") == "open").drop("state")


def read_history(spark: SparkSession, root: str, table: str, dim: StructType, commits: Committed, run: dt.date,
                 since: dt.date | None = None) -> DataFrame:
    """Versions as of a committed run; with ``since``, only those valid on that day or later, read from the runs whose
    closed versions reach that far."""
    closed = read_runs(spark, root, table, history_schema(dim), commits.attempts,
                       commits.runs(table, low=since, up_to=run)).where(F.col("state") == "closed")
    if since is not None:
        closed = closed.where(F.to_date("effective_to") >= F.lit(since))
    return read_current(spark, root, table, dim, commits, run).unionByName(closed.drop("state"))
