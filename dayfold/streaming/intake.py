"""Daily-drop intake as a Structured Streaming query.

A file stream over the drop folder replaces the job's own file bookkeeping: the checkpoint records
which drops were processed, ``Trigger.AvailableNow`` processes everything waiting and stops (run it from
the scheduler once a day), and ``cleanSource=archive`` moves processed files into the archive folder.
Several drops can arrive in one micro-batch; the history merge is order-sensitive, so ``foreachBatch``
runs the days in ascending drop-date order. A second file of the day loaded last repeats that run with the rows of
both: staged rows carry their file's name, a file that comes again (a replayed batch, a corrected file of that name)
replaces its own rows, and equal rows of one file stay as many as they are. Rows of files without a date in their name, or of days before the last run, are kept in ``_stray_files`` and do
not stop the stream; the latter take a replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from dayfold.plans.daily import DailyInputs, RuleConfig, Warehouse, run_day
from dayfold.schemas import REJECTS, TRANSACTIONS
from dayfold.sinks import read_commits, read_runs
from dayfold.sources import drop_date, parse_text_columns

FILE = "source_file"
STAGED = StructType([*REJECTS.fields, StructField(FILE, StringType(), True)])  # transactions, bad cells, file


def with_new_files(earlier: DataFrame, rows: DataFrame) -> DataFrame:
    """Staged rows of a day after ``rows`` of one or more files came. Rows staged without a file's name (loaded by hand)
    are kept but for those that ``rows`` has too."""
    files = rows.select(FILE).distinct()
    named = earlier.where(F.col(FILE).isNotNull()).join(files, FILE, "left_anti").select(*rows.columns)
    none = F.lit(None).cast("string")
    unnamed = earlier.where(F.col(FILE).isNull()).select(*rows.columns).exceptAll(rows.withColumn(FILE, none))
    return named.unionByName(unnamed).unionByName(rows)


def start_intake(spark: SparkSession, drop_dir: str, wh: Warehouse, inputs: DailyInputs, checkpoint: str,
                 archive_dir: str | None = None, pattern: str = "transactions_*.txt",
                 config: RuleConfig = RuleConfig()) -> StreamingQuery:
    text = StructType([StructField(f.name, StringType(), True) for f in TRANSACTIONS.fields])
    reader = (spark.readStream.schema(text).option("sep", ";").option("header", True)
              .option("pathGlobFilter", pattern))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.csv(drop_dir).withColumn(FILE, F.col("_metadata.file_name")).withColumn("drop_date", drop_date(F.col(FILE)))

    def process(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            # the distinct drop dates of the batch: a handful of values
            days = sorted(r[0] for r in batch.select("drop_date").distinct().collect() if r[0] is not None)
            stray = F.col("drop_date").isNull()
            for day in days:
                commits = read_commits(spark, wh.base)
                last = commits.last()
                if last is not None and day < last:
                    stray = stray | (F.col("drop_date") == F.lit(day))
                    continue
                rows = parse_text_columns(batch.where(F.col("drop_date") == F.lit(day)), TRANSACTIONS, keep=[FILE],
                                          bad_cells=True).select(*STAGED.names)
                if day == last:  # another file of the day loaded last: its run is repeated with both
                    earlier = read_runs(spark, wh.base, "_staging/transactions", STAGED, commits.attempts, [day])
                    rows = with_new_files(earlier, rows)
                run_day(spark, wh, inputs.with_transactions(rows), day, config)
            stray = batch.where(stray)
            if stray.head(1):
                stray.write.mode("overwrite").parquet(f"{wh.base}/_stray_files/batch={epoch}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
