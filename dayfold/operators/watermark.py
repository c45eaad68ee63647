"""Watermarks: the processing date and per-source high-water marks (one row per source table)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions import as_date

SCHEMA_NAME = "dwh"

# Fixed seeds of the watermark table: sources start before any data, facts the day before the first drop.
SOURCE_SEED = dt.date(1800, 1, 1)
FACT_SEED = dt.date(2021, 2, 28)


def row(table_name: str, max_date: Column) -> list[Column]:
    return [F.lit(SCHEMA_NAME).alias("schema_name"), F.lit(table_name).alias("table_name"),
            max_date.cast("date").alias("max_date")]


def processing_date(fact_watermark: DataFrame) -> DataFrame:
    """The day to load next: the fact watermark plus one day."""
    return fact_watermark.select(F.date_add(F.col("max_date"), 1).alias("processing_date"))


def advance_source(staged: DataFrame, table_name: str, previous, created: str = "create_dt",
                   updated: str = "update_dt") -> DataFrame:
    """``coalesce(max(updated), max(created), previous)`` as a date (a global aggregate: one row)."""
    prev = F.lit(as_date(previous))
    return staged.agg(*row(table_name, F.coalesce(F.max(updated), F.max(created), prev)))


def advance_entries(staged: DataFrame, table_name: str, previous, at: str = "entry_dt") -> DataFrame:
    """``coalesce(max(at), previous)`` for dated entries (the blacklist)."""
    return staged.agg(*row(table_name, F.coalesce(F.max(at), F.lit(as_date(previous)))))


def advance_facts(facts: DataFrame, table_name: str, run_date, at: str = "trans_date") -> DataFrame:
    """``greatest(cast(max(at) as date), run_date)``: an empty day still moves the watermark to the run
    date, so the next run does not retry a day whose files were already archived."""
    return facts.agg(*row(table_name, F.greatest(F.to_date(F.max(at)), F.lit(as_date(run_date)))))
