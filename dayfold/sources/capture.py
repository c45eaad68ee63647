"""Incremental capture from operational tables and date-stamped drops."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions import ntz


def capture_increment(df: DataFrame, watermark: dt.date | str, created: str = "create_dt",
                      updated: str = "update_dt") -> DataFrame:
    """Rows created or updated after the watermark day: ``coalesce(updated, created) > watermark``.

    The watermark is a literal (read once from the watermark table), so the predicate reaches the scan.
    Rows stamped later on the watermark day itself are captured again on the next run (at-least-once);
    the history merge is idempotent for them.
    """
    wm = dt.date.fromisoformat(watermark) if isinstance(watermark, str) else watermark
    return df.where(F.coalesce(F.col(updated), F.col(created)) > ntz(wm))


def capture_keys(df: DataFrame, key: str) -> DataFrame:
    """All keys currently present in a source (for delete detection); only the key column is read."""
    return df.select(key).distinct()


def drop_date(file_name: Column | str, pattern: str = r"_(\d{8})\.", fmt: str = "ddMMyyyy") -> Column:
    """The date stamped in a drop's file name, e.g. ``transactions_01032021.txt`` -> 2021-03-01; NULL without one."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.try_to_timestamp(F.regexp_extract(c, pattern, 1), F.lit(fmt)).cast("date")
