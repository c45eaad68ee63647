"""Delimited daily drops: ``;``-separated text with a header, decimal comma, columns bound by position.

Every field is read as text under the declared column names (a header that names columns differently
cannot rebind them) and then typed with the declared schema. Amounts are parsed from the decimal-comma
text into the declared ``decimal`` — never through ``double`` and never with Spark's bare ``decimal``
(scale 0). A cell that does not parse becomes NULL instead of failing the load (``try_cast``; ANSI mode
is on by default in Spark 4), and ``bad_cells`` lists it, so a load can set such rows aside and count them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType, StructField, StructType


BAD_CELLS = "bad_cells"


def parse_text_columns(df: DataFrame, schema: StructType, decimal_comma: bool = True,
                       keep: Sequence[str] = (), bad_cells: bool = False) -> DataFrame:
    """Type text columns (named as in ``schema``) into ``schema``'s types; ``keep`` columns pass through.
    ``bad_cells`` adds the ``name=text`` of the cells that are not blank and don't parse."""
    out, bad = [], []
    for f in schema.fields:
        if isinstance(f.dataType, StringType):
            out.append(F.col(f.name))
            continue
        c = F.trim(F.col(f.name))
        if decimal_comma and isinstance(f.dataType, (DecimalType, DoubleType, FloatType)):
            c = F.regexp_replace(F.regexp_replace(c, r"\s", ""), ",", ".")
        typed = c.try_cast(f.dataType)
        out.append(typed.alias(f.name))
        bad.append(F.when(typed.isNull() & (c != ""), F.concat(F.lit(f"{f.name}="), F.col(f.name))))
    if bad_cells:
        cells = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
        out.append(cells.alias(BAD_CELLS))
    return df.select(*out, *keep)


def read_delimited_drop(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ";",
                        header: bool = True, decimal_comma: bool = True, with_file: bool = False,
                        bad_cells: bool = False) -> DataFrame:
    """Read one or many daily text drops (a path, a glob or a list) into ``schema``.

    Files are split and read in parallel; ``with_file`` adds ``source_file`` (from the ``_metadata``
    column) so callers can derive the drop date with ``capture.drop_date``.
    """
    text_schema = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    raw = spark.read.schema(text_schema).option("sep", sep).option("header", header).csv(path)
    keep: list[str] = []
    if with_file:
        raw = raw.withColumn("source_file", F.col("_metadata.file_name"))
        keep = ["source_file"]
    return parse_text_columns(raw, schema, decimal_comma, keep, bad_cells)
