"""Spark helpers of the operators: shared scratch tables, columns by name, Arrow output."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_sent: set[str] = set()

#: Workers serve one stage after another; without these, they keep the largest arrays of each after they are freed.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2",
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so tasks can import it where it isn't installed, bound
    the Arrow batches by bytes: texts are long, and a task holds a batch on both sides; and let Python workers give
    freed memory back."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    sc = spark.sparkContext
    sc.environment.update(WORKER_MEMORY)
    if sc.applicationId not in _sent:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = os.path.join(tempfile.mkdtemp(prefix="dayfold-"), "dayfold")
        sc.addPyFile(shutil.make_archive(name, "zip", root, "dayfold"))
        _sent.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Only a session without that setting (a test, a laptop) gets a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = kept.get() if kept.isDefined() else None
    if not root:
        root = os.path.join(tempfile.gettempdir(), "dayfold-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out rows that are about to grow, over as many tasks as the session shuffles to."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def written(df: DataFrame, path: str | None = None, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write to the shared folder and read back. Ids drawn before it are fixed from here on."""
    path = path or shared_dir(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_buckets(df: DataFrame, key: str, codec: str = "zstd") -> DataFrame:
    """As ``written``, bucketed by a key: what is dealt by that key meets these rows without moving them."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", codec).option("path", path).bucketBy(n, key).format("parquet").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")  # the name only: the table is external, and the frame keeps its files and buckets
    return out


def written_observed(df: DataFrame, *measures: Column) -> tuple[DataFrame, dict]:
    """As ``written``, and the values of aggregates that are observed over all rows on the way."""
    seen = Observation()
    out = written(df.observe(seen, *measures))
    return out, seen.get


def text_column(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the key and the text under fixed names, whatever else the input carries."""
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema)], schema=schema)
