"""A bitmap of hashed values: a filter of fixed size that never loses a value.

Its size is a parameter, not the data's: at most ``2**log2_bits / 8`` bytes reach the driver and each task. False
positives only cost work, the exact join that follows removes them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

LOG2_BITS = 23


def _slot(values: np.ndarray, log2_bits: int) -> np.ndarray:
    return K.mix(values.astype(np.int64).view(np.uint64).copy()) >> np.uint64(64 - log2_bits)


def bitmap_of(values: DataFrame, log2_bits: int = LOG2_BITS):
    """Broadcast bitmap of column ``h`` (long, nulls as 0): every task ORs its own values into one map, a tree of
    bounded width merges the maps' 64 KB pages."""
    import pyarrow as pa

    page = min(1 << 16, (1 << log2_bits) // 8)
    schema = pa.schema([("page", pa.int32()), ("bits", pa.binary())])

    def run(batches):
        bits = None
        for rb in batches:
            bits = np.zeros(1 << log2_bits, bool) if bits is None else bits
            bits[_slot(rb.column(0).fill_null(0).to_numpy(zero_copy_only=False), log2_bits)] = True
        if bits is not None:
            packed = np.packbits(bits, bitorder="little").reshape(-1, page)
            used = np.flatnonzero(packed.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([packed[i].tobytes() for i in used],
                                                                                 pa.binary())], schema=schema)

    def merge(batches):
        have: dict[int, np.ndarray] = {}
        for rb in batches:
            for p, b in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                x = np.frombuffer(b, np.uint8)
                have[p] = have[p] | x if p in have else x.copy()
        if have:
            yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int32()),
                                              pa.array([x.tobytes() for x in have.values()], pa.binary())], schema=schema)

    kind = "page int, bits binary"
    pages = values.select(F.col("h").cast("long")).mapInArrow(run, kind)
    pages = pages.repartition(F.col("page")).mapInArrow(merge, kind)
    whole = np.zeros((1 << log2_bits) // 8, np.uint8)
    for row in pages.collect():  # each page once, so no more than the map; an iterator would take a job per partition
        whole[row.page * page:(row.page + 1) * page] |= np.frombuffer(row.bits, np.uint8)
    return values.sparkSession.sparkContext.broadcast(whole)


def in_bitmap(bits, values: np.ndarray, log2_bits: int = LOG2_BITS) -> np.ndarray:
    slot = _slot(values, log2_bits)
    return (bits.value[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def split_by_id(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose id is surely none of column ``h`` of ``ids``, and the others, a null id among them. So
    a join on few ids moves few texts, whatever the number of documents."""
    bits = bitmap_of(ids)

    @F.pandas_udf("boolean")
    def maybe(x: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits, x.to_numpy()))

    given = F.col(f"`{id_col}`").cast("long")
    hit = given.isNull() | maybe(F.coalesce(given, F.lit(0)))
    return docs.where(~hit), docs.where(hit)
