"""Delete detection by digests of key buckets: only buckets that differ are compared key by key.

Keys are dealt to buckets by hash. A bucket's digest is the number of its keys and two order-free sums of their hashes
(an exclusive or, and a sum), so it needs no sort, adds up over tasks and over runs, and 95 bits must agree by chance
for a difference to be missed. Buckets form a two-level tree: a parent's digest is the sum of its children's. Comparing
two key sets reads the parents, then the children of parents that differ, then the keys of buckets that differ.

A warehouse keeps the digests of its live keys with each run (``advanced`` carries them on by what a run opened and
closed), so the history is not read to detect deletions, and the source's side is one scan with partial sums in each
task, or a grouped query that the source computes itself. Neither key set is shuffled; what is shuffled are the keys of
differing buckets, about a bucket's share of the keys for each deleted one.

A repeated key or one that the warehouse doesn't know makes its bucket differ, which costs the comparison of that
bucket and changes no result. A NULL key is never among the source's keys, as for a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions import FLAG_DELETED, inf
from dayfold.operators import scd2

#: Parents, and children of each: at most their product is a table of digests.
PARENTS, CHILDREN = 256, 256
SUMS = ("n", "x", "s")


def bucket_of(key: str, parents: int = PARENTS, children: int = CHILDREN) -> Column:
    """The bucket of a key: parent * children + child."""
    return F.expr(f"pmod(xxhash64(`{key}`), {parents * children})")


def _added(df: DataFrame, *by: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("n").alias("n"), F.expr("bit_xor(x)").alias("x"), F.sum("s").alias("s"))


def digests(keys: DataFrame, key: str, parents: int = PARENTS, children: int = CHILDREN) -> DataFrame:
    """(bucket, n, x, s) of a key set, partial sums in each task."""
    some = keys.where(F.col(key).isNotNull()).select(
        bucket_of(key, parents, children).alias("bucket"), F.lit(1).cast("long").alias("n"),
        F.expr(f"xxhash64(`{key}`, 1)").alias("x"), F.expr(f"pmod(xxhash64(`{key}`, 2), {2**31 - 1})").alias("s"))
    return _added(some, F.col("bucket"))


def advanced(known: DataFrame, opened: DataFrame | None = None, closed: DataFrame | None = None) -> DataFrame:
    """Digests after a run that added the keys of the digests ``opened`` and removed those of ``closed``."""
    every = known
    if opened is not None:
        every = every.unionByName(opened)
    if closed is not None:  # an exclusive or undoes itself
        every = every.unionByName(closed.select("bucket", (-F.col("n")).alias("n"), "x", (-F.col("s")).alias("s")))
    return _added(every, F.col("bucket")).where("n <> 0 OR x <> 0 OR s <> 0")


def _unequal(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    same = " AND ".join(f"a.{c} <=> b.{c}" for c in SUMS)
    return a.alias("a").join(b.alias("b"), F.expr(f"a.{on} = b.{on}"), "full").where(f"NOT ({same})").selectExpr(
        f"coalesce(a.{on}, b.{on}) AS {on}")


def differing(known: DataFrame, theirs: DataFrame, children: int = CHILDREN) -> DataFrame:
    """(bucket) whose digests differ: parents first, then the children of unequal parents. At most one row a bucket."""
    parent = F.expr(f"bucket DIV {children}").alias("parent")
    top = _unequal(_added(known, parent), _added(theirs, parent), "parent")
    below = [d.withColumn("parent", parent).join(F.broadcast(top), "parent", "left_semi").drop("parent")
             for d in (known, theirs)]  # at most PARENTS rows are broadcast
    return _unequal(*below, "bucket")


def in_buckets(df: DataFrame, key: str, buckets: DataFrame, parents: int = PARENTS, children: int = CHILDREN) -> DataFrame:
    """The rows of these buckets (at most parents x children of them are broadcast)."""
    return df.join(F.broadcast(buckets), bucket_of(key, parents, children) == buckets["bucket"], "left_semi")


def missing_keys(live: DataFrame, keys: DataFrame, key: str, known: DataFrame | None = None,
                 opened: DataFrame | None = None, parents: int = PARENTS, children: int = CHILDREN) -> DataFrame:
    """Rows of ``live`` (one per live key) whose key the source no longer has.

    ``known``: kept digests of the live keys (default: computed here); ``opened``: keys that this run adds, so that they
    don't make their buckets differ."""
    known = digests(live, key, parents, children) if known is None else known
    if opened is not None:
        known = advanced(known, digests(opened, key, parents, children))
    some = differing(known, digests(keys, key, parents, children), children)
    theirs = in_buckets(keys.select(key).where(F.col(key).isNotNull()), key, some, parents, children)
    here = in_buckets(live.where(F.col(key).isNotNull()), key, some, parents, children)
    return here.join(theirs, key, "left_anti").unionByName(live.where(F.col(key).isNull()))


def deleted_keys(history: DataFrame, keys: DataFrame, key: str, attrs: Sequence[str], run_ts,
                 known: DataFrame | None = None, opened: DataFrame | None = None, parents: int = PARENTS,
                 children: int = CHILDREN) -> DataFrame:
    """``scd2.deleted_keys`` (deleted copies of live versions that the source lacks) through digests."""
    lost = missing_keys(scd2.current(history), keys, key, known, opened, parents, children)
    return lost.select(key, *attrs, scd2._ts(run_ts).alias("effective_from"), inf().alias("effective_to"),
                       F.lit(FLAG_DELETED).alias("deleted_flg"))
