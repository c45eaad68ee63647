"""MinHash near-duplicate classes with tensored banding.

Two small collections of t sub-keys are computed per document (``rows`` minhashes each); the t*t table keys are all
pairs of one sub-key from each collection. So t*t tables cost 2*t*rows minhash computations, about the square root of
what independent tables need. Pairs that meet in a table are confirmed on the full shingle sets.

Two documents are linked when 100 * intersection >= percent * union of their shingle sets; classes are the connected
components. Equal sets are one node from the start (grouped with partial aggregation), so a group of exact copies of
any size costs one node. Within a table bucket the members are compared with one member (a star). Where a bucket then
still holds several components, shingles that only one candidate has are counted: they can't be in an intersection,
which bounds what a set may be linked to, without loss. A second star around the set with the smallest such share (the
original of a group of edited copies) follows. Of what is left only the rarest shingles tell sets apart (the prefix: as
many of a set as the threshold lets it lose, and one; shingles that one candidate has left out), so stars follow in
tensored tables over prefixes, where the members of a bucket agree in what a template's letters differ in, as long as
they connect many. What then still lies in different components meets in an exact prefix-filter join: a linked pair
shares a shingle of both prefixes, so sets with a common one are compared, but not those of a shingle's most frequent
component with each other. Every pair of a bucket ends compared, already connected, or excluded by these bounds: no bucket is
capped.

Defined results: a null or blank text has no shingles, is its own class and links with nothing; fewer words than
``k`` make one shingle; repeated rows are documents of their own; a null doc_id takes part and is ignored as a class
id unless the class has no other (then component_id is null and the row is kept); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import kernel as K
from .bitmap import bitmap_of, in_bitmap
from .common import batch, spread, text_column, written, written_observed
from .graph import parents

RUN = 1 << 19
#: Sets per block where the sets of a common rare shingle are compared.
BLOCK = 256
#: Another star follows while the last one left at most this part of the components, and more than BLOCK of them.
MERGING = 0.75
#: Sub-keys per collection of a table over prefixes, one minhash each.
SHARP = 8


def tables_for(percent: int, rows: int, miss: float) -> int:
    """Sub-keys per collection so that a pair at the threshold is missed with probability below ``miss``."""
    t = 2
    while 2 * (1 - (percent / 100) ** rows) ** t > miss:
        t += 1
    return t


def _sets(column, k: int):
    """Per run of documents: rows of the run, distinct shingles and their offsets."""
    buf, offs = K.text_buffer(column)
    for a, b in K.doc_runs(offs, RUN):
        part, o = buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        h, s, _ = K.words(part, o)
        sh, first = K.shingles(h, K.doc_word_offsets(s, o), k)
        yield a, b, *K.segment_distinct(sh, first)


def _set_ids(sh: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit id per non-empty distinct set."""
    with np.errstate(over="ignore"):
        x = np.add.reduceat(K.mix(sh * K.SLOT_CODE[7]), first[:-1]) + np.diff(first).astype(np.uint64) * K.SLOT_CODE[8]
    return K.mix(x).view(np.int64)


def signatures(docs: DataFrame, k: int, t: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_id (null without shingles), sub_keys (2t longs)."""
    rng = np.random.default_rng(97)
    mul = rng.integers(1, 2**63, 2 * t * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(1, 2**63, 2 * t * rows, dtype=np.uint64)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()),
                        ("sub_keys", pa.list_(pa.int64()))])

    def run(batches):
        for rb in batches:
            for a, b, sh, first in _sets(rb.column(1), k):
                n = np.diff(first)
                full = n > 0
                ids = np.zeros(b - a, np.int64)
                keys = np.zeros((b - a, 2 * t), np.uint64)
                if full.any():
                    f = np.concatenate([first[:-1][full], first[-1:]])
                    ids[full] = _set_ids(sh, f)
                    with np.errstate(over="ignore"):
                        for c in range(2 * t):
                            acc = np.zeros(int(full.sum()), np.uint64)
                            for j in range(rows):
                                i = c * rows + j
                                acc += np.minimum.reduceat(sh * mul[i] + add[i], f[:-1]) * K.SLOT_CODE[j]
                            keys[full, c] = K.mix(acc)
                width = np.where(full, 2 * t, 0)
                sub = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32()),
                                               pa.array(keys[full].reshape(-1).view(np.int64)))
                yield batch(schema, rb.column(0).slice(a, b - a), n, pa.array(ids, mask=~full), sub)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_id long, sub_keys array<long>")


def _table_keys(classes: DataFrame, t: int) -> DataFrame:
    """(key, node): all t*t pairs of sub-keys of every class."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def run(batches):
        for rb in batches:
            for a in range(0, rb.num_rows, 4096):
                part = rb.slice(a, 4096)
                node = part.column(0).to_numpy(zero_copy_only=False)
                sub = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                sub = sub.reshape(len(node), 2 * t)
                with np.errstate(over="ignore"):
                    left = sub[:, :t] * K.SLOT_CODE[3] + np.arange(t, dtype=np.uint64) * K.SLOT_CODE[4]
                    right = sub[:, t:] * K.SLOT_CODE[5] + np.arange(t, dtype=np.uint64) * K.SLOT_CODE[6]
                    key = K.mix((left[:, :, None] + right[:, None, :]).reshape(-1))
                yield batch(schema, key.view(np.int64), np.repeat(node, t * t))

    return classes.select("set_id", "sub_keys").mapInArrow(run, "key long, node long")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the classes in ``wanted(node, label)``: the documents are read again, those whose id is
    surely not wanted are left out by a bitmap of bounded size before any word is cut."""
    bits = bitmap_of(wanted.select(F.col("label").alias("h")))
    schema = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        for rb in batches:
            ids = rb.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            rb = rb.filter(pa.array(in_bitmap(bits, ids)))
            for a, b, sh, first in _sets(rb.column(1), k):
                full = np.diff(first) > 0
                if not full.any():
                    continue
                f = np.concatenate([first[:-1][full], first[-1:]])
                arr = pa.ListArray.from_arrays(pa.array(f, pa.int32()), pa.array(sh.view(np.int64)))
                yield batch(schema, _set_ids(sh, f), rb.column(0).slice(a, b - a).filter(pa.array(full)), arr)

    found = docs.mapInArrow(run, "node long, label long, shingles array<long>")
    return (found.join(wanted, ((found.node == wanted.node) & found.label.eqNullSafe(wanted.label)), "left_semi")
            .dropDuplicates(["node"]).select("node", "shingles"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", F.size("a").alias("na"), F.size("b").alias("nb"),
                                                  F.size(F.array_intersect("a", "b")).alias("shared"))
    return both.where(F.expr(f"100L * shared >= {percent}L * (na + nb - shared)")).select("u", "v")


def _mixed(members: DataFrame, sizes: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (key, node, root, n, n_min) of the buckets that still hold more than one component of ``comp(node, root)``,
    with the shingles n of ``sizes(node, n)`` and of their bucket's smallest set."""
    m = members.join(sizes.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node")), "node")
    mixed = (m.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("n_min"))
             .where("lo <> hi").select("key", "n_min"))
    return m.join(mixed, "key")


def _possible(members: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Of mixed buckets the members that may be linked to a set of the bucket's sizes, as far as ``own(node, own)``
    tells, the shingles that no other candidate has: an intersection has at most n - own shingles. One row a member at
    most; both sides are asked for by node, so however large a bucket is, its members are dealt evenly."""
    m = members.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    return m.where(f"100L * (n - own) >= {percent}L * (own + greatest(n_min, n - own))").drop("n_min")


def _star(members: DataFrame, order) -> DataFrame:
    """Pairs (u < v) of a bucket's centre, the member that is first in ``order``, with members of other components."""
    centre = members.groupBy("key").agg(F.min_by(F.struct("node", "root"), order).alias("c"))
    p = members.join(centre, "key").where("root <> c.root")
    return p.select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v")).distinct()


def _prefixes(some: DataFrame, percent: int) -> DataFrame:
    """(node, root, n, s): the shingles s of each set's prefix, its n - ceil(n * percent / 100) + 1 rarest among
    ``some(node, root, shingles)``, that other sets have too. Linked sets share a shingle of both prefixes: the smaller
    intersection they may have is larger than what either set holds outside its prefix."""
    each = some.select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("c"))
    rarest = F.row_number().over(Window.partitionBy("node").orderBy("c", "s"))
    return (each.join(often, "s").withColumn("rank", rarest)
            .where(F.expr(f"rank <= n - ceil(n * {percent} / 100) + 1")).where("c > 1").select("node", "root", "n", "s"))


def _sharp_keys(prefix: DataFrame, turn: int) -> DataFrame:
    """(key, node, root): pairs of one of ``SHARP`` minhashes over the prefix and one of as many others."""
    least = [F.min(F.xxhash64("s", F.lit(1000 * turn + j))).alias(f"m{j}") for j in range(2 * SHARP)]
    left, right = (F.array(*(F.xxhash64(F.col(f"m{j}"), F.lit(j)) for j in half))
                   for half in (range(SHARP), range(SHARP, 2 * SHARP)))
    node = prefix.groupBy("node", "root").agg(*least)
    return (node.select("node", "root", F.explode(left).alias("l"), right.alias("r"))
            .select("node", "root", "l", F.explode("r").alias("r")).select(F.xxhash64("l", "r").alias("key"), "node", "root"))


def _between(prefix: DataFrame, comp: DataFrame) -> DataFrame:
    """``prefix`` with the roots of ``comp``, without shingles whose sets are all in one component by now."""
    p = prefix.drop("root").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = p.groupBy("s").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("s")
    return p.join(mixed, "s").select("node", "root", "n", "s")


def _once(prefix: DataFrame) -> DataFrame:
    """``prefix`` with one of the shingles that the very same sets have: long sets share many, but are to be moved and
    compared once."""
    same = [F.count("*"), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))]
    one = prefix.groupBy("s").agg(F.struct(*same).alias("same")).groupBy("same").agg(F.min("s").alias("s"))
    return prefix.join(one.select("s"), "s")


def _rest(prefix: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of ``prefix``, all linked pairs included: sets that have a shingle of their
    prefixes in common are compared on their full sets, in blocks where it is frequent. Blocks hold sets of a shingle's
    most frequent component, which aren't compared with each other, or the others. A task compares two blocks and
    returns links only."""
    prefix = _once(prefix)
    parts = prefix.groupBy("s", "root").agg(F.count("*").alias("m"))
    group = (parts.groupBy("s").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("most"),
                                    F.sum("m").alias("all")).where("all > most")
             .select("s", "main", F.expr(f"cast(ceil((all - most) / {BLOCK}) as int)").alias("others"),
                     F.expr(f"cast(ceil(most / {BLOCK}) as int)").alias("mains")))
    some = prefix.select("s", "node", "root").join(group, "s").withColumn("own", F.expr(
        "cast(if(root = main, others + pmod(xxhash64(node), mains), pmod(xxhash64(node), others)) as int)"))
    some = some.select(F.col("s").alias("family"), "node", "root", "own", F.explode(F.expr(
        "sequence(0, if(root = main, others, others + mains) - 1)")).alias("other"))
    some = some.select("family", "node", "root", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                       F.col("own").alias("side")).join(sets, "node")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        node, root, side = (rows[c].to_numpy() for c in ("node", "root", "side"))
        a, b = rows["a"][0].as_py(), rows["b"][0].as_py()
        cell = rows["shingles"].combine_chunks()
        n = np.diff(cell.offsets.to_numpy())
        shared = np.zeros((len(node), len(node)), np.float32)
        value, at = cell.values.to_numpy(), np.repeat(np.arange(len(node)), n)
        distinct, column, times = np.unique(value, return_inverse=True, return_counts=True)
        column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]
        for low in range(0, int((times > 1).sum()), 8192):
            here = (column >= low) & (column < low + 8192)
            part = np.zeros((len(node), 8192), np.float32)
            part[at[here], column[here] - low] = 1
            shared += part @ part.T
        shared = shared.astype(np.int64)
        link = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
        link &= (root[:, None] != root[None, :]) & (node[:, None] < node[None, :])
        if a != b:  # pairs inside a block are found by the task that has it twice
            link &= side[:, None] != side[None, :]
        u, v = np.nonzero(link)
        return pa.Table.from_batches([batch(schema, node[u], node[v])])

    return some.groupBy("family", "a", "b").applyInArrow(run, "u long, v long").distinct()


def _own(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, own): of the sets that have such, the number of shingles that no other of ``nodes`` has."""
    some = sets.join(nodes, "node", "left_semi")
    return (some.select("node", F.explode("shingles").alias("s")).groupBy("s")
            .agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
            .groupBy("node").agg(F.count("*").alias("own")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = 3, miss: float = 5e-4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_links (confirmed links of its class to other classes seen on the way)."""
    docs = text_column(docs, id_col, text_col)
    t = tables_for(percent, rows, miss)
    sig = written(signatures(docs, k, t, rows))
    classes = sig.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("label"), F.first("sub_keys").alias("sub_keys"))
    classes = written(classes)
    keys = _table_keys(spread(classes, "set_id"), t)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    cand, seen = written_observed(keys.join(shared, "key"), F.count("*").alias("n"))
    spark: SparkSession = docs.sparkSession
    links = spark.createDataFrame([], "u long, v long")
    comp = spark.createDataFrame([], "node long, root long")

    def joined(new: DataFrame) -> None:
        """Takes links between different components over into ``links`` and ``comp``."""
        nonlocal links, comp
        new, found = written_observed(new, F.count("*").alias("n"))
        if found["n"]:
            comp = parents(new.union(comp))
            links = links.union(new)

    if seen["n"]:
        wanted = cand.select("node").distinct().join(classes, F.col("node") == F.col("set_id")).select("node", "label")
        wanted = written(wanted)
        sets = written(_shingle_sets(docs, wanted, k))
        sizes = written(sets.select("node", F.size("shingles").cast("long").alias("n")))
        joined(_links(_star(cand.withColumn("root", F.col("node")), F.xxhash64("node")), sets, percent))
        for turn in (1, 2):  # the bounds get closer when fewer candidates are left
            cand = written(_mixed(cand.select("key", "node"), sizes, comp))
            cand = _possible(cand, _own(cand.select("node").distinct(), sets), percent)
            if turn == 1:
                cand = written(cand)
                joined(_links(_star(cand, F.struct(F.col("own") / F.col("n"), F.xxhash64("node"))), sets, percent))
        left, before = written(cand.select("node", "root").distinct()), None
        while True:
            prefix, seen = written_observed(_between(_prefixes(left.join(sets, "node"), percent), comp),
                                            F.approx_count_distinct("root").alias("roots"))
            roots = seen["roots"]
            if not roots:
                break
            if roots <= BLOCK or before and roots > MERGING * before:
                joined(_rest(prefix, sets, percent))
                break
            turn += 1
            joined(_links(_star(_sharp_keys(prefix, turn), F.xxhash64("node", F.lit(turn))), sets, percent))
            left, before = prefix.select("node", "root").distinct(), roots
    degree = links.union(links.select("v", "u")).groupBy(F.col("u").alias("node")).agg(F.count("*").alias("n_links"))
    member = classes.select("set_id", "label").join(comp, classes.set_id == comp.node, "left").select(
        "set_id", "label", F.coalesce("root", "set_id").alias("root"))
    least = member.groupBy("root").agg(F.min("label").alias("component_id"))
    member = member.join(least, "root").join(degree, member.set_id == degree.node, "left").select(
        "set_id", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = sig.join(member, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.col("doc_id").isNull() & component.isNull()).alias("kept"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
