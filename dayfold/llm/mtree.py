"""Exact top-k by inner product with M-trees.

Largest inner product becomes nearest neighbour in a metric space: every vector gets one more component that lifts its
length to the longest in the table, queries get 0 there, so the Euclidean distance falls as the inner product grows.

Vectors are dealt to the nearest of a bounded number of pivots (a sample drawn by hash), and the rows of a frequent
pivot to several trees, so a vector that a third of all rows share is spread. Each tree is a task's M-tree: pages of
entries with a routing vector, a covering radius and each entry's distance to its parent. A best-first search visits
nodes by their smallest possible distance and skips entries by the stored parent distances (triangle inequality)
before computing any distance; the k-th best score so far ends it.

Queries are first searched in the trees nearest to them, which gives each a bound; pivots whose ball can't reach the
bound are then left out without loss, and the queries go to the remaining trees in one shuffle. A task reads a tree's
vectors, then streams its queries, so neither side is held per key. Scores are exact integers; floating point is only
used in bounds, with a margin.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do those of a
length other than the table's most frequent one; a null id takes no part; a repeated id is one query (its smallest
vector) and one candidate (its best score); other columns are ignored; ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, written

PIVOTS = 64
TREE_ROWS = 4096
PAGE = 64
MARGIN = 1e-6


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that gives all of them the same length."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((a - b) ** 2).sum(axis=-1), 0))


class Tree:
    """Two levels of pages over up to some thousand rows: the root's entries are routing vectors with a radius, a
    page's entries are rows with their distance to the routing vector."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, longest: float):
        order = np.lexsort((*rows.T[::-1], ids))
        ids, rows = ids[order], rows[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]).any(axis=1)
        self.ids, self.rows = ids[new], rows[new]
        self.points = lifted(self.rows, longest)
        self.center = self.points.mean(axis=0)
        self.pages = []
        self.split(np.arange(len(self.ids)))
        self.route = np.stack([p[0] for p in self.pages])
        self.radius = np.array([p[1] for p in self.pages])
        self.to_center = distance(self.route, self.center)

    def split(self, which: np.ndarray):
        """Cut in halves along the line of two far entries until a page holds them (generalised hyperplane split)."""
        todo = [which]
        while todo:
            which = todo.pop()
            x = self.points[which]
            middle = x.mean(axis=0)
            d = distance(x, middle)
            if len(which) <= PAGE:
                route = x[int(d.argmin())]
                d = distance(x, route)
                by = np.argsort(d, kind="stable")
                self.pages.append((route, float(d.max()), d[by], which[by]))
                continue
            a = x[int(d.argmax())]
            da = distance(x, a)
            side = da - distance(x, x[int(da.argmax())])
            half = np.argsort(side, kind="stable")
            todo += [which[half[:len(which) // 2]], which[half[len(which) // 2:]]]

    def search(self, query_id: int, query: np.ndarray, k: int, at_least: int | None, longest: float) -> list[tuple[int, int]]:
        """The k best (score, id) of the tree, those below ``at_least`` left out."""
        q = np.append(query.astype(np.float64), 0.0)
        base = float(query @ query) + longest
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        held: dict[int, int] = {}

        def reach() -> float:
            low = best[0][0] if len(best) == k else at_least
            return np.inf if low is None else np.sqrt(max(base - 2.0 * low, 0.0)) * (1 + MARGIN) + MARGIN

        limit = reach()
        to_center = float(distance(q, self.center))
        least = np.maximum(np.abs(to_center - self.to_center) - self.radius, 0)  # from parent distances alone
        near = np.flatnonzero(least <= limit)
        d_route = distance(self.route[near], q)
        queue = [(max(d - self.radius[p], 0.0), int(p), d) for p, d in zip(near, d_route)]
        heapq.heapify(queue)
        while queue:
            low, p, d = heapq.heappop(queue)
            if low > limit:
                break
            _, _, stored, which = self.pages[p]
            a, b = np.searchsorted(stored, [d - limit, d + limit]) if np.isfinite(limit) else (0, len(which))
            which = which[a:min(len(which), b + 1)]
            scores = self.rows[which] @ query
            floor = best[0][0] if len(best) == k else at_least
            if floor is not None:
                some = scores >= floor
                which, scores = which[some], scores[some]
            for i in np.lexsort((self.ids[which], -scores)).tolist():
                c, s = int(self.ids[which[i]]), int(scores[i])
                if len(best) == k and s < best[0][0]:
                    break
                if c == query_id:
                    continue
                if c in held:
                    if s > held[c]:
                        best.remove((held[c], -c))
                        best.append((s, -c))
                        heapq.heapify(best)
                        held[c] = s
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -c))
                    held[c] = s
                elif (s, -c) > best[0]:
                    _, gone = heapq.heapreplace(best, (s, -c))
                    held.pop(-gone)
                    held[c] = s
            limit = reach()
        return [(s, -c) for s, c in best]


def _nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = np.sqrt(np.maximum((points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T, 0))
    return d.argmin(axis=1), d


def top_k(vectors: DataFrame, k: int = 5, scale: int = 256, query: str = "vec_id % 50 = 0", id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each id that satisfies ``query`` (SQL over ``vec_id``) the k other vectors with
    the largest inner products of the components floor(scale * x)."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    v = v.where("vec_id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) "
                "or abs(x) = double('inf'))")
    v = v.select("vec_id", F.expr(f"transform(v, x -> cast(floor({scale} * cast(x as double)) as bigint))").alias("v"))
    out = "query_id long, rank int, vec_id long, score long"
    size = v.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    if size is None:
        return spark.createDataFrame([], out)
    dims = size.n
    v = v.where(F.size("v") == dims)
    longest = float(v.agg(F.max(F.expr("aggregate(v, 0D, (s, x) -> s + cast(x as double) * x)"))).first()[0])
    thin = F.pmod(F.xxhash64("v"), F.lit(max(1, size.c // (64 * PIVOTS)))) == 0  # equal vectors stay or go together
    sample = []
    for some in (v.where(thin), v):
        sample = sample or some.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(PIVOTS).collect()
    pivots = lifted(np.array([r.v for r in sample], np.int64), longest)
    shared = spark.sparkContext.broadcast(pivots)

    dealt = pa.schema([("pivot", pa.int32()), ("away", pa.float64()), ("vec_id", pa.int64()), ("v", pa.list_(pa.int64()))])

    def deal(batches):
        for rb in batches:
            x = lifted(_matrix(rb.column(1), dims), longest)
            near, d = _nearest(x, shared.value)
            yield batch(dealt, near, d[np.arange(len(near)), near], rb.column(0), rb.column(1))

    rows = written(v.mapInArrow(deal, "pivot int, away double, vec_id long, v array<long>"))
    stats = rows.groupBy("pivot").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()  # <= PIVOTS
    trees = {r.pivot: -(-r.n // TREE_ROWS) for r in stats}
    radius = {r.pivot: r.radius for r in stats}
    trees_of = F.element_at(F.create_map(*[F.lit(x) for p, n in sorted(trees.items()) for x in (p, n)]), F.col("pivot"))
    entries = rows.select("pivot", F.pmod(F.xxhash64("vec_id"), trees_of).cast("int").alias("tree"), "vec_id", "v")
    queries = rows.where(query).groupBy("vec_id").agg(F.min(F.struct("v", "pivot")).alias("q")).select(
        "vec_id", "q.v", "q.pivot")

    def search(asked: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): the best of each (pivot, tree) for the queries sent there with their floors."""
        both = entries.select("pivot", "tree", F.lit(0).alias("kind"), "vec_id", "v", F.lit(None).cast("long").alias("low"))
        both = both.unionByName(asked.select("pivot", "tree", F.lit(1).alias("kind"), "vec_id", "v", "low"))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        both = both.repartition(n, "pivot", "tree").sortWithinPartitions("pivot", "tree", "kind")
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

        def run(batches):
            own, held, tree = None, [], None
            for rb in batches:
                key = rb.column(0).to_numpy().astype(np.int64) << 32 | rb.column(1).to_numpy()
                kind, ids, vs = rb.column(2).to_numpy(), rb.column(3).to_numpy(), _matrix(rb.column(4), dims)
                low, found = rb.column(5).to_pylist(), []
                cuts = np.flatnonzero(np.diff(key * 2 + kind, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(key)]):
                    if key[a] != own:
                        own, held, tree = key[a], [], None
                    if kind[a] == 0:
                        held.append((ids[a:b], vs[a:b]))
                        continue
                    if tree is None and held:
                        tree = Tree(*(np.concatenate(x) for x in zip(*held)), longest)
                        held = []
                    for i in range(a, b) if tree else ():
                        found += [(int(ids[i]), c, s) for s, c in tree.search(int(ids[i]), vs[i], k, low[i], longest)]
                if found:
                    yield batch(schema, *zip(*found))

        return both.mapInArrow(run, "query_id long, vec_id long, score long")

    def best(found: DataFrame) -> DataFrame:
        """Each query's k best, as an array of (-score, vec_id)."""
        one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return one.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(
            (-F.col("score")).alias("minus"), "vec_id"))), 1, k).alias("best"))

    in_trees = F.explode(F.sequence(F.lit(0), trees_of - 1))
    home = queries.withColumn("low", F.lit(None).cast("long")).withColumn("tree", in_trees)
    first = written(best(search(home)))
    asked = queries.join(first, queries.vec_id == first.query_id, "left").select(
        "vec_id", "v", "pivot", F.expr(f"case when size(best) = {k} then -best[{k - 1}].minus end").alias("low"))
    sent = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("low", pa.int64()), ("pivot", pa.int32())])

    def others(batches):
        """The pivots other than a query's own whose ball the bound reaches."""
        which = np.array(sorted(trees), np.int64)
        ball = np.array([radius[p] for p in which])
        for rb in batches:
            x = _matrix(rb.column(1), dims)
            q = np.concatenate([x.astype(np.float64), np.zeros((len(x), 1))], axis=1)
            _, d = _nearest(q, shared.value[which])
            low = rb.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
            reach = np.sqrt(np.maximum((x * x).sum(axis=1) + longest - 2 * low, 0)) * (1 + MARGIN) + MARGIN
            go = (d - ball[None, :] <= np.where(np.isnan(low), np.inf, reach)[:, None]) & (
                which[None, :] != rb.column(2).to_numpy()[:, None])
            i, p = np.nonzero(go)
            i = pa.array(i)
            yield batch(sent, rb.column(0).take(i), rb.column(1).take(i), rb.column(3).take(i), which[p])

    more = asked.mapInArrow(others, "vec_id long, v array<long>, low long, pivot int").withColumn("tree", in_trees)
    every = first.select("query_id", F.explode("best").alias("b")).select(
        "query_id", "b.vec_id", (-F.col("b.minus")).alias("score")).union(search(more))
    return best(every).select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.minus")).alias("score"))
