"""Vector code compression: product codes with exact nearest entries by slice-and-intersect bitmasks.

A vector's components become integers, the vector is cut into equal parts, and each part is replaced by the number of
the nearest entry of that part position's codebook. The codebooks are learnt by a fixed number of rounds (assign all,
replace each entry by the floored mean of its parts), so the result does not depend on how rows are dealt to tasks.

Nearest entries are found without comparing with the whole codebook. Per dimension the entries' coordinates are sorted,
and position p of that order carries the mask of the p entries before it. For a part and a radius, two binary searches
per dimension give a slice, its mask is the difference of two prefix masks, and the ANDed uint64 masks of all dimensions
are exactly the entries in the box of that radius around the part. Only these are measured. If the best of them is
within the radius nothing outside the box can be nearer; otherwise the search goes on with the distance just found (or
twice the radius, if the box was empty) and measures what the larger box adds. The initial radius of a round comes from
the mean error of the round before. On clustered vectors a few entries in a hundred are measured; where components are
independent and all alike (as in the given table) a box as wide as the nearest distance still holds most of them.

Everything that reaches the driver or is broadcast is bounded by parts x entries x dimensions; a round is one pass over
the vectors with partial sums per task. Labels that hold a thousandth of all rows or more (at most 1000) get their sums
by a broadcast, the others by a join, so a label with a third of all rows is in no single task.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part and have no row;
integer components beyond +-2**27 raise an error (their squared distances would leave 64 bits). The codebooks are made
for the most frequent length that the number of parts divides (ties: the longest); rows of other lengths are kept with
a null code and error. A null id sorts last; rows with equal ids are ordered by their components; repeated rows each
have a row. With fewer rows than entries the codebook is as long as the table. Other columns are ignored; an empty table
gives an empty result. Parts that are equally near to two entries take the lower index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, written

#: Rows measured at a time: bounds the candidate pairs in memory.
ROWS = 1024
#: The initial radius, of the expected distance: a small box gives a good bound, and what it held isn't measured again.
START = 0.6
#: Largest integer component.
LIMIT = 1 << 27
FAR = np.int64(1 << 62)


def integers(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v array<int>) of the usable rows, components floor(scale * x)."""
    def run(batches):
        for rb in batches:
            vectors = rb.column(2)
            flat = vectors.flatten()
            x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            n = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(len(n)), n)
            keep = n > 0
            keep[of[~np.isfinite(x)]] = False
            x = np.floor(scale * x[keep[of]])
            if len(x) and np.abs(x).max() > LIMIT:
                raise ValueError(f"a vector component is beyond +-{LIMIT} after scaling by {scale}")
            offsets = np.concatenate([[0], np.cumsum(n[keep])]).astype(np.int32)
            rb = rb.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32)))],
                names=["vec_id", "label", "v"])

    label = vectors.schema[label_col].dataType.simpleString()
    cols = [F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("v")]
    return vectors.select(*cols).mapInArrow(run, f"vec_id long, label {label}, v array<int>")


class Slices:
    """Prefix entry masks over the sorted coordinates of one codebook (entries x dimensions, int64)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        own = np.zeros((n, -(-n // 64)), np.uint64)
        own[np.arange(n), np.arange(n) >> 6] = np.uint64(1) << (np.arange(n) & 63).astype(np.uint64)
        self.prefix = np.zeros((dims, n + 1, own.shape[1]), np.uint64)
        for j in range(dims):
            np.bitwise_or.accumulate(own[order[:, j]], axis=0, out=self.prefix[j, 1:])

    def inside(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (rows x words) of the entries within ``radius`` of x in every dimension."""
        mask = None
        for j, (line, prefix) in enumerate(zip(self.sorted, self.prefix)):
            some = prefix[np.searchsorted(line, x[:, j] + radius, "right")]
            some &= ~prefix[np.searchsorted(line, x[:, j] - radius, "left")]
            mask = some if mask is None else mask & some
        return mask

    def nearest(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of the nearest entry of each row, and the number of distances computed."""
        best, at = np.full(len(x), FAR), np.zeros(len(x), np.int64)
        r, todo, measured = np.full(len(x), max(1, radius), np.int64), np.arange(len(x)), 0
        seen = np.zeros((len(x), self.prefix.shape[2]), np.uint64)
        while len(todo):
            box = self.inside(x[todo], r[todo])
            mask = box & ~seen[todo]
            seen[todo] = box
            rows, entries = np.nonzero(np.unpackbits(mask.astype("<u8").view(np.uint8), axis=1, bitorder="little"))
            measured += len(rows)
            if len(rows):
                d, of = np.zeros(len(rows), np.int64), todo[rows]
                for j in range(x.shape[1]):
                    step = x[of, j] - self.entries[entries, j]
                    d += step * step
                first = np.flatnonzero(np.diff(rows, prepend=-1))
                low = np.minimum.reduceat(d, first)
                hits = np.flatnonzero(d == np.repeat(low, np.diff(first, append=len(rows))))
                hits = hits[np.flatnonzero(np.diff(rows[hits], prepend=-1))]  # of equally near ones the lowest index
                found, which = todo[rows[first]], entries[hits]
                nearer = (low < best[found]) | ((low == best[found]) & (which < at[found]))
                best[found[nearer]], at[found[nearer]] = low[nearer], which[nearer]
            mine, reach = best[todo], r[todo]
            settled = mine < (reach + 1) ** 2  # an entry outside the box differs by reach + 1 or more somewhere
            root = np.sqrt(mine.astype(np.float64)).astype(np.int64) + 1
            root -= root * root > mine
            r[todo] = np.where(mine < FAR, root, np.minimum(2 * reach, 4 * LIMIT))
            todo = todo[~settled]
        return at, best, measured


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part position (parts x entries x dimensions of a part) and the distance to expect there."""

    entries: np.ndarray
    radius: tuple[int, ...]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Indexes (rows x parts), squared distances (rows x parts), and the number of distances computed."""
        if not hasattr(self, "_slices"):
            object.__setattr__(self, "_slices", [Slices(e) for e in self.entries])
        parts = x.reshape(len(x), len(self.entries), -1)
        at, d = np.zeros(parts.shape[:2], np.int64), np.zeros(parts.shape[:2], np.int64)
        measured = 0
        for a in range(0, len(x), ROWS):
            for p, (slices, radius) in enumerate(zip(self._slices, self.radius)):
                at[a:a + ROWS, p], d[a:a + ROWS, p], n = slices.nearest(parts[a:a + ROWS, p],
                                                                               int(START * radius))
                measured += n
        return at, d, measured

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def __getstate__(self):
        return {"entries": self.entries, "radius": self.radius}


def _matrix(column, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of this length, and which they are."""
    n = np.diff(column.offsets.to_numpy())
    fits = n == dims
    x = column.flatten().to_numpy(zero_copy_only=False)
    return x[np.repeat(fits, n)].astype(np.int64).reshape(-1, dims), fits


def learn(vectors: DataFrame, parts: int, entries: int, rounds: int) -> tuple[Codebooks | None, int]:
    """Codebooks of ``vectors`` (from ``integers``, written), and the length they are for."""
    length = F.size("v")
    most = vectors.groupBy(length.alias("n")).count().where(F.col("n") % parts == 0).orderBy(
        F.desc("count"), F.desc("n")).limit(1).collect()
    if not most:
        return None, 0
    dims = most[0].n
    rows = vectors.where(length == dims)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    first = np.array([r.v for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    apart = [np.sort(((e[:, None] - e[None]) ** 2).sum(axis=2), axis=1)[:, min(1, len(e) - 1)] for e in first]
    books = Codebooks(first, tuple(int(np.sqrt(np.median(d))) for d in apart))
    width = dims // parts
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("error", pa.float64()),
                        ("sums", pa.list_(pa.int64()))])

    for _ in range(rounds):
        shared = vectors.sparkSession.sparkContext.broadcast(books)

        def run(batches):
            books = shared.value
            shape = books.entries.shape
            n, sums, error = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64), np.zeros(shape[:2])
            for rb in batches:
                x, _ = _matrix(rb.column(0), shape[0] * shape[2])
                at, d, _ = books.encode(x)
                cut = x.reshape(len(x), shape[0], -1)
                for p in range(shape[0]):
                    n[p] += np.bincount(at[:, p], minlength=shape[1])
                    error[p] += np.bincount(at[:, p], d[:, p], minlength=shape[1])
                    np.add.at(sums[p], at[:, p], cut[:, p])
            p, e = np.nonzero(n)
            yield batch(schema, p.astype(np.int32), e.astype(np.int32), n[p, e], error[p, e], list(sums[p, e]))

        kind = "part int, entry int, n long, error double, sums array<long>"
        total = rows.select("v").mapInArrow(run, kind).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.sum("error").alias("error"),
            F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect()
        new, error, count = books.entries.copy(), np.zeros(parts), np.zeros(parts)
        for r in total:  # at most parts x entries rows
            new[r.part, r.entry] = [s // r.n for s in r.sums]
            error[r.part] += r.error
            count[r.part] += r.n
        books = Codebooks(new, tuple(int(np.sqrt(e / max(1, c))) for e, c in zip(error, count)))
        shared.unpersist()
    return books, dims


def encode(vectors: DataFrame, scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4,
           id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, codes array<int>, error) per usable row, written to the shared folder, and the codebooks. At most
    256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for a part")
    rows = written(integers(vectors, scale, id_col, vector_col, label_col))
    books, dims = learn(rows, parts, entries, rounds)
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches):
        books = shared.value
        for rb in batches:
            codes = [None] * rb.num_rows
            error = np.zeros(rb.num_rows, np.int64)
            fits = np.zeros(rb.num_rows, bool)
            if books is not None:
                x, fits = _matrix(rb.column(2), dims)
                at, d, _ = books.encode(x)
                error[fits] = d.sum(axis=1)
                for i, row in zip(np.flatnonzero(fits).tolist(), at.astype(np.int32)):
                    codes[i] = row
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(codes, pa.list_(pa.int32())), pa.array(error, mask=~fits)],
                names=["vec_id", "label", "codes", "error"])

    return written(rows.mapInArrow(run, f"vec_id long, label {kind}, codes array<int>, error long")), books


def sum_by_label(rows: DataFrame, value: str, label: str, name: str) -> DataFrame:
    """``rows`` (a written table) with the sum of ``value`` over their label, nulls together."""
    totals = rows.groupBy(F.col(label).alias("_label")).agg(F.sum(value).alias(name), F.count("*").alias("_n"))
    share = rows.count() / 1000
    hot = F.broadcast(totals.where(F.col("_n") >= share))  # at most 1000 labels
    rest = totals.where(F.col("_n") < share)
    same = F.col(label).eqNullSafe(F.col("_label"))
    frequent = rows.join(hot, same)
    others = rows.join(F.broadcast(hot.select("_label")), same, "left_anti").join(rest, same)
    return frequent.unionByName(others).drop("_label", "_n")
