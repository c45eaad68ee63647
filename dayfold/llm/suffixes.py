"""Removal of byte strings that also start in an earlier document, by a distributed sparse suffix array.

Every byte that a ``length``-byte string covers is removed if that string also starts in a document with a smaller id.
Indexing every suffix would move each byte ``length`` times. Instead only suffixes at anchors are indexed: the anchor
of a window (a ``length``-byte string) is the leftmost position in it whose 24-byte gram has the smallest hash, so
equal windows have equal anchors at equal offsets, and consecutive windows mostly share theirs (a run).

1. Texts are gathered into chunks, a table bucketed by chunk, so that answers to a chunk are joined without moving
   text. Whole copies of an earlier document are found by digest and need no suffixes.
2. Anchor grams that only one document has are pruned: a chunk sends the 32-bit hashes of its distinct grams to hash
   ranges and gets a bit back for each. A hash collision only keeps a gram that could have gone.
3. The suffixes at surviving anchors go to buckets, ranges of their leading 8 bytes between sampled splitters, with
   the bytes of their run. A bucket sorts them by multikey quicksort (8 bytes at a time, only ties go on), and the
   common prefixes of neighbours, to the right of the anchors and, reversed, to the left, number all windows: two
   windows are equal if their right and left parts are. Each window gets the smallest document id that has it.
   Splitters lie between different leading bytes, so equal windows never are on two sides of a boundary. Leading bytes
   that are so frequent that they would fill several buckets are sent window by window, each to a bucket by its hash.
4. A chunk marks the windows of its documents whose smallest id is below the document's own.

A chunk sends equal runs once with the smallest id, so a passage that a third of all documents share costs one row per
chunk. Nothing but the splitters (a bounded sample) passes through the driver.

Defined results: a null text is empty; a text shorter than ``length`` loses nothing; rows with the same id are one
document to each other; a null id counts as larger than all others; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import kernel as K
from .common import batch, shared_dir, written
from .tokencount import planes, unplanes

GRAM = 24
SLAB = 1 << 19
CHUNK_BYTES = 4 << 20
#: Bytes of text per hash range of step 2 and per bucket of step 3.
RANGE_BYTES = 32 << 20
BUCKET_BYTES = 12 << 20
#: Leading bytes sampled per chunk, and most of them in all (bounds what the driver sorts).
SAMPLE_CHUNK = 64
SAMPLE_ALL = 1 << 20
LAST = np.iinfo(np.int64).max


def words_at(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a big-endian number (zeros behind the end)."""
    return words_view(buf).astype(np.uint64)


def words_view(buf: np.ndarray) -> np.ndarray:
    """As ``words_at``, over a copy of the bytes: words are made where it is indexed."""
    return np.ndarray(len(buf), ">u8", np.concatenate([buf, np.zeros(8, np.uint8)]), strides=(1,))


def runs(buf: np.ndarray, ends: np.ndarray, length: int):
    """Maximal runs of consecutive windows with one anchor: first window, number of windows, anchor, gram hash, and
    document, as arrays. Works in slabs, whatever the documents' sizes."""
    out = []
    width = length - GRAM + 1
    starts = np.concatenate([[0], ends[:-1]])
    m = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
    for a in range(0, len(buf), SLAB):
        b = min(len(buf), a + SLAB)
        part = buf[a:min(len(buf), b + length - 1)]
        if len(part) < length:
            continue
        w = words_at(part)
        with np.errstate(over="ignore"):
            h = w[:-16] * m[0] + w[8:-8] * m[1] + w[16:] * m[2]
            h ^= h >> np.uint64(29)
            h *= m[3]
        h = h[:len(part) - GRAM + 1]
        best = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        s = 1
        while 2 * s <= width:
            best = np.minimum(best[:-s], best[s:])
            s *= 2
        if width > s:
            best = np.minimum(best[:s - width], best[width - s:])
        n = min(b - a, len(best))
        at = (best[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        doc = np.searchsorted(ends, np.arange(a, a + n), "right")
        ok = np.arange(a, a + n) + length <= ends[np.minimum(doc, len(ends) - 1)]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.concatenate([np.cumsum(ok)[first] - 1, [int(ok.sum())]]))
        out.append((first + a, count, at[first] + a, h[at[first]], doc[first]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64), z
    return tuple(np.concatenate(x) for x in zip(*out))


def gram_blocks(h: np.ndarray, doc: np.ndarray, ranges: int):
    """Distinct grams ordered by (range, hash): 32-bit hashes, whether several documents have them, range, and each
    run's place among them."""
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    first = np.flatnonzero(new)
    distinct = h[order][first]
    many = (np.maximum.reduceat(doc[order], first) != np.minimum.reduceat(doc[order], first)) if len(h) else new
    mixed = K.mix(distinct.copy())
    of = ((mixed >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
    low = (mixed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    by = np.lexsort((low, of))
    rank = np.empty_like(by)
    rank[by] = np.arange(len(by))
    place = np.empty(len(h), np.int64)
    place[order] = rank[np.cumsum(new) - 1]
    return low[by], many[by], of[by], place


def multikey(level, n: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of n strings and, between neighbours in it, the first 8-byte level that differs (``levels`` if none).
    ``level(t, which)`` gives the 8-byte words of strings ``which``. Only ties go on to the next level."""
    order = np.argsort(level(0, np.arange(n)), kind="stable")
    split = np.full(n, levels, np.int64)  # level at which a string differs from the one before it
    key = level(0, order)
    split[1:][key[1:] != key[:-1]] = 0
    if n:
        split[0] = 0
    for t in range(1, levels):
        open_ = split == levels
        tied = open_.copy()
        tied[:-1] |= open_[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(~open_[at])
        key = level(t, order[at])
        by = np.lexsort((key, group))
        order[at] = order[at][by]
        key = key[by]
        differs = np.zeros(len(at), bool)
        differs[1:] = (key[1:] != key[:-1]) & (group[1:] == group[:-1])
        split[at[differs]] = t
    return order, split


def common_prefix(level, order: np.ndarray, split: np.ndarray, levels: int) -> np.ndarray:
    """Bytes each string shares with the one before it in the order."""
    lcp = split * 8
    for t in range(levels):
        at = np.flatnonzero(split == t)
        at = at[at > 0]
        if len(at):
            x = level(t, order[at]) ^ level(t, order[at - 1])
            for byte in range(7):
                same = (x >> np.uint64(56 - 8 * byte)) == 0
                lcp[at] += same
    if len(lcp):
        lcp[0] = 0
    return lcp


def smallest_ids(blob: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, ids: np.ndarray, length: int):
    """For runs (their bytes, the anchor's offset in each, the smallest id that has it): the smallest id of each
    window, runs in their order."""
    n = len(sizes)
    first = np.cumsum(sizes) - sizes
    anchor = first + offsets
    right, back = words_view(blob), words_view(blob[::-1])
    end, total = first + sizes, len(blob)

    def cut(words, start, room):  # zero the bytes that belong to another run
        keep = np.clip(room, 0, 8).astype(np.uint64)
        with np.errstate(over="ignore"):
            mask = np.where(keep == 0, np.uint64(0), ~np.uint64(0) << (np.uint64(64) - np.uint64(8) * np.maximum(keep, 1)))
        return words[np.clip(start, 0, max(total - 1, 0))].astype(np.uint64) & mask

    def to_right(t, which):
        return cut(right, anchor[which] + 8 * t, end[which] - anchor[which] - 8 * t)

    def to_left(t, which):
        return cut(back, total - anchor[which] + 8 * t, offsets[which] - 8 * t)

    levels = -(-length // 8)
    part = []
    windows = sizes - length + 1
    run = np.repeat(np.arange(n, dtype=np.int32), windows)
    before = np.repeat(offsets, windows) - K.ranges(np.zeros(n, np.int64), windows)  # bytes left of the anchor
    before = before.astype(np.int32)
    for level, left in ((to_right, False), (to_left, True)):
        depth = before if left else length - before
        order, split = multikey(level, n, levels)
        lcp = common_prefix(level, order, split, levels)
        number = np.zeros(len(run), np.int32)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        for d in np.unique(depth):
            here = depth == d
            number[here] = np.cumsum(lcp < d)[rank[run[here]]]
        part.append(number)
    del right, back, number, depth
    key = part.pop(0).astype(np.int64)
    key *= n + 1
    key += part.pop()
    key *= length + 1
    key += before
    del before
    by = np.argsort(key, kind="stable")
    key = key[by]
    new = np.ones(len(by), bool)
    new[1:] = key[1:] != key[:-1]
    del key
    low = np.minimum.reduceat(ids[run[by]], np.flatnonzero(new)) if len(by) else ids[:0]
    out = np.empty(len(by), np.int64)
    out[by] = low[np.cumsum(new) - 1]
    return out, windows


def chunk_table(docs: DataFrame) -> DataFrame:
    """Bucketed table (chunk, ids, ends, digests, text, rest): documents of about ``CHUNK_BYTES`` a row."""
    rest = docs.schema["rest"].dataType
    schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                        ("digests", pa.list_(pa.binary())), ("text", pa.binary()), ("rest", pa.list_(to_arrow_type(rest)))])

    def run(batches):
        rows, size = [], 0

        def flush():
            ends = np.cumsum([len(t) for _, t, _ in rows])
            return batch(schema, [secrets.randbits(63)], [[LAST if i is None else i for i, _, _ in rows]], [ends.tolist()],
                         [[hashlib.blake2b(t, digest_size=16).digest() for _, t, _ in rows]],
                         [b"".join(t for _, t, _ in rows)], [[r for _, _, r in rows]])

        for rb in batches:
            for doc_id, text, more in zip(rb.column(0).to_pylist(), rb.column(1), rb.column(2).to_pylist()):
                text = text.as_buffer().to_pybytes() if text.is_valid else b""
                if rows and size + len(text) > CHUNK_BYTES:
                    yield flush()
                    rows, size = [], 0
                rows.append((doc_id, text, more))
                size += len(text)
        if rows:
            yield flush()

    spark = docs.sparkSession
    path = shared_dir(spark)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    made = docs.mapInArrow(run, "chunk long, ids array<long>, ends array<long>, digests array<binary>, text binary, "
                                f"rest array<{rest.simpleString()}>")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made.write.option("compression", "zstd").option("path", path).bucketBy(n, "chunk").format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")  # the name only: the table is external, and the frame keeps its files and buckets
    return table


def whole_copies(chunks: DataFrame, length: int) -> DataFrame:
    """(chunk, copies): places of documents whose whole text an earlier document has."""
    d = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "ends", "digests")).alias("place", "d"))
    d = d.select("chunk", "place", "d.ids", "d.digests")
    first = d.groupBy("digests").agg(F.min("ids").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return d.join(first, "digests").where("ids > first").groupBy("chunk").agg(F.collect_list("place").alias("copies"))


def remove_repeats(docs: DataFrame, length: int = 50, with_text: bool = False, id_col: str = "doc_id",
                   text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; ``kept`` (the remaining bytes) and ``rest`` (a struct of the
    columns in ``carry``) if asked for."""
    if not GRAM + 8 <= length <= 250:
        raise ValueError(f"length must be between {GRAM + 8} and 250 bytes")
    rest = (F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry))) if carry
            else F.lit(None).cast("struct<none:int>"))
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       rest.alias("rest"))
    rest_sql, rest_arrow = docs.schema["rest"].dataType.simpleString(), to_arrow_type(docs.schema["rest"].dataType)
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges, buckets = 1 + total // RANGE_BYTES, 1 + total // BUCKET_BYTES
    chunks = chunk_table(docs)
    copies = whole_copies(chunks, length)

    def load(row):
        buf = np.frombuffer(row["text"].as_buffer(), np.uint8)
        ids = row["ids"].values.to_numpy(zero_copy_only=False)
        ends = row["ends"].values.to_numpy(zero_copy_only=False)
        copy = np.zeros(len(ids), bool)
        if row["copies"].is_valid:
            copy[row["copies"].values.to_numpy(zero_copy_only=False)] = True
        return buf, ids, ends, copy

    def chunk_rows(batches):
        for rb in batches:
            for i in range(rb.num_rows):
                yield {name: rb.column(k)[i] for k, name in enumerate(rb.schema.names)}

    def live_runs(buf, ends, copy):
        first, count, anchor, h, doc = runs(buf, ends, length)
        live = ~copy[doc]
        return tuple(x[live] for x in (first, count, anchor, h, doc))

    asks = pa.schema([("place", pa.int32()), ("chunk", pa.int64()), ("block", pa.binary())])

    def ask_grams(batches):
        for row in chunk_rows(batches):
            buf, ids, ends, copy = load(row)
            _, _, anchor, h, doc = live_runs(buf, ends, copy)
            low, many, of, _ = gram_blocks(h, doc, ranges)
            cut = np.flatnonzero(np.diff(of, prepend=-1))
            blocks = [planes(low[a:b]) + np.packbits(many[a:b]).tobytes() for a, b in zip(cut, [*cut[1:], len(of)])]
            some = np.random.default_rng(len(h)).choice(anchor, min(SAMPLE_CHUNK, len(anchor)), replace=False)
            yield batch(asks, [*of[cut], -1], [row["chunk"].as_py()] * (len(cut) + 1),
                        [*blocks, words_at(buf)[some].tobytes() if len(some) else b""])

    def answer_grams(rows: pa.Table) -> pa.Table:
        low, many = [], []
        for b in rows.column(2):
            b = b.as_buffer()
            n = len(b) * 8 // 33  # 4 bytes and a bit each
            while n * 4 + -(-n // 8) < len(b):
                n += 1
            low.append(unplanes(b[:4 * n]))
            many.append(np.unpackbits(np.frombuffer(b[4 * n:], np.uint8), count=n).astype(bool))
        every = np.sort(np.concatenate(low))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        bits = []
        for x, m in zip(low, many):
            at = np.minimum(np.searchsorted(twice, x), max(len(twice) - 1, 0))
            bits.append(np.packbits(m | (twice[at] == x if len(twice) else False)).tobytes())
        return pa.Table.from_batches([batch(asks, *(c.combine_chunks() for c in rows.columns[:2]), bits)])

    kind = "place int, chunk long, block binary"

    def gathered(answers: DataFrame, name: str) -> DataFrame:
        return answers.groupBy("chunk").agg(F.collect_list(F.struct("place", "block")).alias(name))

    def ordered(cell):
        return sorted(cell.as_py() or [], key=lambda x: x["place"])

    with_copies = chunks.drop("digests").join(copies, "chunk", "left")
    asked = with_copies.drop("rest").mapInArrow(ask_grams, kind)
    asked = written(asked)
    sample = asked.where("place < 0").select("block").orderBy(F.xxhash64("chunk")).limit(SAMPLE_ALL // SAMPLE_CHUNK)
    lead = np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r.block, np.uint64) for r in sample.collect())]))
    share = max(1, len(lead) // buckets)
    splitters = np.unique(lead[share::share])
    distinct, times = np.unique(lead, return_counts=True)
    hot = distinct[times >= np.maximum(16, 2 * share)]
    shared = spark.sparkContext.broadcast((splitters, hot))
    grams = gathered(asked.where("place >= 0").groupBy("place").applyInArrow(answer_grams, kind), "grams")

    def surviving(row):
        """Runs at surviving anchors, cut into windows where the leading bytes are hot, and equal ones numbered."""
        buf, ids, ends, copy = load(row)
        first, count, anchor, h, doc = live_runs(buf, ends, copy)
        low, _, of, place = gram_blocks(h, doc, ranges)
        sizes = np.unique(of, return_counts=True)[1] if len(of) else []
        alive = np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(x["block"], np.uint8), count=n).astype(bool)
                                                     for x, n in zip(ordered(row["grams"]), sizes))])
        go = alive[place]
        first, count, anchor, doc = first[go], count[go], anchor[go], doc[go]
        splitters, hot = shared.value
        words = words_at(buf)
        apart = np.isin(words[anchor], hot)
        times = np.where(apart, count, 1)
        each = np.repeat(np.arange(len(first)), times)
        first = first[each] + K.ranges(np.zeros(len(times), np.int64), times) * apart[each]
        count, anchor, doc = np.where(apart, 1, count)[each], anchor[each], doc[each]
        size = count + length - 1
        key = _span_hash(buf, first, size)
        with np.errstate(over="ignore"):
            key = K.mix(key + (anchor - first).astype(np.uint64) * K.SLOT_CODE[1])
        bucket = np.searchsorted(splitters, words[anchor], "right")
        spread = apart[each]
        bucket[spread] = (key[spread] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((key, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        head = order[new]
        least = np.minimum.reduceat(ids[doc[order]], np.flatnonzero(new)) if len(order) else ids[:0]
        return buf, ids, ends, copy, (first, count, doc, number), (first[head], size[head], (anchor - first)[head],
                                                                     bucket[head], least)

    def send_runs(batches):
        for row in chunk_rows(batches):
            buf, _, _, _, _, (start, size, offset, bucket, least) = surviving(row)
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(bucket)]):
                blob = buf[K.ranges(start[a:b], size[a:b])].tobytes()
                ids = least[a:b].astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()
                block = (int(b - a).to_bytes(4, "little") + size[a:b].astype("<u2").tobytes()
                         + offset[a:b].astype("<u2").tobytes() + ids + blob)
                yield batch(asks, [bucket[a]], [row["chunk"].as_py()], [block])

    def sort_bucket(rows: pa.Table) -> pa.Table:
        sizes, offsets, ids, blobs = [], [], [], []
        for b in rows.column(2):
            b = np.frombuffer(b.as_buffer(), np.uint8)
            n = int.from_bytes(b[:4].tobytes(), "little")
            sizes.append(b[4:4 + 2 * n].view("<u2").astype(np.int64))
            offsets.append(b[4 + 2 * n:4 + 4 * n].view("<u2").astype(np.int64))
            ids.append(np.ascontiguousarray(b[4 + 4 * n:4 + 12 * n].reshape(8, -1).T).view(np.int64).reshape(-1))
            blobs.append(b[4 + 12 * n:])
        low, windows = smallest_ids(np.concatenate(blobs), np.concatenate(sizes), np.concatenate(offsets),
                                    np.concatenate(ids), length)
        out, at = [], 0
        per_block = np.add.reduceat(windows, np.cumsum([0, *map(len, sizes)])[:-1])
        for n in per_block:
            part = low[at:at + n]
            at += n
            new = np.flatnonzero(np.diff(part, prepend=part[:1] - 1))
            times = np.diff([*new, len(part)])
            out.append(len(new).to_bytes(4, "little") + planes(times)
                       + part[new].view(np.uint8).reshape(-1, 8).T.tobytes())
        return pa.Table.from_batches([batch(asks, *(c.combine_chunks() for c in rows.columns[:2]), out)])

    known = with_copies.join(grams, "chunk", "left")
    found = gathered(known.drop("rest").mapInArrow(send_runs, kind).groupBy("place").applyInArrow(sort_bucket, kind), "found")
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
              ("kept_sha256", pa.string())] + [("kept", pa.binary())] * with_text + [("rest", rest_arrow)] * bool(carry)
    schema = pa.schema(fields)

    def finish(batches):
        for row in chunk_rows(batches):
            buf, ids, ends, copy, (first, count, doc, number), (_, size, *_) = surviving(row)
            low = [np.zeros(0, np.int64)]
            for x in ordered(row["found"]):
                b = x["block"]
                n = int.from_bytes(b[:4], "little")
                value = np.ascontiguousarray(np.frombuffer(b[4 + 4 * n:], np.uint8).reshape(8, -1).T).view(np.int64)
                low.append(np.repeat(value.reshape(-1), unplanes(b[4:4 + 4 * n])))
            low = np.concatenate(low)
            at = np.cumsum(size - length + 1) - (size - length + 1)
            window = K.ranges(first, count)
            gone = low[K.ranges(at[number], count)] < np.repeat(ids[doc], count)
            edge = np.zeros(len(buf) + 1, np.int32)
            np.add.at(edge, window[gone], 1)
            np.add.at(edge, window[gone] + length, -1)
            cover = np.cumsum(edge[:-1], dtype=np.int32) > 0
            starts = np.concatenate([[0], ends[:-1]])
            for d in np.flatnonzero(copy & (ends - starts >= length)):
                cover[starts[d]:ends[d]] = True
            out, rest = [], row["rest"].as_py() if carry else ids
            for i, a, b, more in zip(ids, starts, ends, rest):
                c = cover[a:b]
                kept = buf[a:b][~c].tobytes()
                spans = int(c[0]) + int(np.count_nonzero(c[1:] & ~c[:-1])) if len(c) else 0
                out.append((None if i == LAST else int(i), b - a, int(c.sum()), spans, hashlib.sha256(kept).hexdigest())
                           + (kept,) * with_text + (more,) * bool(carry))
            for a in range(0, len(out), 2000):
                yield batch(schema, *zip(*out[a:a + 2000]))

    known = known if carry else known.drop("rest")
    done = known.join(found, "chunk", "left").mapInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
        + f", rest {rest_sql}" * bool(carry))
    named = F.struct(*(F.col(f"rest.c{i}").alias(c) for i, c in enumerate(carry)))
    return done.withColumn("rest", named) if carry else done


def _span_hash(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of at most 480 bytes."""
    words = words_at(buf)
    out = size.astype(np.uint64) * K.SLOT_CODE[0]
    with np.errstate(over="ignore"):
        for t in range(-(-int(size.max(initial=0)) // 8)):
            room = np.clip(size - 8 * t, 0, 8)
            w = words[np.minimum(start + 8 * t, len(words) - 1)] >> (np.uint64(8) * (8 - np.maximum(room, 1)).astype(np.uint64))
            out = np.where(room > 0, K.mix(out + w * K.SLOT_CODE[2 + t]), out)
    return out
