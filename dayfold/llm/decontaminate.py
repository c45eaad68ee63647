"""Benchmark decontamination: item-sized windows, SimHash fingerprints, multi-index Hamming search, exact check.

A benchmark item of L words is looked for in every window of L words of every document (in the whole document if that
is shorter). Windows and items are multisets of k-word shingles; a leak is a weighted Jaccard similarity (sum of the
smaller counts over sum of the larger) of at least ``percent`` / 100.

1. Item shingles set bits in a bitmap of fixed size, which every task gets, alone and together with their item's
   number of words. A window can only reach the similarity with an item of its length if enough of its shingles are
   those of such items, so windows below that count are left out without loss; the bitmap's false positives only let
   some windows through.
2. Each remaining window gets a 128-bit SimHash. Equal windows are one content from here on, so a passage that a third
   of all documents share is searched once.
3. The fingerprint is split into 8 blocks of 16 bits. Within a Hamming distance of 31 some block differs in at most 3
   bits, so items list the 697 values around each block, and the equi-join on (words, block, value) meets every item
   within that radius, but only 8 % of the items that have nothing to do with a window. At the threshold the expected
   distance is 19 with a deviation of 4; pairs that meet are kept up to 40, where unrelated ones (64, 6) hardly come.
4. These pairs are confirmed on their shingles, and joined back to the documents.

Words are runs of ASCII letters and digits and all non-ASCII bytes, A-Z lower-cased. Defined results: null and blank
texts and items match nothing; an empty table of either kind gives no rows; very long texts are cut into words whole and
looked at window by window; items of fewer than k words are one shingle; a repeated (doc_id, item_id) is reported
once with its best window, the first among equals; a null id is a value like any other; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .bitmap import bitmap_of, in_bitmap
from .common import batch, text_column, written

BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 16, 3
#: Every pair within this distance meets in a block.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Pairs that meet are compared in full up to this distance.
CONFIRM = 40
RUN = 1 << 19
PRINT, ITEM_PRINT = ("print", "print2"), ("item_print", "item_print2")

PLAIN_TABLE = np.zeros(256, np.uint8)
PLAIN_TABLE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = [*range(48, 58), *range(97, 123), *range(128, 256)]
PLAIN_TABLE[65:91] = np.arange(97, 123)


def fingerprints(h: np.ndarray) -> list[np.ndarray]:
    """SimHash of each row of a matrix of shingle hashes, as two columns of 64 bits. A bit that half of the shingles
    have is that of the least one: with a fixed value unrelated fingerprints would be alike."""
    out = []
    with np.errstate(over="ignore"):
        words = h, K.mix(h * K.SLOT_CODE[10] + K.SLOT_CODE[11])
    for x in words:
        up, least = np.zeros(len(h), np.uint64), x.min(axis=1)
        for bit in np.arange(64, dtype=np.uint64):
            one = np.uint64(1)
            ones = 2 * ((x >> bit) & one).sum(axis=1).astype(np.int64) + ((least >> bit) & one).astype(np.int64)
            up |= (ones > h.shape[1]).astype(np.uint64) << bit
        out.append(up.view(np.int64))
    return out


def codes(sorted_rows: np.ndarray, n_words: int) -> np.ndarray:
    """64-bit hash of each row of sorted shingles and the words it was made for."""
    out = np.full(len(sorted_rows), n_words, np.uint64)
    with np.errstate(over="ignore"):
        for c in range(sorted_rows.shape[1]):
            out = K.mix(out * K.SLOT_CODE[0] + sorted_rows[:, c])
    return out


def need(n_item: int, n_window: int, percent: int) -> int:
    """Least number of shared shingles for the similarity."""
    return -(-percent * (n_item + n_window) // (100 + percent))


def marked(h: np.ndarray, n_words: int) -> np.ndarray:
    """Hashes of shingles together with an item length."""
    with np.errstate(over="ignore"):
        return K.mix(h + np.uint64(n_words) * K.SLOT_CODE[9])


def item_table(items: DataFrame, k: int) -> DataFrame:
    """(item_id, item, n_words, item_print, item_print2, item_shingles, marks); ``item`` is a hash of the words' shingles, ``marks``
    are the values to set in the bitmap."""
    schema = pa.schema([("item_id", pa.int64()), ("item", pa.int64()), ("n_words", pa.int32()),
                        *((c, pa.int64()) for c in ITEM_PRINT),
                        ("item_shingles", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))])

    def run(batches):
        for rb in batches:
            buf, offs = K.text_buffer(rb.column(1))
            h, s, _ = K.words(buf, offs, PLAIN_TABLE)
            first = K.doc_word_offsets(s, offs)
            sh, of = K.shingles(h, first, k)
            rows = [(i, int(codes(np.sort(sh[x:y])[None, :], b - a).view(np.int64)[0]), b - a,
                     *(int(p[0]) for p in fingerprints(sh[x:y][None, :])), sh[x:y].view(np.int64),
                     np.concatenate([sh[x:y], marked(sh[x:y], b - a)]).view(np.int64))
                    for i, a, b, x, y in zip(rb.column(0).to_pylist(), first, first[1:], of, of[1:]) if b > a]
            if rows:
                yield batch(schema, *zip(*rows))

    return items.mapInArrow(run, "item_id long, item long, n_words int, item_print long, item_print2 long, "
                                 "item_shingles array<long>, marks array<long>")


def item_windows(docs: DataFrame, bits, lengths: list[int], k: int, percent: int) -> DataFrame:
    """(doc_id, start, n_words, content, print, print2, shingles) of the windows that may reach the similarity."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int32()), ("content", pa.int64()),
                        *((c, pa.int64()) for c in PRINT), ("shingles", pa.list_(pa.int64()))])
    least = min(need(max(1, n - k + 1), min(1, n), percent) for n in lengths)

    def windows(sh, length):
        """Starts of windows of one document and their shingles as a matrix."""
        n_item = max(1, length - k + 1)
        width = min(n_item, len(sh))
        total = np.concatenate([[0], np.cumsum(in_bitmap(bits, marked(sh, length).view(np.int64)))])
        at = np.flatnonzero(total[width:] - total[:-width] >= need(n_item, width, percent))
        return at, sh[at[:, None] + np.arange(width)]

    def run(batches):
        for rb in batches:
            buf, offs = K.text_buffer(rb.column(1))
            ids = rb.column(0)
            for a, b in K.doc_runs(offs, RUN):
                part, o = buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                h, s, _ = K.words(part, o, PLAIN_TABLE)
                first = K.doc_word_offsets(s, o)
                for kk in sorted({min(k, n) for n in lengths}):
                    sh, of = K.shingles(h, first, kk)
                    hit = in_bitmap(bits, sh.view(np.int64))
                    total = np.concatenate([[0], np.cumsum(hit)])
                    for d in np.flatnonzero(total[of[1:]] - total[of[:-1]] >= max(1, least if kk == k else 1)):
                        mine = sh[of[d]:of[d + 1]]
                        for length in lengths:
                            if min(k, length) != kk:
                                continue
                            starts, m = windows(mine, length)
                            for x in range(0, len(starts), 1024):
                                mm = np.sort(m[x:x + 1024], axis=1)
                                n = len(mm)
                                flat = pa.ListArray.from_arrays(
                                    pa.array(np.arange(n + 1) * mm.shape[1], pa.int32()),
                                    pa.array(mm.reshape(-1).view(np.int64)))
                                doc = pa.array([ids[a + int(d)].as_py()] * n, pa.int64())
                                yield batch(schema, doc, starts[x:x + 1024], np.full(n, length, np.int32),
                                            codes(mm, length).view(np.int64), *fingerprints(mm), flat)

    return docs.mapInArrow(run, "doc_id long, start long, n_words int, content long, print long, print2 long, "
                                "shingles array<long>")


def similarity(pairs: DataFrame, percent: int) -> DataFrame:
    """(content, item, similarity, hamming) of the pairs that are similar enough."""
    schema = pa.schema([("content", pa.int64()), ("item", pa.int64()), ("similarity", pa.float64()),
                        ("hamming", pa.int32())])

    def run(batches):
        for rb in batches:
            out = []
            for content, item, hamming, x, y in zip(*(rb.column(c).to_pylist() for c in range(5))):
                x, nx = np.unique(np.array(x, np.int64), return_counts=True)
                y, ny = np.unique(np.array(y, np.int64), return_counts=True)
                _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                both = int(np.minimum(nx[i], ny[j]).sum())
                every = int(nx.sum() + ny.sum()) - both
                if 100 * both >= percent * every:
                    out.append((content, item, both / every, hamming))
            if out:
                yield batch(schema, *zip(*out))

    return pairs.select("content", "item", "hamming", "shingles", "item_shingles").mapInArrow(
        run, "content long, item long, similarity double, hamming int")


def near_masks() -> list[int]:
    """Differences of two values of a block within its radius."""
    return [sum(1 << b for b in bits) for r in range(BLOCK_RADIUS + 1) for bits in combinations(range(BLOCK_BITS), r)]


def _blocks(df: DataFrame, prints: tuple[str, str]) -> DataFrame:
    """Rows of ``df`` once per block, with the block's number and value."""
    value = f"explode(transform(sequence(0, {BLOCKS - 1}), b -> struct(b as block, cast(shiftright(if(b < {BLOCKS // 2}, " \
            f"{prints[0]}, {prints[1]}), {BLOCK_BITS} * (b % {BLOCKS // 2})) & {(1 << BLOCK_BITS) - 1} as int) as value)))"
    return df.withColumn("b", F.expr(value)).select(*df.columns, "b.block", "b.value")


def meetings(contents: DataFrame, items: DataFrame) -> DataFrame:
    """(content, item, hamming) of the pairs of one number of words that meet in a block, once per block. An item lists
    5,576 rows, which Spark's estimate of the items' size doesn't see: neither side may be broadcast on it."""
    masks = ",".join(map(str, near_masks()))
    listed = _blocks(items.select("item", "n_words", *ITEM_PRINT), ITEM_PRINT).withColumn(
        "value", F.expr(f"explode(transform(array({masks}), m -> m ^ value))"))
    met = _blocks(contents.select("content", "n_words", *PRINT), PRINT).join(listed.hint("merge"), ["n_words", "block", "value"])
    return met.select("content", "item", F.expr(
        "cast(bit_count(print ^ item_print) + bit_count(print2 ^ item_print2) as int)").alias("hamming"))


def leaks(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
          text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, similarity, hamming, start_word, n_words."""
    docs = text_column(docs, id_col, text_col)
    spark = docs.sparkSession
    items = items.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"),
                         F.col(f"`{item_text_col}`").cast("string").alias("text"))
    known = written(item_table(items, k))
    lengths = sorted(r.n_words for r in known.select("n_words").distinct().collect())  # at most the longest item's words
    if not lengths:
        return spark.createDataFrame([], "doc_id long, item_id long, similarity double, hamming int, start_word long, "
                                         "n_words int")
    bits = bitmap_of(known.select(F.explode("marks").alias("h")))
    found = written(item_windows(docs, bits, lengths, k, percent))
    contents = found.groupBy("content").agg(F.first("n_words").alias("n_words"), F.first("shingles").alias("shingles"),
                                            *(F.first(c).alias(c) for c in PRINT))
    contents = written(contents)
    distinct = known.groupBy("item").agg(*(F.first(c).alias(c) for c in ("n_words", *ITEM_PRINT, "item_shingles")))
    pairs = meetings(contents, distinct).where(F.col("hamming") <= CONFIRM).distinct()
    pairs = pairs.join(contents.select("content", "shingles"), "content").join(distinct.select("item", "item_shingles"), "item")
    sure = similarity(pairs, percent).join(known.select("item_id", "item").distinct(), "item")
    best = found.select("doc_id", "start", "n_words", "content").join(sure, "content").groupBy("doc_id", "item_id").agg(
        F.min_by(F.struct("similarity", "hamming", "start", "n_words"),
                 F.struct(-F.col("similarity"), "start")).alias("b"))
    return best.select("doc_id", "item_id", "b.similarity", "b.hamming", F.col("b.start").alias("start_word"), "b.n_words")
