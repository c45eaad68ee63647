"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits.

Every shingle of a text is hashed once: the upper bits of the hash choose one of k bins, the bin keeps its smallest
value. An empty bin takes the value of another one: each bin has its own fixed random order of all bins and takes from
the first that got a shingle, so donors are spread evenly and two texts with the same shingles take from the same bins.
Of each bin the lowest b bits are kept, packed into k * b / 8 bytes.

Two bins of unrelated texts agree by chance with probability c = 2**-b, so from the share m of equal bins the likeness
(the Jaccard similarity of the shingle sets) is (m - c) / (1 - c), not below 0. Its standard error is about
sqrt(m * (1 - m) / k) / (1 - c) for texts with many shingles, 0.016 to 0.033 for the defaults and 0 for equal sets.

Shingles are five consecutive words (runs without white space, A-Z lower-cased) of the whole text; a text of one to four
words has its whole sequence as its one shingle.

``spliced`` compares each document with an edit of itself and with its successor by id. Texts move once, dealt by ranges
of ids; a task streams its range in order, and only the last document of a range meets the first of the next range
in a second step, by one row per range.

Defined results: a null text is an empty one; a text without words has an empty fingerprint, alike (1) to another such
text and unlike (0) any other; equal texts have equal fingerprints. A null id comes first; rows with equal ids are
ordered by a hash of their text, repeated rows each have a row; other columns are kept by ``fingerprints`` (an existing
column of the new name is replaced) and ignored by ``spliced``; an empty table gives an empty result. Long texts are
hashed in slabs of a megabyte.
"""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .common import batch, text_column, written

BINS, BITS, WORDS = 256, 4, 5
#: Bytes of text that are fingerprinted at a time.
SLAB = 4 << 20
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class Sketch:
    """Fingerprints of ``bins`` bins (a power of two, 8 at least) and ``bits`` bits (1, 2, 4 or 8) per bin."""

    def __init__(self, bins: int = BINS, bits: int = BITS, words: int = WORDS, seed: int = 7):
        if bins < 8 or bins & (bins - 1) or bits not in (1, 2, 4, 8):
            raise ValueError("bins must be a power of two of 8 or more, bits 1, 2, 4 or 8")
        self.bins, self.bits, self.words = bins, bits, words
        rng = np.random.default_rng(seed)
        self.donors = np.argsort(rng.random((bins, bins)), axis=1).astype(np.int32)

    def codes(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Kept bits (texts x bins) and the number of shingles of an Arrow column of texts."""
        buf, offs = K.text_buffer(column)
        codes = np.zeros((len(offs) - 1, self.bins), np.uint8)
        count = np.zeros(len(offs) - 1, np.int64)
        for a, b in K.doc_runs(offs, SLAB):
            part = offs[a:b + 1] - offs[a]
            h, starts, _ = K.words(buf[offs[a]:offs[b]], part)
            sh, first = K.shingles(h, K.doc_word_offsets(starts, part), self.words)
            count[a:b] = np.diff(first)
            codes[a:b] = self._densified(sh, np.repeat(np.arange(b - a), np.diff(first)), b - a)
        return codes, count

    def _densified(self, hashes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        bins = self.bins
        low = np.full(n * bins, EMPTY)
        place = of * bins + (hashes >> np.uint64(65 - bins.bit_length())).astype(np.int64)
        np.minimum.at(low, place, hashes)
        low = low.reshape(n, bins)
        got = low != EMPTY
        out = (K.mix(low.copy().ravel()).reshape(n, bins) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        todo = np.flatnonzero((~got & got.any(axis=1)[:, None]).ravel())
        for turn in range(bins):
            if not len(todo):
                break
            row, place = todo // bins, todo % bins
            donor = self.donors[place, turn]
            found = got[row, donor]
            out[row[found], place[found]] = out[row[found], donor[found]]
            todo = todo[~found]
        return out

    def packed(self, codes: np.ndarray, count: np.ndarray) -> list[bytes]:
        """Fingerprints as bytes, the first bin in the lowest bits; none for a text without shingles."""
        per = 8 // self.bits
        shift = (np.arange(per) * self.bits).astype(np.uint8)
        whole = (codes.reshape(len(codes), -1, per) << shift).sum(axis=2, dtype=np.uint8)
        return [row.tobytes() if n else b"" for row, n in zip(whole, count.tolist())]

    def __call__(self, column) -> list[bytes]:
        return self.packed(*self.codes(column))

    def unpacked(self, fingerprints: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes and whether there are any."""
        some = np.array([bool(f) for f in fingerprints], bool)
        size = self.bins * self.bits // 8
        raw = np.frombuffer(b"".join(f or bytes(size) for f in fingerprints), np.uint8).reshape(-1, size)
        per = 8 // self.bits
        shift = (np.arange(per) * self.bits).astype(np.uint8)
        return ((raw[:, :, None] >> shift) & np.uint8((1 << self.bits) - 1)).reshape(len(raw), -1), some

    def likeness(self, left: list[bytes], right: list[bytes]) -> np.ndarray:
        """Estimated Jaccard similarity of each pair of fingerprints."""
        (a, some_a), (b, some_b) = self.unpacked(left), self.unpacked(right)
        chance = 2.0 ** -self.bits
        near = np.maximum((a == b).mean(axis=1) - chance, 0) / (1 - chance)
        return np.where(some_a & some_b, near, (some_a == some_b).astype(float))


def fingerprints(docs: DataFrame, sketch: Sketch | None = None, text_col: str = "text",
                 name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint (binary) of each text."""
    sketch = sketch or Sketch()
    kept = [c for c in docs.columns if c != name]
    at = kept.index(text_col)
    texts = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(sketch(rb.column(at)), pa.binary())],
                                             names=[*kept, name])

    return texts.mapInArrow(run, texts.withColumn(name, F.lit(b"")).schema)


def likeness(pairs: DataFrame, left: str, right: str, sketch: Sketch | None = None, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns (null is an empty fingerprint)."""
    sketch = sketch or Sketch()
    kept = [c for c in pairs.columns if c != name]
    a, b = kept.index(left), kept.index(right)
    rows = pairs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches):
        for rb in batches:
            near = sketch.likeness(rb.column(a).fill_null(b"").to_pylist(), rb.column(b).fill_null(b"").to_pylist())
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(near, pa.float64())], names=[*kept, name])

    return rows.mapInArrow(run, rows.withColumn(name, F.lit(0.0)).schema)


RESULT = [("doc_id", pa.int64(), "long"), ("n_chars", pa.int64(), "long"), ("edited_sha256", pa.string(), "string"),
          ("fingerprint", pa.binary(), "binary"), ("edited_fingerprint", pa.binary(), "binary"),
          ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double")]
#: Besides results: the first and last document of a range (kind 1 and 2), with the range's name and its order.
STREAM = pa.schema([pa.field(n, t) for n, t, _ in RESULT] + [
    ("kind", pa.int32()), ("part", pa.int64()), ("tie", pa.int64()), ("row", pa.int64()), ("text", pa.string())])
STREAM_SQL = ", ".join(f"{n} {t}" for n, _, t in RESULT) + ", kind int, part long, tie long, row long, text string"
RESULT_SQL = ", ".join(f"{n} {t}" for n, _, t in RESULT)


def _compared(sketch: Sketch, share: int, ids: list, texts: list[str], after: list[str], prints: list[bytes],
              prints_after: list[bytes]) -> list:
    """Result columns of documents whose successors are known."""
    edited = []
    for text, following in zip(texts, after):
        n = len(text) // share
        edited.append(text[:len(text) - n] + following[:n])
    changed = sketch(pa.array(edited, pa.large_string()))
    digests = [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    return [ids, [len(t) for t in texts], digests, prints, changed, sketch.likeness(prints, changed),
            sketch.likeness(prints, prints_after)]


def spliced(docs: DataFrame, share: int = 4, sketch: Sketch | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """For every document, an edit whose last floor(n_chars / share) code points are replaced by as many first ones (or
    all) of the next document by id (after the last: the first): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (binary), near_edited, near_next."""
    sketch = sketch or Sketch()
    docs = text_column(docs, id_col, text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), "text")
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        part, last = secrets.randbits(62), None
        none = [None] * len(RESULT)

        def end(kind, doc):
            doc_id, tie, row, text, mark = doc
            columns = [[doc_id], [len(text)], [None], [mark], [None], [None], [None]]
            return batch(STREAM, *columns, [kind], [part], [tie], [row], [text])

        for rb in batches:
            for at in range(0, rb.num_rows, 256):
                some = rb.slice(at, 256)
                marks = sketch(some.column(3))
                rows = [*zip(*(c.to_pylist() for c in some.columns), marks)]
                if last is None:
                    yield end(1, rows[0])
                else:
                    rows.insert(0, last)
                last = rows[-1]
                if len(rows) > 1:
                    ids, _, _, texts, prints = zip(*rows)
                    columns = _compared(sketch, share, ids[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:])
                    n = len(rows) - 1
                    yield batch(STREAM, *columns, [0] * n, *[pa.nulls(n, f.type) for f in list(STREAM)[-4:]])
        if last is not None:
            yield end(2, last)

    ranges = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stream = written(ranges.mapInArrow(run, STREAM_SQL))
    # one row per range from here on: each range's last document meets the next range's first
    firsts = stream.where("kind = 1").select("part", "doc_id", "tie", "row")
    line = Window.orderBy(*order)
    following = firsts.select("part", F.coalesce(F.lead("part").over(line), F.first("part").over(
        line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("then"))
    heads = stream.where("kind = 1").select(F.col("part").alias("then"), F.col("text").alias("next_text"),
                                            F.col("fingerprint").alias("next_print"))
    tails = stream.where("kind = 2").join(following, "part").join(heads, "then").select(
        "doc_id", "text", "next_text", "fingerprint", "next_print")
    schema = pa.schema([pa.field(n, t) for n, t, _ in RESULT])

    def finish(batches):
        for rb in batches:
            ids, texts, after, prints, prints_after = (c.to_pylist() for c in rb.columns)
            yield batch(schema, *_compared(sketch, share, ids, texts, after, prints, prints_after))

    names = [n for n, _, _ in RESULT]
    return stream.where("kind = 0").select(*names).unionByName(tails.mapInArrow(finish, RESULT_SQL))
