"""Language identification with a byte convolutional network, trained in numpy and applied to whole texts.

The network looks at windows of ``WINDOW`` bytes (A-Z lower-cased): filters of widths 2, 3 and 4 over the bytes,
the largest response of each filter in the window, a rectifier, and a softmax layer. It is fitted on the driver on a
bounded sample of labelled documents (``per_language`` documents, up to 4 windows each); filters see one byte at a time
as a table look-up, so only the position of the largest response needs a gradient.

Prediction covers every byte of every text: windows follow each other, the last one ends at the text's end, and a
document's logits are the mean over its windows. Two neighbouring bytes are looked up at once in tables of pair
responses. Memory per task is bounded by the window batch, not by the text.

Defined results: a null text or one without a letter is ``und`` with score 0, as is everything if there are no labels;
a null doc_id is never learned from and counts as held out; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from . import kernel as K
from .common import batch

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANGUAGE = 600
LANGUAGES = 256
UNKNOWN = "und"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True


def windows_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and document of consecutive windows; the last one of a long text is moved back to its end."""
    n = np.diff(offs)
    count = np.maximum(1, -(-n // WINDOW))
    doc = np.repeat(np.arange(len(n)), count)
    start = offs[doc] + K.ranges(np.zeros(len(n), np.int64), count) * WINDOW
    return np.maximum(np.minimum(start, offs[doc + 1] - WINDOW), offs[doc]), doc


def window_bytes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW)
    inside = at < end[:, None]
    return np.where(inside, LOWER[buf[np.minimum(at, max(len(buf) - 1, 0))]] if len(buf) else 0, 0).astype(np.uint8)


class Network:
    """Weights: filters[width][position][byte][filter], then a softmax layer."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, 0] = 0
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.shift = np.zeros(len(languages), np.float32)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, at = [], []
        for f, w in zip(self.filters, WIDTHS):
            t = WINDOW - w + 1
            r = sum(f[j][x[:, j:j + t]] for j in range(w))
            at.append(r.argmax(axis=1))
            best.append(r.max(axis=1))
        return np.concatenate(best, axis=1), np.concatenate(at, axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, size: int = 64, rate: float = 0.01, seed: int = 5):
        rng = np.random.default_rng(seed)
        weights = [*self.filters, self.bias, self.out, self.shift]
        m, v = ([np.zeros_like(w) for w in weights] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), size):
                b = order[a:a + size]
                xb = x[b]
                best, at = self.pooled(xb)
                z = best + self.bias
                r = np.maximum(z, 0)
                p = r @ self.out + self.shift
                p = np.exp(p - p.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(b)), y[b]] -= 1
                p /= len(b)
                back = (p @ self.out.T) * (z > 0)
                grads = []
                for i, w in enumerate(WIDTHS):
                    cols = slice(i * FILTERS, (i + 1) * FILTERS)
                    g = np.zeros_like(self.filters[i])
                    unit = np.broadcast_to(np.arange(FILTERS), (len(b), FILTERS))
                    for j in range(w):
                        np.add.at(g[j], (np.take_along_axis(xb, at[:, cols] + j, axis=1), unit), back[:, cols])
                    grads.append(g)
                grads += [back.sum(axis=0), r.T @ p, p.sum(axis=0)]
                step += 1
                for w, g, m_, v_ in zip(weights, grads, m, v):
                    m_ += 0.1 * (g - m_)
                    v_ += 0.001 * (g * g - v_)
                    w -= rate * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.999**step)) + 1e-8)
        return self

    def tables(self):
        """Responses to pairs of bytes: one table for the first pair of all widths, one for the second pair of width
        4; and the third byte of width 3."""
        f2, f3, f4 = self.filters
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        return pair(f2[0], f2[1]), pair(f3[0], f3[1]), f3[2], pair(f4[0], f4[1]), pair(f4[2], f4[3])

    def logits(self, x: np.ndarray, tables) -> np.ndarray:
        t2, t3, c3, t4, e4 = tables
        two = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        r3 = t3[two[:, :-1]]
        r3 += c3[x[:, 2:]]
        r4 = t4[two[:, :-2]]
        r4 += e4[two[:, 2:]]
        best = np.concatenate([t2[two].max(axis=1), r3.max(axis=1), r4.max(axis=1)], axis=1)
        return np.maximum(best + self.bias, 0) @ self.out + self.shift


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(True))


def training_windows(docs: DataFrame, per_language: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels: a bounded sample of the labelled documents, drawn by a hash of the id."""
    train = docs.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = train.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r.lang for r in counts)
    if not languages:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    rate = F.lit(0.0)
    for r in counts:
        rate = F.when(F.col("lang") == r.lang, min(1.0, per_language / r.n)).otherwise(rate)
    u = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    some = train.where(u < rate).select("lang", "doc_id", "text").limit(2 * per_language * len(languages))
    schema = pa.schema([("lang", pa.string()), ("doc_id", pa.int64()), ("window", pa.binary())])

    def run(batches):
        for rb in batches:
            buf, offs = K.text_buffer(rb.column(2))
            start, doc = windows_of(buf, offs)
            first = np.searchsorted(doc, np.arange(rb.num_rows))
            n = np.diff(np.append(first, len(doc)))
            pick = np.unique(np.concatenate([first + n * q // 4 for q in range(4)]))
            x = window_bytes(buf, start[pick], offs[doc[pick] + 1])
            rows = pa.array(doc[pick])
            yield batch(schema, rb.column(0).take(rows), rb.column(1).take(rows), [w.tobytes() for w in x])

    rows = sorted(map(tuple, some.mapInArrow(run, "lang string, doc_id long, window binary").collect()))
    x = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW).copy()
    y = np.array([languages.index(r[0]) for r in rows])
    # short texts are as common as long ones: each window also appears cut to a length between 8 and WINDOW
    cut = np.exp(np.random.default_rng(2).uniform(np.log(8), np.log(WINDOW), len(x)))
    short = np.where(np.arange(WINDOW) < cut[:, None], x, 0).astype(np.uint8)
    return languages, np.concatenate([x, short]), np.concatenate([y, y])


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", with_row: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the input ``row`` as a struct if asked for. ``lang_col`` is read for
    training only."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    docs = docs.select(*[row.alias("row")] * with_row, F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"), held_out(id_col).alias("held_out"))
    languages, x, y = training_windows(docs, per_language)
    net = Network(languages).fit(x, y) if len(x) else None
    model = docs.sparkSession.sparkContext.broadcast(net)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), *[("row", to_arrow_type(docs.schema[0].dataType))] * with_row])
    kind = StructType.fromDDL("doc_id long, held_out boolean, lang_pred string, score double")
    if with_row:
        kind = kind.add("row", docs.schema[0].dataType)

    def run(batches):
        net = model.value
        tables = net.tables() if net else None
        for rb in batches:
            column = rb.column(2)
            buf, offs = K.text_buffer(column)
            n = rb.num_rows
            seen = np.concatenate([[0], np.cumsum(LETTERS[buf])])
            letter = seen[offs[1:]] > seen[offs[:-1]]
            for i in np.flatnonzero(~letter):
                letter[i] = any(map(str.isalpha, buf[offs[i]:offs[i + 1]].tobytes().decode()))
            if net is None or not n:
                yield batch(schema, rb.column(0), rb.column(1), [UNKNOWN] * n, np.zeros(n), *rb.columns[3:])
                continue
            start, doc = windows_of(buf, offs)
            total = np.zeros((n, len(net.languages)))
            for a in range(0, len(start), 256):
                d = doc[a:a + 256]
                z = net.logits(window_bytes(buf, start[a:a + 256], offs[d + 1]), tables)
                np.add.at(total, d, z)
            total /= np.bincount(doc, minlength=n)[:, None]
            p = np.exp(total - total.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            pred = np.array(net.languages, dtype=object)[p.argmax(axis=1)]
            yield batch(schema, rb.column(0), rb.column(1), np.where(letter, pred, UNKNOWN),
                        np.where(letter, p.max(axis=1), 0.0), *rb.columns[3:])

    return docs.select("doc_id", "held_out", "text", *["row"] * with_row).mapInArrow(run, kind)
