"""Language-model scoring by logistic mixing of hashed-context bit predictors, learned over a whole corpus.

A text is its UTF-8 bytes and one end byte 0xFF, which UTF-8 never uses; a byte is eight binary decisions, so the
probabilities of all texts sum to one. For each decision, predictors of orders 0 to 5 look up how often it went either
way after the last 0 to 5 bytes of context; every context and node that occurs has a counter of its own, so the
counters grow with the corpus. A mixer turns them into one probability: a logistic unit whose weights are gated by the highest order that has been seen and by how often each
context has. The result is refined adaptively: a table over (partial byte, probability) holds what really followed.

Exchange. A task reduces a chunk of texts to its distinct 6-byte grams and how often training documents have them, and
sends them in blocks to places: a hash of the order-2 context is the range, and in a corpus of more than ``MOST_RANGES``
of them each range is dealt by a hash of the order-4 context into parts, whose number grows with the corpus. So a byte
pair that is everywhere is in every part of its range, and no place grows with the corpus. A place streams what it is
sent and writes its distinct grams once; the counters of orders 4 and 5 are sums over them, and so are those of orders 2
and 3 where a range is one place. The parts of a range exchange their sums of these two orders (three- and four-byte
grams), each learning the whole counts of the contexts that it has.

Learning. Every training document counts: the mixer is trained online on every gram of every place, each counted as
often as it occurs and with its own occurrence left out of the counts it is predicted from; places start from the same
weights and are averaged. A further pass gathers the refinement table. What reaches the driver is the counts of byte
pairs, the mixer and the refinement, whose sizes are fixed.

Scoring. A decision depends on the last five bytes only, so a place scores each of its distinct grams once and answers
the blocks it was sent; a chunk, whose texts stay where they were written (a table bucketed by chunk), finds its grams in
the answers and adds them up per document. The unigram baseline needs the corpus count of every word: chunks send their
distinct words in blocks by hash range and get the counts back (see ``tokencount`` for the pattern).

Defined results: a null text is empty and scored as its end alone; a null doc_id is not learned from and counts as
held out; repeated rows count and are scored each; without training documents all bits cost one bit; other columns
are ignored.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import batch, spread, written, written_buckets
from .suffixes import words_at
from .tokencount import planes, unplanes

ORDERS = 6
HASHED = (2, 3, 4, 5)
#: Orders whose contexts lie in several parts of a range.
SHARED = (2, 3)
#: Ranges of order-2 contexts; of a larger corpus, each is dealt in parts.
MOST_RANGES = 16
RANGE_BYTES = 24 << 20
CHUNK_BYTES = 8 << 20
RUN = 1 << 20
WORD_RANGE_BYTES = 32 << 20
#: Grams that a place gathers before it adds them up, and bytes of blocks in an Arrow batch.
GATHER, SEND_BYTES = 1 << 19, 1 << 20
LEVELS = 12
BUCKETS = 33
LOG_COUNT = np.log(np.arange(1 << 16, dtype=np.float32) + np.float32(0.4))
LEVEL = np.array([min(LEVELS - 1, n.bit_length()) for n in range(1 << 17)], np.int8)
END_WORD = np.uint64(0x0E0D0E0D0E0D0E0D)


def grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six-byte grams (context and byte) of all bytes and ends, and the documents' offsets into them."""
    n = np.diff(offs)
    wide = np.full(len(buf) + 6 * len(n), 255, np.uint8)
    first = offs[:-1] + 6 * np.arange(len(n)) + 5
    wide[K.ranges(first, n)] = buf
    return words_at(wide)[K.ranges(first - 5, n + 1)] >> np.uint64(16), np.concatenate([[0], np.cumsum(n + 1)])


def merged(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(g)
    g = g[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    return g[first], np.add.reduceat(n[order], first) if len(g) else n


def _code(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return K.mix((x + np.uint64(salt)) * K.SLOT_CODE[salt & 31])


def range_of(g: np.ndarray, ranges: int) -> np.ndarray:
    return (_code((g >> np.uint64(8)) & np.uint64(0xFFFF), 40) % np.uint64(ranges)).astype(np.int64)


def _slots(code: np.ndarray, node: np.ndarray, region: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (code + node.astype(np.uint64)) * K.SLOT_CODE[41]
    return ((x >> np.uint64(32)) * np.uint64(region) >> np.uint64(32)).astype(np.int64)


def _context(g: np.ndarray, order: int) -> np.ndarray:
    return _code((g >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1), order)


def place_of(g: np.ndarray, ranges: int, parts: int) -> np.ndarray:
    """Part of a range that a gram is sent to; all of an order-4 context are in one."""
    part = _code((g >> np.uint64(8)) & np.uint64(0xFFFFFFFF), 43) % np.uint64(parts)
    return range_of(g, ranges) * parts + part.astype(np.int64)


def block(g: np.ndarray, n: np.ndarray) -> bytes:
    step = np.diff(g, prepend=np.uint64(0))
    return planes(step & np.uint64(0xFFFFFFFF)) + planes(step >> np.uint64(32)) + planes(np.minimum(n, 2**32 - 1))


def unblock(b: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    x = len(b) // 3
    low, high, n = unplanes(b[:x]), unplanes(b[x:2 * x]), unplanes(b[2 * x:])
    return np.cumsum(low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)), n.astype(np.int64)


def sums_block(k: np.ndarray, n: np.ndarray) -> bytes:
    """As ``block``, for sums that may be larger than 32 bits."""
    return block(k, n & 0xFFFFFFFF) + planes(n >> 32)


def unblock_sums(b: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    x = len(b) // 4
    k, n = unblock(b[:3 * x])
    return k, n + (unplanes(b[3 * x:]).astype(np.int64) << 32)


class Gathered:
    """Distinct grams and their counts, of blocks that are added one by one."""

    def __init__(self):
        self.g, self.n, self.more, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, g: np.ndarray, n: np.ndarray):
        self.more.append((g, n))
        self.size += len(g)
        if self.size >= max(GATHER, len(self.g)):
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.more:
            both, self.more, self.size = [(self.g, self.n), *self.more], [], 0
            self.g, self.n = merged(*(np.concatenate(x) for x in zip(*both)))
        return self.g, self.n


def fit16(counts: np.ndarray) -> np.ndarray:
    """Pairs of counts (last axis), scaled into 16 bits where they are larger."""
    top = np.maximum(counts.max(axis=-1, keepdims=True), 1)
    return np.where(counts > 0, np.maximum(np.round(counts * np.minimum(1, 65535 / top)), 1), 0).astype(np.uint16)


class Hashed:
    """Counters in given tables [order][slot][decision], one region of slots for each range."""

    def __init__(self, tables: np.ndarray, ranges: int):
        self.tables, self.ranges, self.region = tables, ranges, tables.shape[1] // ranges

    def find(self, g: np.ndarray):
        return range_of(g, self.ranges) * self.region, [_context(g, order) for order in HASHED]

    def counts(self, found, bit: int, node: np.ndarray) -> list[np.ndarray]:
        base, codes = found
        return [t[base + _slots(c, node, self.region)] for t, c in zip(self.tables, codes)]


class Counters:
    """One counter for each context of orders 2 to 5 and node among a place's grams (distinct and sorted, of which
    those with n = 0 are only asked about). No two contexts share one. ``near``: of an order, all grams of the contexts
    and their sums, where other places have some too."""

    def __init__(self, g: np.ndarray, n: np.ndarray, near: dict[int, tuple[np.ndarray, np.ndarray]] | None = None):
        self.g, self.at, self.tables = g, [], []
        for order in HASHED:
            short = g & np.uint64((1 << 8 * (order + 1)) - 1)
            if order in (near or {}):
                keys, times = near[order]
                back = np.searchsorted(keys, short)
            else:
                keys, back = np.unique(short, return_inverse=True)
                times = np.bincount(back, n, len(keys)).astype(np.int64)
            self.at.append(back.astype(np.int32))
            self.tables.append(self.decisions(keys, times))

    @staticmethod
    def decisions(keys: np.ndarray, times: np.ndarray) -> np.ndarray:
        """[bit][key][decision]: how often each decision was taken at the nodes on the way to a key's last byte. Keys
        that share a context and node are neighbours."""
        def sums(shift):
            k = keys >> np.uint64(shift)
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            return np.repeat(np.add.reduceat(times, first), np.diff(first, append=len(k)))

        out = np.zeros((8, len(keys), 2), np.uint16)
        if len(keys):
            every, row = sums(8), np.arange(len(keys))
            for bit in range(8):
                taken = sums(7 - bit)
                value = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64)
                both = fit16(np.stack([every - taken, taken], axis=1))
                out[bit, row, 1 - value], out[bit, row, value] = both[:, 0], both[:, 1]
                every = taken
        return out

    def find(self, g: np.ndarray):
        at = np.searchsorted(self.g, g)
        return [a[at] for a in self.at]

    def counts(self, found, bit: int, node: np.ndarray) -> list[np.ndarray]:
        return [t[bit, at] for t, at in zip(self.tables, found)]


class Model:
    """Counters and mixer. ``pairs``: counts of all byte pairs, for orders 0 and 1."""

    def __init__(self, tables: Counters | np.ndarray, pairs: np.ndarray, ranges: int = 1):
        self.high = tables if isinstance(tables, Counters) else Hashed(tables, ranges)
        self.low = np.zeros((2, 256, 256, 2))  # orders 0 and 1: [order][context][node][bit]
        times = pairs.reshape(256, 256)
        sym = np.arange(256)
        for bit in range(8):
            node, value = (1 << bit) | sym >> (8 - bit), sym >> (7 - bit) & 1
            for s in range(256):
                self.low[1][:, node[s], value[s]] += times[:, s]
        self.low[0] = self.low[1].sum(axis=0)
        self.low = fit16(self.low)
        self.weights = np.full((ORDERS, ORDERS, LEVELS), 0.25, np.float32)
        self.refine = np.tile(1 / (1 + np.exp(-(np.arange(BUCKETS) - 16) / 2.0)), (256, 1)).astype(np.float32)

    def inputs(self, g: np.ndarray, bit: int, leave_out: bool):
        """Stretched predictions and count levels [order][gram], the gate, the decision and its node."""
        sym = (g & np.uint64(255)).astype(np.int64)
        node, value = (1 << bit) | sym >> (8 - bit), sym >> (7 - bit) & 1
        if bit == 0:
            self._found = self.high.find(g)
        counts = [self.low[0][0, node], self.low[1][(g >> np.uint64(8) & np.uint64(255)).astype(np.int64), node]]
        counts = np.stack(counts + self.high.counts(self._found, bit, node))
        if leave_out:
            mine = counts[:, np.arange(len(g)), value]
            counts[:, np.arange(len(g)), value] = np.maximum(mine, 1) - 1
        stretch = LOG_COUNT[counts[:, :, 1]] - LOG_COUNT[counts[:, :, 0]]
        total = counts.sum(axis=2, dtype=np.int32)
        gate = (ORDERS - 1) - np.argmax(total[::-1] > 0, axis=0)
        return stretch, LEVEL[total], gate, value, node

    def mixed(self, stretch, level, gate):
        x = np.zeros(stretch.shape[1], np.float32)
        for order in range(ORDERS):
            x += self.weights[gate, order, level[order]] * stretch[order]
        return np.clip(x, -11, 11)

    def refined(self, x, node):
        p = 1 / (1 + np.exp(-x))
        at = np.clip(x * 2 + 16, 0, BUCKETS - 1.001)
        low = at.astype(np.int64)
        part = at - low
        q = self.refine[node, low] * (1 - part) + self.refine[node, low + 1] * part
        return np.clip((p + q) / 2, 1e-5, 1 - 1e-5)

    def log10(self, g: np.ndarray) -> np.ndarray:
        """Log probability of each gram's last byte after the others."""
        out = np.zeros(len(g))
        for a in range(0, len(g), 1 << 15):
            part = g[a:a + (1 << 15)]
            for bit in range(8):
                stretch, level, gate, value, node = self.inputs(part, bit, False)
                p = self.refined(self.mixed(stretch, level, gate), node)
                out[a:a + len(part)] += np.log10(np.where(value == 1, p, 1 - p))
        return out

    def train(self, g: np.ndarray, n: np.ndarray, passes: int = 2, size: int = 2048, rate: float = 0.02):
        """Online gradient steps over the grams, in a fixed random order."""
        square = np.full(self.weights.shape, 1e-4, np.float32)
        rng = np.random.default_rng(7)
        for _ in range(passes):
            order = rng.permutation(len(g))
            for a in range(0, len(g), size):
                part, times = g[order[a:a + size]], n[order[a:a + size]].astype(np.float32)
                times /= times.sum()
                for bit in range(8):
                    stretch, level, gate, value, _ = self.inputs(part, bit, True)
                    error = (1 / (1 + np.exp(-self.mixed(stretch, level, gate))) - value) * times
                    grad = np.zeros_like(self.weights)
                    for o in range(ORDERS):
                        np.add.at(grad[:, o], (gate, level[o]), error * stretch[o])
                    square += grad * grad
                    self.weights -= rate * grad / np.sqrt(square)

    def outcomes(self, g: np.ndarray, n: np.ndarray) -> np.ndarray:
        """[node][bucket][ones, all] of the grams, each with its share in the two buckets beside its probability."""
        out = np.zeros((256 * BUCKETS, 2))
        for a in range(0, len(g), 1 << 15):
            part, times = g[a:a + (1 << 15)], n[a:a + (1 << 15)]
            for bit in range(8):
                stretch, level, gate, value, node = self.inputs(part, bit, True)
                at = np.clip(self.mixed(stretch, level, gate) * 2 + 16, 0, BUCKETS - 1.001)
                low = at.astype(np.int64)
                for step, share in ((0, 1 - (at - low)), (1, at - low)):
                    place = node * BUCKETS + low + step
                    out[:, 0] += np.bincount(place, times * share * value, len(out))
                    out[:, 1] += np.bincount(place, times * share, len(out))
        return out.reshape(256, BUCKETS, 2)


class Learned:
    """What all places share: counts of byte pairs, mixer and refinement. Called with a place's grams, their model."""

    def __init__(self, spark, pairs: np.ndarray):
        empty = Model(Counters(np.zeros(0, np.uint64), np.zeros(0, np.int64)), pairs)
        self.pairs, self.weights, self.refine = spark.sparkContext.broadcast(pairs), empty.weights, empty.refine

    def __call__(self, g: np.ndarray, n: np.ndarray, near: dict | None = None) -> Model:
        m = Model(Counters(g, n, near), self.pairs.value)
        m.weights, m.refine = self.weights.copy(), self.refine
        return m


def blocks_of(chunks: DataFrame) -> DataFrame:
    return chunks.where("place is not null").select("place", "chunk", "block")


def gathered(chunks: DataFrame, parts: int) -> DataFrame:
    """(place, block, pairs, near): each place's distinct grams with their training counts, its counts of byte pairs, and
    what its range has of the shared orders (null if the range is one place)."""
    made = pa.schema([("place", pa.int64()), ("block", pa.binary()), ("pairs", pa.binary())])

    def run(batches):
        def done():
            g, n = held.all()
            return batch(made, [place], [block(g, n)], [block(*merged(g & np.uint64(0xFFFF), n))])

        place, held = None, None
        for rb in batches:
            for to, b in zip(rb.column(0).to_pylist(), rb.column(1)):
                if to != place:
                    if held is not None:
                        yield done()
                    place, held = to, Gathered()
                held.add(*unblock(b.as_buffer()))
        if held is not None:
            yield done()

    sent = spread(blocks_of(chunks).select("place", "block"), "place").sortWithinPartitions("place")
    counted = written(sent.mapInArrow(run, "place long, block binary, pairs binary"))
    if parts > 1:
        return written(counted.join(shared_sums(counted, parts), "place"))
    return counted.withColumn("near", F.lit(None).cast("array<struct<order:int,block:binary>>"))


def shared_sums(counted: DataFrame, parts: int) -> DataFrame:
    """(place, near): for each shared order, all grams of the contexts that a place has and their sums over its range.
    Sums meet by a hash of their context, each context's in one of the range's parts."""
    asks = pa.schema([("at", pa.int64()), ("order", pa.int32()), ("place", pa.int64()), ("block", pa.binary())])
    answers = pa.schema([("place", pa.int64()), ("order", pa.int32()), ("block", pa.binary())])

    def send(batches):
        for rb in batches:
            for place, b in zip(rb.column(0).to_pylist(), rb.column(1)):
                g, n = unblock(b.as_buffer())
                for order in SHARED:
                    k, times = merged(g & np.uint64((1 << 8 * (order + 1)) - 1), n)
                    at = place // parts * parts + (_code(k >> np.uint64(8), 44) % np.uint64(parts)).astype(np.int64)
                    by = np.argsort(at, kind="stable")
                    k, times, at = k[by], times[by], at[by]
                    cut = np.flatnonzero(np.diff(at, prepend=-1))
                    yield batch(asks, at[cut], [order] * len(cut), [place] * len(cut),
                                [sums_block(k[x:y], times[x:y]) for x, y in zip(cut, [*cut[1:], len(k)])])

    def add_up(rows: pa.Table) -> pa.Table:
        each = [unblock_sums(b.as_buffer()) for b in rows.column(3)]
        k, n = merged(*(np.concatenate(x) for x in zip(*each)))
        contexts, back = np.unique(k >> np.uint64(8), return_inverse=True)
        out = []
        for mine, _ in each:
            has = np.zeros(len(contexts), bool)
            has[np.searchsorted(contexts, mine >> np.uint64(8))] = True
            out.append(sums_block(k[has[back]], n[has[back]]))
        return pa.Table.from_batches([batch(answers, rows.column(2).to_pylist(), rows.column(1).to_pylist(), out)])

    sent = counted.select("place", "block").mapInArrow(send, "at long, order int, place long, block binary")
    sums = sent.groupBy("at", "order").applyInArrow(add_up, "place long, order int, block binary")
    return sums.groupBy("place").agg(F.collect_list(F.struct("order", "block")).alias("near"))


def near_of(cell) -> dict[int, tuple[np.ndarray, np.ndarray]] | None:
    """The shared orders' grams and sums of a row of ``gathered``, each order's sorted."""
    if not cell.is_valid:
        return None
    found = {order: [] for order in SHARED}
    for x in cell:
        found[x["order"].as_py()].append(unblock_sums(x["block"].as_buffer()))
    return {order: merged(*(np.concatenate(x) for x in zip(*blocks))) for order, blocks in found.items()}


def learn(counted: DataFrame) -> Learned:
    """The mixer and refinement of the places' grams."""
    def add_up(batches):
        total = np.zeros(65536, np.int64)
        for rb in batches:
            for b in rb.column(0):
                pair, n = unblock(b.as_py())
                total[pair.astype(np.int64)] += n
        yield batch(pa.schema([("pairs", pa.binary())]), [total.tobytes()])

    pairs = np.zeros(65536, np.int64)
    for r in counted.select("pairs").mapInArrow(add_up, "pairs binary").toLocalIterator():
        pairs += np.frombuffer(r.pairs, np.int64)
    model = Learned(counted.sparkSession, pairs)
    result = pa.schema([("value", pa.binary()), ("n", pa.float64())])

    def each_place(step):
        """Sum of what ``step(model, grams, counts)`` gives for each place, each result times its weight, and weights."""
        def run(batches):
            total = None
            for rb in batches:
                for b, near in zip(rb.column(0), rb.column(1)):
                    g, n = unblock(b.as_buffer())
                    m = model(g, n, near_of(near))
                    value, w = step(m, g[n > 0], n[n > 0])
                    total = (value * w, w) if total is None else (total[0] + value * w, total[1] + w)
            if total is not None:
                yield batch(result, [np.asarray(total[0], np.float64).tobytes()], [float(total[1])])

        parts = counted.select("block", "near").mapInArrow(run, "value binary, n double").collect()
        return sum(np.frombuffer(r.value, np.float64) for r in parts), sum(r.n for r in parts)

    def trained(m: Model, g, n):
        m.train(g, n)
        return m.weights.astype(np.float64).reshape(-1), float(n.sum())

    weights, n = each_place(trained)
    if n:
        model.weights = (weights / n).astype(np.float32).reshape(model.weights.shape)
        hits, _ = each_place(lambda m, g, n: (m.outcomes(g, n).reshape(-1), 1.0))
        ones, all_ = np.moveaxis(hits.reshape(256, BUCKETS, 2), 2, 0)
        model.refine = ((ones + 16 * model.refine) / (all_ + 16)).astype(np.float32)
    return model


def gram_costs(chunks: DataFrame, counted: DataFrame, model: Learned) -> DataFrame:
    """(chunk, place, cost): log probabilities of the grams of each block, in its order."""
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int64()), ("cost", pa.binary())])

    def run(batches):
        for rb in batches:
            out, size = [], 0
            for place, chunk, b, near in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), *rb.columns[2:]):
                if chunk is None:  # the place's own grams come first
                    g, n = unblock(b.as_buffer())
                    cost = model(g, n, near_of(near)).log10(g).astype(np.float32).view(np.uint32)
                    continue
                out.append((chunk, place, planes(cost[np.searchsorted(g, unblock(b.as_buffer())[0])])))
                size += len(out[-1][2])
                if size >= SEND_BYTES:
                    yield batch(schema, *zip(*out))
                    out, size = [], 0
            if out:
                yield batch(schema, *zip(*out))

    table = counted.select("place", F.lit(None).cast("long").alias("chunk"), "block", "near")
    asked = spread(blocks_of(chunks).unionByName(table, allowMissingColumns=True), "place")
    return written(asked.sortWithinPartitions("place", F.col("chunk").asc_nulls_first()).mapInArrow(
        run, "chunk long, place long, cost binary"))


#: A chunk has one row with its texts, one for each range of words it asks (``asked``) and one for each place.
CHUNKS = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("learn", pa.list_(pa.bool_())),
                    ("n_tokens", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary())),
                    ("widths", pa.list_(pa.int64())), ("places", pa.binary()), ("times", pa.binary()),
                    ("asked", pa.int32()), ("words", pa.binary()), ("place", pa.int64()), ("block", pa.binary())])
CHUNKS_SQL = ("chunk long, doc_ids array<long>, learn array<boolean>, n_tokens array<long>, texts array<binary>, "
              "widths array<long>, places binary, times binary, asked int, words binary, place long, block binary")


def chunk_grams(buf: np.ndarray, offs: np.ndarray, ranges: int, parts: int):
    """A chunk's distinct grams ordered by place and gram, their places, and which of them each byte and end is. Grams
    of all bytes are held for one run at a time."""
    code, runs, own = np.empty(len(buf) + len(offs) - 1, np.int32), [], []
    for a, b in K.doc_runs(offs, RUN):
        x = pa.array(grams(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])[0]).dictionary_encode()
        runs.append(slice(offs[a] + a, offs[b] + b))
        own.append(x.dictionary)
        code[runs[-1]] = x.indices.to_numpy()
        del x
    own = pa.chunked_array(own).dictionary_encode().chunks
    g = own[-1].dictionary.to_numpy()  # the last one has all
    place = place_of(g, ranges, parts)
    order = np.lexsort((g, place))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    for run, x in zip(runs, own):
        code[run] = rank[x.indices.to_numpy()][code[run]]
    return g[order], place[order], code


def chunked(docs: DataFrame, ranges: int, parts: int, word_ranges: int) -> DataFrame:
    """Chunks of documents with their word frequencies, bucketed by chunk; per word range the distinct words and per place
    the distinct grams, with the number of their training occurrences in the chunk."""
    def rows(chunk: int, **cells):
        """Rows of these cells, as batches of bounded size; the columns that are not named are null."""
        a, n = 0, len(next(iter(cells.values())))
        while a < n:
            b, size = a + 1, 0
            while b < n and size < SEND_BYTES:
                size += sum(len(c[b]) for c in cells.values() if isinstance(c[b], bytes))
                b += 1
            yield batch(CHUNKS, [chunk] * (b - a), *(cells[f.name][a:b] if f.name in cells else pa.nulls(b - a, f.type)
                                                     for f in [*CHUNKS][1:]))
            a = b

    def run(batches):
        for rb in batches:
            buf, offs = K.text_buffer(rb.column(2))
            for a, b in K.doc_runs(offs, CHUNK_BYTES):
                yield from chunk(rb.slice(a, b - a), buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])

    def chunk(rb, buf, offs):
        number = secrets.randbits(63)
        learn = rb.column(1).to_numpy(zero_copy_only=False)
        g, place, code = chunk_grams(buf, offs, ranges, parts)
        times, known = np.zeros(len(g), np.int64), np.repeat(learn, np.diff(offs) + 1)
        for x in range(0, len(code), RUN):
            times += np.bincount(code[x:x + RUN][known[x:x + RUN]], minlength=len(g))
        del code, known
        cut = np.flatnonzero(np.diff(place, prepend=-1))
        yield from rows(number, place=place[cut].tolist(),
                        block=[block(g[x:y], times[x:y]) for x, y in zip(cut, [*cut[1:], len(g)])])
        del g, place, times
        h, first = K.words(buf, offs)[:2]
        first = K.doc_word_offsets(first, offs)
        n = np.diff(first) + 1
        code = pa.array(np.insert(h, first[1:], END_WORD)).dictionary_encode()
        distinct, code = code.dictionary.to_numpy(), code.indices.to_numpy()
        del h, first
        of = ((distinct >> np.uint64(20)) % np.uint64(word_ranges)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        code = rank[code]
        seen = np.bincount(code[np.repeat(learn, n)], minlength=len(order))
        code |= np.repeat(np.arange(len(n)) << 32, n)
        key, times = np.unique(code, return_counts=True)
        del code
        widths = np.bincount(key >> 32, minlength=len(n))
        place = key & 0xFFFFFFFF
        step = np.diff(place, prepend=0)
        starts = np.cumsum(widths) - widths
        step[starts] = place[starts]
        asked, cut = np.unique(of[order], return_index=True)
        blocks = [distinct[order[x:y]].tobytes() + planes(seen[x:y]) for x, y in zip(cut, [*cut[1:], len(order)])]
        yield from rows(number, asked=asked.tolist(), words=blocks)
        yield from rows(number, doc_ids=[rb.column(0).to_pylist()], learn=[learn.tolist()], n_tokens=[n],
                        texts=[[buf[x:y].tobytes() for x, y in zip(offs[:-1], offs[1:])]], widths=[widths],
                        places=[planes(step)], times=[planes(times)])

    return written_buckets(docs.select("doc_id", "learn", "text").mapInArrow(run, CHUNKS_SQL), "chunk")


def word_counts(chunks: DataFrame) -> DataFrame:
    """(chunk, asked, found, n, v): training counts for each block; its range's token and type numbers, once a range."""
    schema = pa.schema([("chunk", pa.int64()), ("asked", pa.int32()), ("found", pa.binary()), ("n", pa.int64()),
                        ("v", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        words, seen = [], []
        for b in rows.column(2):
            b = b.as_py()
            n = len(b) // 12
            words.append(np.frombuffer(b[:8 * n], np.uint64))
            seen.append(unplanes(b[8 * n:]).astype(np.int64))
        every, back = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(back, np.concatenate(seen).astype(np.float64), len(every)).astype(np.int64)
        found, at = [], 0
        for w in words:
            found.append(count[back[at:at + len(w)]].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())
            at += len(w)
        once = np.arange(len(found)) == 0
        return pa.Table.from_batches([batch(schema, *(c.combine_chunks() for c in rows.columns[:2]), found,
                                            np.where(once, count.sum(), 0), np.where(once, (count > 0).sum(), 0))])

    asks = chunks.where("asked is not null").select("chunk", "asked", F.col("words").alias("block"))
    return written(asks.groupBy("asked").applyInArrow(run, "chunk long, asked int, found binary, n long, v long"))


def score(docs: DataFrame, holdout: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte. A document's bytes include
    its end. Learns from documents whose crc32(doc_id as text) modulo ``holdout`` is not 0."""
    rest = F.crc32(F.col(f"`{id_col}`").cast("string")) % holdout
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(rest != 0, F.lit(False)).alias("learn"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = int(1 + total // RANGE_BYTES)
    parts = -(-places // MOST_RANGES)  # of each range
    ranges = -(-places // parts)
    chunks = chunked(docs, ranges, parts, 1 + total // WORD_RANGE_BYTES)
    counted = gathered(chunks, parts)
    costs = gram_costs(chunks, counted, learn(counted))
    counts = word_counts(chunks)
    sums = counts.agg(F.sum("n"), F.sum("v")).first()
    n, v = sums[0] or 0, sums[1] or 0
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                        ("bits_per_byte", pa.float64())])

    def finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        ids, learn_, n_tokens, texts, widths, places, times = (chunk.column(c)[0] for c in range(1, 8))
        widths = widths.values.to_numpy().astype(np.int64)
        first = np.concatenate([[0], np.cumsum(widths)])
        run_up = np.concatenate([[0], np.cumsum(unplanes(places.as_buffer()).astype(np.int64))])
        place = run_up[1:] - np.repeat(run_up[first[:-1]], widths)
        times = unplanes(times.as_buffer()).astype(np.int64)
        c = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)
             for x in ordered(answers, "asked", "found")]
        c = np.concatenate(c)[place]
        base = np.add.reduceat(np.log10((c + 0.1) / (n + 0.1 * (v + 1))) * times, first[:-1])
        known = np.add.reduceat(times * (c > 0), first[:-1])
        del c, place, run_up, times
        buf, offs = K.text_buffer(texts.values)
        of_gram = np.concatenate([unplanes(x).view(np.float32) for x in ordered(answers, "place", "cost")])
        code = chunk_grams(buf, offs, ranges, parts)[2]
        starts, score_ = offs + np.arange(len(offs)), np.empty(len(widths))
        for a, b in K.doc_runs(offs, RUN):
            cost = of_gram[code[starts[a]:starts[b]]].astype(np.float64)
            score_[a:b] = np.add.reduceat(cost, starts[a:b] - starts[a])
        return pa.Table.from_batches([batch(
            schema, ids.values, [not x for x in learn_.values.to_pylist()], n_tokens.values, known,
            np.full(len(widths), n), base, score_, -score_ / np.log10(2) / (np.diff(offs) + 1))])

    def ordered(answers: pa.Table, key: str, value: str) -> list[pa.Buffer]:
        found = [(k, x) for k, x in zip(answers.column(key).to_pylist(), answers.column(value)) if k is not None]
        return [x.as_buffer() for _, x in sorted(found, key=lambda x: x[0])]

    answers = counts.select("chunk", "asked", "found").unionByName(costs, allowMissingColumns=True)
    texts = chunks.where("asked is null and place is null").drop("asked", "words", "place", "block")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, bits_per_byte double")
