"""Hierarchical multi-length packing of tokenised documents.

A document is its token ids followed by one separator id. Full windows of the longest context are cut off first; the
rest of a document is routed to the smallest context tier that holds it. Tiers are packed from long to short: a
window starts with one rest of its tier, its gap is filled with the best-fitting rests of shorter tiers, and what
still is open takes the first part of a longer rest, whose remainder goes back to its own tier. So every window but
the last one of a packing group is exactly full, and a window of a shorter tier is a power of two and needs no
padding. Finally the windows are dealt to step groups of about equal token counts (longest first, to the lightest).

Packing groups hold about ``group_bytes`` of text each, dealt by a hash of id and text: the number of groups grows
with the corpus, a task holds one group, and at most one window per group is padded. A longer document is in one
group, as its text is one row.

Defined results: a null or empty text is the separator alone; repeated rows are packed as documents of their own; a
null doc_id stays null; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import batch, text_column
from .tokencount import SPACE, load

#: Bytes of text per packing group, and of text tokenised at a time.
GROUP_BYTES = 4 << 20
RUN = 1 << 20
#: Distinct words whose ids a task keeps; beyond it the list starts anew.
WORDS_KEPT = 1_000_000
#: Their characters and their ids, likewise.
CHARS_KEPT = 1 << 24

# The published split pattern of the word BPE (white space dropped), for code points below U+0250.
LATIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


LETTER, DIGIT, SIGN, BLANK = 1, 2, 3, 0
KINDS = np.full(256, SIGN, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = BLANK
KINDS[48:58] = DIGIT
KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def simple(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Documents of ASCII and the letters U+00C0 to U+00FF only, without the start of an added token: their words can
    be cut by byte classes."""
    two = np.zeros(len(buf), bool)
    two[:-1] = ((buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))) | ((buf[:-1] == 60) & (buf[1:] == 124))
    odd = np.concatenate([[0], np.cumsum(two | (buf > 0xC3) | (buf == 0xC2))])
    return odd[offs[1:]] == odd[offs[:-1]]


def cut_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of simple documents, and the words' starts and ends: runs of letters, single digits, runs of
    signs, and the endings 's 't 'm 'd 're 've 'll where an apostrophe stands alone before them."""
    low = LOWER[buf]
    low[1:] += np.where((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E), 32, 0).astype(np.uint8)
    kind = KINDS[low]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    begin = np.ones(len(buf), bool)
    begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    begin |= edge[:-1]
    at = np.flatnonzero((low[:-1] == 39) & begin[:-1] & begin[1:] & ~edge[1:-1])
    if len(at):
        pad = np.concatenate([low, np.zeros(3, np.uint8)])
        x, y = pad[at + 1], pad[at + 2]
        one = (x == 115) | (x == 116) | (x == 109) | (x == 100)
        inside = ~edge[np.minimum(at + 2, len(buf))]
        two = inside & (((x == 114) | (x == 118)) & (y == 101) | (x == 108) & (y == 108))
        at, more = at[one | two], np.where(one, 2, 3)[one | two]
        begin[at + 1] = False
        after = at + more
        after = after[after < len(buf)]
        begin[after] |= kind[after] == LETTER
    begin_or_blank = np.flatnonzero(begin)
    ends = np.append(begin_or_blank[1:], len(buf))
    word = kind[begin_or_blank] != BLANK
    return low, begin_or_blank[word], ends[word]


class WordTokenizer:
    """Token ids of whole texts; each distinct word is encoded once, then looked up."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.added = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(LATIN_WORDS).findall
        self.other = regex.compile(r"[^\x00-ĩı-ɏ]").search
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.clear()

    def clear(self):
        self.index: dict = {}  # places of words that aren't cut by byte classes, of added tokens, and of the end
        self.held = 0  # characters of these
        self.hash, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # of words, by their sorted hashes
        self.n = 0  # lists of ids kept: list i is flat[first[i]:first[i + 1]], both arrays have room to grow
        self.first, self.flat = np.zeros(1024, np.int64), np.zeros(4096, self.dtype)

    def learn(self, ids: list[list[int]]) -> np.ndarray:
        """Keep these ids; returns their places."""
        at, start = self.n, int(self.first[self.n])
        ends = start + np.cumsum([len(x) for x in ids], dtype=np.int64)
        self.n += len(ids)
        end = int(ends[-1]) if len(ids) else start
        if self.n >= len(self.first):
            self.first = np.concatenate([self.first, np.zeros(self.n, np.int64)])
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(end, self.dtype)])
        self.first[at + 1:self.n + 1] = ends
        self.flat[start:end] = np.fromiter((i for x in ids for i in x), self.dtype, end - start)
        return np.arange(at, self.n, dtype=np.int32)

    def full(self) -> bool:
        return self.n > WORDS_KEPT or self.held > CHARS_KEPT or int(self.first[self.n]) > CHARS_KEPT

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def of_simple(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words in the kept list, and the documents' offsets into them."""
        low, s, e = cut_words(buf, offs)
        code = pa.array(K.span_hashes(low, s, e)).dictionary_encode()
        distinct, code = code.dictionary.to_numpy(), code.indices.to_numpy()
        at = np.searchsorted(self.hash, distinct)
        if len(self.hash):
            new = np.flatnonzero(self.hash[np.minimum(at, len(self.hash) - 1)] != distinct)
        else:
            new = np.arange(len(distinct))
        if len(new):
            sample = np.zeros(len(distinct), np.int64)
            sample[code[::-1]] = np.arange(len(code))[::-1]
            raw = low.tobytes()
            places = self.learn(self.encode([raw[s[i]:e[i]].decode() for i in sample[new].tolist()]))
            order = np.argsort(distinct[new])
            at = np.searchsorted(self.hash, distinct[new][order])
            self.hash = np.insert(self.hash, at, distinct[new][order])
            self.place = np.insert(self.place, at, places[order])
        place = self.place[np.searchsorted(self.hash, distinct)][code]
        return place, np.searchsorted(s, offs)

    def of_other(self, text: str) -> np.ndarray:
        """Places of the words and added tokens of a text without other scripts."""
        parts = self.added.split(text) if self.added else [text]
        keys = [w for i, p in enumerate(parts) for w in ([("added", p)] if i % 2 else self.words(p.lower()))]
        new = [k for k in dict.fromkeys(keys) if k not in self.index]
        if new:
            words = [k for k in new if type(k) is str]
            found = dict(zip(words, self.encode(words)))
            self.index.update(zip(new, self.learn([found[k] if type(k) is str else [self.special[k[1]]] for k in new]).tolist()))
            self.held += sum(map(len, words))
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def __call__(self, buf: np.ndarray, offs: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the documents' offsets into them; ``end`` follows each document. Words are kept from call to call,
        texts of other scripts are encoded whole and forgotten."""
        if self.full():
            self.clear()
        if ("end", end) not in self.index:
            self.index["end", end] = int(self.learn([[end]])[0])
        stop = np.array([self.index["end", end]])
        plain = simple(buf, offs)
        cuts = np.flatnonzero(np.diff(plain, prepend=~plain[:1]))
        places, counts, whole = [], [], []
        for a, b in zip(cuts, [*cuts[1:], len(plain)]):
            part, o = buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
            if plain[a]:
                place, first = self.of_simple(part, o)
                places.append(np.insert(place, first[1:], stop[0]))
                counts.append(np.diff(first) + 1)
            else:
                for i in range(b - a):
                    text = part[o[i]:o[i + 1]].tobytes().decode()
                    if self.other(text):
                        whole.append((len(places), text))
                        place = stop
                    else:
                        place = self.of_other(text)
                    places += [place, stop]
                    counts.append([len(place) + 1])
        kept = self.n
        if whole:
            for (at, _), place in zip(whole, self.learn(self.encode([text for _, text in whole]))):
                places[at] = np.array([place])
        place, count = np.concatenate(places), np.concatenate(counts)
        width = self.first[place + 1] - self.first[place]
        ids = self.flat[K.ranges(self.first[place], width)]
        self.n = kept
        return ids, np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(count)])]


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker process; its words are kept from task to task."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenised(docs: DataFrame, path: str, end: int) -> DataFrame:
    """pack, doc_id, ids (binary, little-endian, 2 or 4 bytes each)."""
    schema = pa.schema([("pack", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        tok = word_tokenizer(path)
        for rb in batches:
            buf, offs = K.text_buffer(rb.column(2))
            for a, b in K.doc_runs(offs, RUN):
                ids, first = tok(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], end)
                size = ids.itemsize
                col = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((first * size).astype(np.int32)),
                                                                 pa.py_buffer(ids)])
                yield batch(schema, rb.column(0).slice(a, b - a), rb.column(1).slice(a, b - a), col)

    return docs.mapInArrow(run, "pack long, doc_id long, ids binary")


def pack_rests(lengths: list[int], tiers: tuple[int, ...]) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) over documents of these lengths; ``tiers`` from long to short."""
    longest, shortest = tiers[0], tiers[-1]
    windows = [[(d, s, longest)] for d, n in enumerate(lengths) for s in range(0, n - longest + 1, longest)]
    rests = sorted((n % longest, -d, n - n % longest) for d, n in enumerate(lengths) if n % longest)
    while rests:
        length, d, start = rests.pop()
        tier = min(t for t in tiers if t >= length)
        window, gap = [(-d, start, length)], tier - length
        while gap and rests:
            i = bisect_right(rests, (gap, 1, 0))
            if i:  # the longest rest that fits: it comes from a shorter tier, or from this one if that is all there is
                n, d, start = rests.pop(i - 1)
            else:  # none fits: the shortest is cut, and its remainder goes back
                n, d, start = rests.pop(0)
                insort(rests, (n - gap, d, start + gap))
                n = gap
            window.append((-d, start, n))
            gap -= n
        if gap and tier > shortest:  # the group's last rests: smaller full windows, then one open window
            need = sum(n for _, _, n in window)
            half = 1 << (need.bit_length() - 1)
            head, tail, have = [], [], 0
            for d, start, n in window:
                take = min(n, half - have)
                have += take
                head += [(d, start, take)] * (take > 0)
                tail += [(d, start + take, n - take)] * (n > take)
            window = head
            for d, start, n in tail:
                insort(rests, (n, -d, start))
        windows.append(window)
    return windows


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A step group for each window, with about equal token counts."""
    steps = max(1, round(sum(sizes) / step_tokens))
    heap = [(0, s) for s in range(steps)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load_, s = heapq.heappop(heap)
        out[i] = s
        heapq.heappush(heap, (load_ + sizes[i], s))
    return out


def pack(docs: DataFrame, tokenizer_path: str, end: int = 1, tiers: tuple[int, ...] = (2048, 1024, 512, 256),
         step_tokens: int = 1 << 17, group_bytes: int = GROUP_BYTES, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens,
    step_group, and the piece's ``ids`` if asked for."""
    docs = text_column(docs, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1 + total // group_bytes
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("pack"), "doc_id", "text")
    dtype = np.uint16 if load(tokenizer_path).get_vocab_size() <= 1 << 16 else np.uint32
    kinds = [("doc_id", pa.int64(), "long"), ("start", pa.int64(), "long"), ("length", pa.int64(), "long"),
             ("ids_crc32", pa.int64(), "long"), ("doc_tokens", pa.int64(), "long"), ("sequence_id", pa.int64(), "long"),
             ("offset", pa.int64(), "long"), ("sequence_tokens", pa.int64(), "long"), ("step_group", pa.int64(), "long")]
    kinds += [("ids", pa.list_(pa.int32()), "array<int>")] * with_ids
    schema = pa.schema([k[:2] for k in kinds])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        found = []
        for doc_id, ids in zip(rows.column(1).to_pylist(), rows.column(2)):
            ids = np.frombuffer(ids.as_buffer(), dtype)
            found.append((doc_id is None, doc_id or 0, len(ids), zlib.crc32(ids), doc_id, ids))
        found.sort(key=lambda x: x[:4])
        windows = pack_rests([x[2] for x in found], tiers)
        sizes = [sum(n for _, _, n in w) for w in windows]
        steps = step_groups(sizes, step_tokens)
        out = []
        for w, (window, size, step) in enumerate(zip(windows, sizes, steps)):
            at = 0
            for d, start, n in window:
                ids = found[d][5][start:start + n].astype("<u4")
                row = (found[d][4], start, n, zlib.crc32(ids), found[d][2], (group << 32) + w, at, size,
                       (group << 32) + step)
                out.append(row + (ids.astype(np.int32),) * with_ids)
                at += n
        return pa.Table.from_batches([batch(schema, *zip(*out))])

    return tokenised(dealt, tokenizer_path, end).groupBy("pack").applyInArrow(
        run, ", ".join(f"{k[0]} {k[2]}" for k in kinds))
