"""Vectorised byte and word primitives used inside tasks (numpy over Arrow buffers, no Spark).

Texts arrive as one byte buffer with document offsets. Words are maximal runs of bytes that a 256-entry table does
not map to 0; they never cross a document. Hashes are 64-bit; a null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB = 1 << 20
MULT = 0x9E3779B97F4A7C15 | 1

_rng = np.random.default_rng(20240117)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SLOT_CODE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Words of the contracts: runs without \x20 and \x09-\x0D, A-Z lower-cased.
WORD_TABLE = np.arange(256, dtype=np.uint8)
WORD_TABLE[[9, 10, 11, 12, 13, 32]] = 0
WORD_TABLE[65:91] += 32
#: NUL is a word byte like any other; the table keeps 0 for separators, so it moves to a byte UTF-8 never uses.
WORD_TABLE[0] = 255

_powers = {"n": 0}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and MULT**-i modulo 2**64 for i < n."""
    if _powers["n"] < n:
        inv = pow(MULT, -1, 1 << 64)
        with np.errstate(over="ignore"):
            both = []
            for x in (MULT, inv):
                step = np.full(n, x, dtype=np.uint64)
                step[0] = 1
                both.append(np.cumprod(step))
        _powers.update(n=n, p=both[0], q=both[1])
    return _powers["p"][:n], _powers["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; works in place on a uint64 array that the caller owns."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x7FB5D329728EA185)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x81DADEF4BC2DD44D)
        x ^= x >> np.uint64(33)
    return x


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of an Arrow string or binary column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def doc_runs(offs: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes (a longer document is alone)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def span_hashes(t: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [s, e)."""
    p, q = powers(max(SLAB, len(t)) + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(t) + 1, np.uint64)
        np.cumsum(BYTE_CODE[t] * p[:len(t)], out=acc[1:])
        return mix((acc[e] - acc[s]) * q[s])


def words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray = WORD_TABLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word, in order. Works in slabs cut at separators, so the extra memory
    does not grow with a long text unless it is one single word."""
    hashes, starts, ends = [], [], []
    pos, n = 0, len(buf)
    bounds = offs[1:-1]
    while pos < n:
        end = min(n, pos + SLAB)
        if end < n:
            cut = int(np.searchsorted(offs, end, "right")) - 1
            if offs[cut] > pos:
                end = int(offs[cut])
            else:
                stop = min(n, int(offs[cut + 1]))
                back = np.flatnonzero(table[buf[pos:end]] == 0)
                if len(back):
                    end = pos + int(back[-1]) + 1
                else:
                    while end < stop:
                        ahead = np.flatnonzero(table[buf[end:min(stop, end + SLAB)]] == 0)
                        if len(ahead):
                            end += int(ahead[0])
                            break
                        end = min(stop, end + SLAB)
        t = table[buf[pos:end]]
        on = t != 0
        first = on.copy()
        first[1:] &= ~on[:-1]
        inner = bounds[np.searchsorted(bounds, pos, "right"):np.searchsorted(bounds, end, "left")] - pos
        first[inner] = on[inner]
        last = on.copy()
        last[:-1] &= ~on[1:]
        last[inner - 1] = on[inner - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(span_hashes(t, s, e))
        starts.append(s + pos)
        ends.append(e + pos)
        pos = end
    if not hashes:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within a document and the documents' offsets into them. ``first``: word offsets
    of the documents. A document of 1 to k-1 words has its whole sequence as its one shingle."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out_first = np.concatenate([[0], np.cumsum(count)])
    with np.errstate(over="ignore"):
        length = np.minimum(n, k)
        acc = np.zeros(len(h), np.uint64)
        for j in range(k):
            acc[:max(0, len(h) - j)] += h[j:] * SLOT_CODE[j]
        starts = np.repeat(first[:-1] - out_first[:-1], count) + np.arange(out_first[-1])
        sh = acc[starts]
        short = np.flatnonzero((n > 0) & (n < k))
        for d in short:  # the rolling sum ran into the next document
            w = h[first[d]:first[d + 1]]
            sh[out_first[d]] = (w * SLOT_CODE[:len(w)]).sum(dtype=np.uint64)
        sh += np.repeat(length, count).astype(np.uint64) * SLOT_CODE[63]
    return mix(sh), out_first


def doc_word_offsets(starts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.searchsorted(starts, offs, "left")


def segment_distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each segment, and the new offsets."""
    parts = [np.unique(values[a:b]) if b - a > 1 else values[a:b] for a, b in zip(first[:-1], first[1:])]
    out = np.concatenate(parts) if parts else values[:0]
    return out, np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
