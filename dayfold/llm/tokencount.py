"""Exact token counts without materialising token ids.

A byte-level BPE tokenizer first cuts a text into pre-tokens and merges only inside them, so a text's token count is
the sum over its pre-tokens. The corpus is read once into chunks: a chunk holds its documents' pre-token frequencies
as a sparse matrix over the chunk's own list of distinct pre-tokens. The lists are dealt out by hash range (one block
per chunk and range), each range encodes its distinct pre-tokens once and answers every block with token counts; the
answers are joined to the chunks, and every chunk adds up its own documents. A pre-token that is in every document is
asked once per chunk. The number of ranges grows with the text, so a range stays in a task's memory.

Strings of added tokens inside a text count as the tokenizer does by default: one token each, cut out before
pre-tokenisation.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows each get a row; a null doc_id is kept;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import secrets
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, text_column, written

#: Bytes of text per chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Bytes of text per range of pre-tokens.
RANGE_BYTES = 32 << 20

# The published split pattern of byte-level BPE, with white space written out for code points below
# U+0250, where every Unicode version agrees on letters and digits. Other texts are split by the tokenizer itself.
SPACE = r"\t-\r \x85\xa0"
LATIN_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
               rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class _Index(dict):
    """Number of a key by first appearance."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Splitter:
    """Pre-tokens of a text, added-token strings taken out."""

    def __init__(self, path: str):
        self.tok = load(path)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(sorted(map(regex.escape, added), key=len, reverse=True))) if added else None
        self.split = regex.compile(LATIN_SPLIT).findall
        self.other = regex.compile(r"[^\x00-ɏ]").search

    def pieces(self, text: str) -> list[str]:
        if self.other(text):
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return self.split(text)

    def __call__(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens and the number of added tokens."""
        if self.added is None or not self.added.search(text):
            return self.pieces(text), 0
        parts = self.added.split(text)
        return [p for part in parts if part for p in self.pieces(part)], len(parts) - 1


def planes(x: np.ndarray) -> bytes:
    """Integers as byte planes, which the codecs of Parquet and shuffle shrink well."""
    x = np.ascontiguousarray(x, dtype="<u4")
    return x.view(np.uint8).reshape(-1, 4).T.tobytes()


def unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


CHUNKS = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())),
                    ("n_added", pa.list_(pa.int64())), ("widths", pa.list_(pa.int64())), ("places", pa.binary()),
                    ("times", pa.binary()), ("asked", pa.list_(pa.int32())), ("blocks", pa.list_(pa.binary()))])
CHUNKS_SQL = ("chunk long, doc_ids array<long>, n_bytes array<long>, n_added array<long>, widths array<long>, "
              "places binary, times binary, asked array<int>, blocks array<binary>")


def string_block(strings: list[bytes]) -> bytes:
    return len(strings).to_bytes(4, "little") + planes(np.array([*map(len, strings)])) + b"".join(strings)


def block_strings(block: bytes) -> list[str]:
    n = int.from_bytes(block[:4], "little")
    ends = np.cumsum(unplanes(block[4:4 + 4 * n])).tolist()
    body = block[4 + 4 * n:]
    return [body[a:b].decode() for a, b in zip([0, *ends], ends)]


def chunked(docs: DataFrame, path: str, chunk_bytes: int, ranges: int) -> DataFrame:
    """The chunk table. A chunk's pre-tokens are numbered by (range, first appearance), and its ``blocks`` hold those
    of one range each."""
    def run(batches):
        cut = Splitter(path)
        index, size, rows = _Index(), 0, []

        def flush():
            ids, n_bytes, n_added, places, times = zip(*rows)
            pieces = [p.encode() for p in index]
            of = np.fromiter((zlib.crc32(p) % ranges for p in pieces), np.int64, len(pieces))
            order = np.argsort(of, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            asked, first = np.unique(of[order], return_index=True)
            ends = [*first[1:], len(order)]
            blocks = [string_block([pieces[i] for i in order[a:b]]) for a, b in zip(first, ends)]
            widths, steps, counts = [], [], []
            for place, n in zip(places, times):
                place = rank[place]
                by = np.argsort(place)
                steps.append(np.diff(place[by], prepend=0)), counts.append(n[by]), widths.append(len(place))
            one = [[secrets.randbits(63)], [list(ids)], [list(n_bytes)], [list(n_added)], [widths],
                   [planes(np.concatenate(steps))], [planes(np.concatenate(counts))], [asked.tolist()], [blocks]]
            return batch(CHUNKS, *one)

        for rb in batches:
            for at in range(0, rb.num_rows, 256):
                part = rb.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = text or ""
                    n = len(text.encode()) if not text.isascii() else len(text)
                    if rows and size + n > chunk_bytes:
                        yield flush()
                        index, size, rows = _Index(), 0, []
                    pieces, added = cut(text)
                    place, times = np.unique(np.fromiter(map(index.__getitem__, pieces), np.uint32, len(pieces)),
                                             return_counts=True)
                    rows.append((doc_id, n, added, place, times.astype(np.uint32)))
                    size += n
        if rows:
            yield flush()

    return written(docs.mapInArrow(run, CHUNKS_SQL))


def answers(chunks: DataFrame, path: str) -> DataFrame:
    """(chunk, found): for every asked range the token counts of its block. A range's distinct pre-tokens are encoded
    once, wherever they were asked."""
    schema = pa.schema([("chunk", pa.int64()), ("asked", pa.int32()), ("found", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        tok = load(path)
        index = _Index()
        places = [np.fromiter(map(index.__getitem__, block_strings(b.as_py())), np.int64) for b in rows.column(2)]
        distinct, n = list(index), []
        for at in range(0, len(distinct), 8192):
            n += [len(e) for e in tok.encode_batch_fast(distinct[at:at + 8192], add_special_tokens=False)]
        n = np.array(n, np.int64)
        found = [planes(n[p]) for p in places]
        return pa.Table.from_batches([batch(schema, *(c.combine_chunks() for c in rows.columns[:2]), found)])

    asks = chunks.select("chunk", F.explode(F.arrays_zip("asked", "blocks")).alias("a")).select(
        "chunk", "a.asked", F.col("a.blocks").alias("block"))
    return (asks.groupBy("asked").applyInArrow(run, "chunk long, asked int, found binary")
            .groupBy("chunk").agg(F.collect_list(F.struct("asked", "found")).alias("found")))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit). ``tokenizer_path`` is a tokenizers JSON file of a
    byte-level BPE with the usual split pattern, readable on the executors."""
    docs = text_column(docs, id_col, text_col)
    ranges = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // range_bytes
    chunks = chunked(docs, tokenizer_path, chunk_bytes, ranges)
    both = chunks.drop("asked", "blocks").join(answers(chunks, tokenizer_path), "chunk", "left")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def run(batches):
        for rb in batches:
            for i in range(rb.num_rows):
                row = rb.slice(i, 1)
                doc_ids, n_bytes, added, widths = (row.column(c).flatten() for c in range(1, 5))
                widths = widths.to_numpy(zero_copy_only=False).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(widths)])
                # places rise within a document; the step at a document's start goes back to its first place
                run_up = np.concatenate([[0], np.cumsum(unplanes(row.column(5)[0].as_py()).astype(np.int64))])
                place = run_up[1:] - np.repeat(run_up[first[:-1]], widths)
                times = unplanes(row.column(6)[0].as_py()).astype(np.int64)
                found = sorted(row.column(7)[0].as_py() or [], key=lambda x: x["asked"])
                n = np.concatenate([np.zeros(0, np.int64), *(unplanes(x["found"]) for x in found)]).astype(np.int64)
                total = np.concatenate([[0], np.cumsum(n[place] * times)])
                tokens = total[first[1:]] - total[first[:-1]] + added.to_numpy(zero_copy_only=False)
                yield batch(schema, doc_ids, n_bytes, tokens, tokens > limit)

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
