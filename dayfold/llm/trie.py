"""Conversation prefix trie by vertical bitmaps.

Conversations are reduced, before they move, to one row per turn: a 128-bit code of (role, text) and the text's bytes.
Ranges of conversation ids become shards of bounded size. A shard is indexed vertically: for every (position, turn) the
bitset of its conversations that have this turn there, and for every length the bitset of those that end there. A
depth-first walk starts with all of the shard's conversations; a node's bitset intersected with the postings of the next
position yields its children, popcounts are their members, and the intersection with the lengths is the node's end list.

A node is named by a hash of its path, so shards agree on it. Shards then exchange one row per node and shard (a first
turn that all conversations share costs one row a shard): every node learns its members, its smallest member and whether
it goes on anywhere. The shard with a node's smallest member owns it. Each node's children, leaves and savings are
counted where it is owned and summed up along the shard's own walk; nodes that lie in several shards add up what their
shards found. No node's children or members are gathered in one task.

A shard holds whole conversations, so one conversation's turns (about 100 bytes each, without texts) have to fit in a
task.

Defined results: turns are ordered by turn number (null first), repeated numbers by the turn's code; a null role or text
is an empty one; rows without a conversation id belong to no conversation and are ignored; repeated rows are turns like
others; other columns are ignored; an empty table gives an empty result. Turns are told apart by the first 128 bits of a
SHA-256 of role and text.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, spread, written

#: A shard has at most so many conversations, and turns (a longer conversation is a shard of its own).
CONVERSATIONS, TURNS = 2048, 1 << 17


def coded_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """(conv_id, pos, code, n_bytes): every turn of every conversation, positions from 1."""
    role, text = (f"coalesce(cast(`{c}` as string), '')" for c in (role_col, text_col))
    turns = conversations.selectExpr(
        f"cast(`{id_col}` as long) as conv_id", f"cast(`{turn_col}` as long) as turn",
        f"unhex(substring(sha2(concat(octet_length({role}), ':', {role}, {text}), 256), 1, 32)) as code",
        f"cast(octet_length({text}) as long) as n_bytes").where("conv_id is not null")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "code"))
    return turns.select("conv_id", place.alias("pos"), "code", "n_bytes")


class Shard:
    """Vertical index of some conversations: (id, turn codes, bytes of each turn), ids rising."""

    def __init__(self, conversations: list[tuple[int, list[bytes], list[int]]]):
        self.conversations = conversations
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ends: dict[int, int] = {}
        for i, (_, codes, _) in enumerate(conversations):
            one = 1 << i
            for key in enumerate(codes):
                self.postings[key] = self.postings.get(key, 0) | one
            self.ends[len(codes)] = self.ends.get(len(codes), 0) | one

    def nodes(self):
        """(parent's number, depth, node, n_bytes, members, first member's id, goes on, end list), parents first."""
        todo = [((1 << len(self.conversations)) - 1, 0, -1, bytes(16), 0)]
        n = 0
        while todo:
            members, depth, parent, node, n_bytes = todo.pop()
            first = (members & -members).bit_length() - 1
            here = members & self.ends.get(depth, 0)
            ended, rest, ids = here, members ^ here, []
            while ended:
                low = ended & -ended
                ids.append(self.conversations[low.bit_length() - 1][0])
                ended ^= low
            yield parent, depth, node, n_bytes, members.bit_count(), self.conversations[first][0], rest > 0, ids
            while rest:
                _, codes, sizes = self.conversations[(rest & -rest).bit_length() - 1]
                child = rest & self.postings[depth, codes[depth]]
                rest ^= child
                path = hashlib.blake2b(node + codes[depth], digest_size=16).digest()
                todo.append((child, depth + 1, n, path, sizes[depth]))
            n += 1


NODES = pa.schema([("shard", pa.int64()), ("idx", pa.int32()), ("parent", pa.int32()), ("depth", pa.int64()),
                   ("node", pa.binary()), ("n_bytes", pa.int64()), ("n_convs", pa.int64()), ("conv_id", pa.int64()),
                   ("inner", pa.bool_()), ("ends", pa.list_(pa.int64()))])
NODES_SQL = ("shard long, idx int, parent int, depth long, node binary, n_bytes long, n_convs long, conv_id long, "
             "inner boolean, ends array<long>")
FOUND = pa.schema([("shard", pa.int64()), ("node", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                   ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                   ("n_leaves", pa.int64()), ("saved", pa.int64()), ("whole", pa.bool_()), ("ends", pa.list_(pa.int64()))])
FOUND_SQL = ("shard long, node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
             "n_leaves long, saved long, whole boolean, ends array<long>")


def shard_nodes(turns: DataFrame, conversations: int, limit: int) -> DataFrame:
    """The nodes of every shard's walk. ``turns``: (conv_id, pos, code, n_bytes), a null code for no turn."""
    def run(batches):
        held, n = [], 0

        def flush():
            rows = list(Shard(held).nodes())
            for a in range(0, len(rows), 8192):
                part = rows[a:a + 8192]
                yield batch(NODES, [held[0][0]] * len(part), range(a, a + len(part)), *zip(*part))

        for rb in batches:
            for conv, code, size in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2).to_pylist()):
                if not held or held[-1][0] != conv:
                    if held and (len(held) >= conversations or n >= limit):
                        yield from flush()
                        held, n = [], 0
                    held.append((conv, [], []))
                if code is not None:
                    held[-1][1].append(code)
                    held[-1][2].append(size)
                    n += 1
        if held:
            yield from flush()

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id", F.col("pos").asc_nulls_first())
    return ordered.select("conv_id", "code", "n_bytes").mapInArrow(run, NODES_SQL)


def _counted(batches):
    """Subtree counts of each shard's nodes (sorted by shard and number), over the nodes that the shard owns."""
    def count(shard, rows):
        parent, depth, node, n_bytes, here, mine, everywhere, first, inner, ends = zip(*rows)
        children, leaves, saved = ([0] * len(rows) for _ in range(3))
        for i in range(len(rows) - 1, -1, -1):
            if mine[i] == first[i]:  # this shard has the node's smallest member
                leaves[i] += not inner[i]
                saved[i] += (everywhere[i] - 1) * n_bytes[i]
                if i:
                    children[parent[i]] += 1
            if i:
                leaves[parent[i]] += leaves[i]
                saved[parent[i]] += saved[i]
        up = [first[p] if p >= 0 else None for p in parent]
        whole = [a == b for a, b in zip(here, everywhere)]
        for a in range(0, len(rows), 8192):
            b = slice(a, a + 8192)
            yield batch(FOUND, [shard] * len(node[b]), node[b], first[b], depth[b], up[b], everywhere[b], children[b],
                        leaves[b], saved[b], whole[b], ends[b])

    shard, rows = None, []
    for rb in batches:
        columns = [c.to_pylist() for c in rb.columns]
        for s, *row in zip(*columns):
            if s != shard and rows:
                yield from count(shard, rows)
                rows = []
            shard = s
            rows.append(row)
    if rows:
        yield from count(shard, rows)


def prefix_trie(turns: DataFrame, conversations: int = CONVERSATIONS, limit: int = TURNS) -> tuple[DataFrame, DataFrame]:
    """The trie of ``turns`` (conv_id, pos, code, n_bytes, as from ``coded_turns``; a row with a null code stands for its
    conversation only, so that one without turns can end at the root).

    Returns the nodes (node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) and their end
    lists (node, shard, ends), one row per shard with conversations that end there; ascending shards hold ascending
    ids."""
    local = shard_nodes(turns, conversations, limit)
    same = Window.partitionBy("node")
    known = local.select("shard", "idx", "parent", "depth", "node", "n_bytes", "n_convs", "conv_id",
                         F.sum("n_convs").over(same).alias("everywhere"), F.min("conv_id").over(same).alias("first"),
                         F.max("inner").over(same).alias("inner"), "ends")
    known = spread(known, "shard").sortWithinPartitions("shard", "idx").drop("idx")
    found = written(known.mapInArrow(_counted, FOUND_SQL))
    columns = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    fixed, added = columns[1:5], columns[5:]
    shared = found.where("not whole").groupBy("node").agg(*[F.max(c).alias(c) for c in fixed],
                                                          *[F.sum(c).alias(c) for c in added])
    nodes = found.where("whole").select(*columns).unionByName(shared.select(*columns))
    return (nodes.withColumnRenamed("saved", "saved_tokens"),
            found.where("size(ends) > 0").select("node", "shard", "ends"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's end list, ids in decimal with commas between. Lists are streamed shard
    by shard, so a node where a third of all conversations end is never held."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches):
        node, digest = None, None
        for rb in batches:
            done = []
            for key, ids in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                text = ",".join(map(str, ids)).encode()
                if key == node:
                    digest.update(b"," + text)
                    continue
                if digest is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(text)
            if done:
                yield batch(schema, *zip(*done))
        if digest is not None:
            yield batch(schema, [node], [digest.hexdigest()])

    ordered = spread(ends, "node").sortWithinPartitions("node", "shard").select("node", "ends")
    return ordered.mapInArrow(run, "node binary, ends_sha256 string")
