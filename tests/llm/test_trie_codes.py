"""Prefix trie, document fingerprints and vector codes against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from llmcases import no_docs, odd_docs, ready  # noqa: F401
from conftest import SF_SMALL
from helpers import canon, spark_rows
from dayfold.llm import queries as Q
from dayfold.llm.oph import Sketch, fingerprints, likeness, spliced
from dayfold.llm.trie import coded_turns, end_digests, prefix_trie
from dayfold.llm.vectorcode import Slices, encode, integers, sum_by_label


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_slice_codes"])
def test_sql(ready, duck, name):
    df = Q.QUERIES[name](ready, SF_SMALL)
    cur = duck.execute(Q.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert spark_rows(df) == canon(cur.fetchall(), cols)


# --- trie ---------------------------------------------------------------------------------------------------------

def brute_trie(convs):
    """conv -> list of (role, text); node rows keyed by path."""
    nodes = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in nodes)]
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        out[path] = (min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                     sum(len(p) == len(path) + 1 for p in below), len(leaves),
                     sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                     hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=repr)


def trie_rows(nodes, ends):
    rows = nodes.join(end_digests(ends), "node", "left").drop("node").collect()
    return sorted((tuple(r[:-1]) + (r[-1] or hashlib.sha256().hexdigest(),) for r in rows), key=repr)


@pytest.mark.parametrize("shard", [(1, 1 << 17), (7, 1 << 17), (1000, 20), (1000, 1 << 17)])
def test_trie_is_the_same_for_any_shards(ready, shard):
    rng = random.Random(3)
    convs = {}
    for c in range(-30, 130):
        turns = [("user" if d % 2 else "bot", f"é{rng.randint(0, 1)}") for d in range(rng.choice([1, 1, 2, 5, 9]))]
        convs[c] = [("user", "hi")] + turns if c % 3 else turns
    convs |= {500 + i: convs[1] for i in range(60)}  # one conversation that many repeat
    convs[700] = [("user", f"turn {i}") for i in range(300)]
    rows = [(c, d, r, t) for c, turns in convs.items() for d, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert trie_rows(*prefix_trie(coded_turns(df), *shard)) == brute_trie(convs)


def test_rebuilt_conversations_of_odd_rows(ready, tmp_path):
    rows = [(0, 0, "user", "a"), (0, 1, "bot", "b"), (0, None, None, None), (1, 5, "user", "a"), (1, 5, "user", "b"),
            (3, 1, None, "x" * 70_000), (3, 2, "", ""), (3, 2, "", ""), (None, 1, "user", "lost"), (10, 1, "u", "é"),
            (11, 0, "u", "é"), (12, 7, None, ""), (27, 0, "u", "only"), (28, 1, "u", "only")]
    df = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.selectExpr("*", "1 as node", "2 as shard", "3 as code").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    own = collections.defaultdict(list)
    code = lambda t: hashlib.sha256(f"{len(t[0].encode())}:{t[0]}{t[1]}".encode()).digest()[:16]
    for c, turn, r, t in rows:
        if c is not None:
            own[c].append((-1 if turn is None else turn, (r or "", t or "")))
    own = {c: [t for _, t in sorted(x, key=lambda y: (y[0], code(y[1])))] for c, x in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    rebuilt = {c: own.get(c - c % 5, [])[:h[c]] + own[c][h[c]:] for c in own}
    assert [] in rebuilt.values()  # a conversation without turns ends at the root
    got = sorted((tuple(r) for r in Q.op11_prefix_trie(ready, str(tmp_path)).collect()), key=repr)
    assert got == brute_trie(rebuilt)


def test_trie_of_nothing(ready, tmp_path):
    ready.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    assert Q.op11_prefix_trie(ready, str(tmp_path)).collect() == []


# --- fingerprints -------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_likeness_estimates_jaccard(ready):
    rng = random.Random(5)
    pairs = []
    for n in (40, 300, 3000):
        for changed in (0, 0.05, 0.2, 0.5, 1):
            for _ in range(4):
                a = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
                b = a[:int(n * (1 - changed))] + [f"v{rng.randint(0, 10**6)}" for _ in range(int(n * changed))]
                pairs.append((len(pairs), " ".join(a), " ".join(b)))
    df = ready.createDataFrame(pairs, "id long, a string, b string").repartition(3)
    rows = likeness(fingerprints(fingerprints(df, text_col="a", name="x"), text_col="b", name="y"), "x", "y").collect()
    assert len(rows) == len(pairs)
    errors = []
    for r in rows:
        a, b = shingles(r.a), shingles(r.b)
        j = len(a & b) / len(a | b)
        m = 1 / 16 + 15 / 16 * j
        assert abs(r.likeness - j) <= 5 * math.sqrt(m * (1 - m) / 256) / (15 / 16)
        errors.append(r.likeness - j)
        assert (r.a == r.b) <= (r.x == r.y and r.likeness == 1)
    assert abs(np.mean(errors)) < 0.01  # no bias, also where most bins had to be filled


def test_empty_bins_are_filled_alike():
    sketch = Sketch(bins=64, bits=8)
    prints = sketch(pa.array(["one", "ONE", "one two three", "", None, " \n", "x y z a b c", "x y z a b d"]))
    assert prints[0] == prints[1] != prints[2] and len(prints[2]) == 64
    assert prints[3] == prints[4] == prints[5] == b""
    assert sketch.likeness([b"", b"", prints[0]], [b"", prints[0], prints[1]]).tolist() == [1, 0, 1]
    # two shingles each, one in common: the donors of empty bins are spread over both
    near = np.mean([Sketch(64, 8, seed=s).likeness(*([p] for p in Sketch(64, 8, seed=s)(
        pa.array(["x y z a b c", "x y z a b d"]))))[0] for s in range(200)])
    assert 0.27 < near < 0.40


def test_spliced_order_over_many_ranges(ready):
    rng = random.Random(8)
    rows = [(3 * i - 50, "".join(rng.choice("ab é\U0001f600") for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(150)]
    rows[7] = (rows[7][0], None)
    rows[9] = (rows[9][0], "long " * 60_000)
    df = ready.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string").repartition(4)
    old = ready.conf.get("spark.sql.shuffle.partitions")
    ready.conf.set("spark.sql.shuffle.partitions", "13")
    got = {r.doc_id: r for r in spliced(df).collect()}
    ready.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == len(rows)
    sketch = Sketch()
    for (i, text), (j, after) in zip(rows, rows[1:] + rows[:1]):
        text, after, r = text or "", after or "", got[i]
        n = len(text) // 4
        edited = text[:len(text) - n] + after[:n]
        marks = sketch(pa.array([text, edited, after]))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (bytes(r.fingerprint), bytes(r.edited_fingerprint)) == (marks[0], marks[1])
        assert r.near_edited == sketch.likeness(marks[:1], marks[1:2])[0]
        assert r.near_next == sketch.likeness(marks[:1], marks[2:])[0]


def test_spliced_odd_rows(ready, odd_docs, no_docs):
    rows = spliced(odd_docs.selectExpr("*", "1 as part", "2 as kind", "3 as tie")).collect()
    assert len(rows) == odd_docs.count()
    of = collections.defaultdict(set)
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for r in rows:
        if r.doc_id is not None:
            assert r.n_chars == len(texts[r.doc_id])
            of[texts[r.doc_id]].add(bytes(r.fingerprint))
    assert all(len(x) == 1 for x in of.values())
    assert spliced(no_docs).collect() == [] and fingerprints(no_docs).collect() == []
    assert spliced(odd_docs.where("doc_id = 1")).first().near_next == 1  # the only document follows itself
    wide = fingerprints(odd_docs.selectExpr("*", "'old' as fingerprint")).collect()
    assert len(wide) == odd_docs.count() and all(bytes(r.fingerprint) != b"old" for r in wide)


# --- vector codes ---------------------------------------------------------------------------------------------------

def brute_codes(rows, scale, parts, entries, rounds):
    usable = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(scale * x) for x in v], label))
    sizes = collections.Counter(len(v) for _, v, _ in usable if len(v) % parts == 0)
    dims = max(sizes, key=lambda n: (sizes[n], n)) if sizes else 0
    fits = sorted((r for r in usable if len(r[1]) == dims), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dims // parts
    cut = lambda v: [v[p * w:(p + 1) * w] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in fits[:entries]] for p in range(parts)]
    find = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = collections.defaultdict(list)
            for _, v, _ in fits:
                of[find(cut(v)[p], books[p])[1]].append(cut(v)[p])
            for n, xs in of.items():
                books[p][n] = [sum(c) // len(xs) for c in zip(*xs)]
    out, total = [], collections.defaultdict(lambda: None)
    for i, v, label in usable:
        hits = [find(x, b) for x, b in zip(cut(v), books)] if len(v) == dims else None
        error = sum(d for d, _ in hits) if hits else None
        out.append((i, [n for _, n in hits] if hits else None, error, label))
        if hits:
            total[label] = (total[label] or 0) + error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((*r[:3], total[r[3]]) for r in out), key=repr), sha


@pytest.mark.parametrize("entries,rounds", [(8, 4), (200, 2), (256, 1)])
def test_codes_of_odd_rows(ready, entries, rounds):
    rng = random.Random(entries)
    centers = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centers)], rng.choice([None, 1, 1, 1, 2])) for i in range(300)]
    rows += [(i, [0.25] * 6, 7) for i in range(400, 500)] + [(3, rows[3][1], 9), (None, [0.5] * 6, None)]
    rows += [(600, None, 1), (601, [], 1), (602, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (603, [float("nan")] * 6, 1),
             (604, [float("inf")] + [0.0] * 5, 1), (605, [1.0] * 4, 11), (606, [2.0] * 5, 1), (607, [1e5] * 6, 3)]
    df = ready.createDataFrame([(i, v, n, 0) for i, v, n in rows], "vec_id long, embedding array<double>, label int, codes int")
    coded, books = encode(df.repartition(4), 64, 2, entries, rounds)
    got = sum_by_label(coded, "error", "label", "label_error").select("vec_id", "codes", "error", "label_error").collect()
    want, sha = brute_codes(rows, 64, 2, entries, rounds)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert books.sha256() == sha


def test_nearest_entry_and_work_saved():
    rng = np.random.default_rng(2)
    for spread, most in ((3, 0.05), (300, 1.0)):  # clustered, and without any structure
        entries = rng.integers(-300, 300, (256, 16))
        x = entries[rng.integers(0, 256, 3000)] + rng.integers(-spread, spread + 1, (3000, 16))
        entries[200] = entries[7]  # equal entries: the lower index
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        for radius in (1, 50, 100_000):
            at, low, measured = Slices(entries).nearest(x, radius)
            assert (at == d.argmin(axis=1)).all() and (low == d.min(axis=1)).all()
        _, _, measured = Slices(entries).nearest(x, int(np.sqrt(np.median(d.min(axis=1)))))
        print(f"spread {spread}: {measured / d.size:.3f} of all distances")
        assert measured <= most * d.size


def test_vectors_out_of_range_and_empty(ready):
    schema = "vec_id long, embedding array<float>, label int"
    coded, books = encode(ready.createDataFrame([], schema))
    assert coded.collect() == [] and books is None
    assert sum_by_label(coded, "error", "label", "label_error").collect() == []
    odd = ready.createDataFrame([(1, [1.0, 2.0, 3.0], 4)], schema)  # no length that the parts divide
    assert [tuple(r) for r in encode(odd)[0].collect()] == [(1, 4, None, None)]
    with pytest.raises(Exception, match="beyond"):
        integers(ready.createDataFrame([(1, [1e30] * 4, 4)], schema), 1024, "vec_id", "embedding", "label").collect()
