"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from llmcases import no_docs, odd_docs, ready  # noqa: F401
from pyspark.sql import functions as F

from dayfold.llm import queries as Q
from dayfold.llm import minhash, suffixes
from dayfold.llm import bitmap, graph
from dayfold.llm.graph import components
from dayfold.llm.minhash import near_duplicates
from dayfold.llm.suffixes import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_classes(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def edited_copies(n, seed):
    """A star of copies with few to many edits, exact copies, a chain of slow drift, and unrelated texts."""
    rng = random.Random(seed)
    words = [f"w{rng.randint(0, 300)}" for _ in range(120)]
    out = []
    for i in range(n):
        w = list(words)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 9])):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 40)}"
        out.append(" ".join(w))
    drift = list(words)
    for i in range(20):
        drift[5 * i] = f"d{i}"
        out.append(" ".join(drift))
    out += [" ".join(f"u{rng.randint(0, 50)}" for _ in range(rng.randint(0, 40))) for _ in range(40)]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_classes_of_edited_copies(ready, monkeypatch, k, percent):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = edited_copies(120, k) + [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b"), (1004, "a b c")]
    df = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k, percent, miss=1e-6).collect()}
    assert got == brute_classes(rows, k, percent)


def form_letters(n, seed, slots, values):
    """Letters of 120 words that differ only in ``slots`` words of ``values`` each: nothing in them is rare."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        w = list(words)
        for q in range(slots):
            w[7 + q * 113 // slots] = f"s{q}x{rng.randrange(values)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("slots,values", [(4, 41), (5, 3), (8, 6)])
def test_form_letters_match_brute_force(ready, monkeypatch, slots, values):
    """Pairs on both sides of the threshold that meet nearly always; with the parameters of the pipeline and the query."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = form_letters(160, slots, slots, values)
    df = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for k, percent in ((5, 80), (3, 85)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k, percent).collect()}
        want = brute_classes(rows, k, percent)
        assert got == want


def test_prefix_join_finds_every_link(ready, monkeypatch):
    """All linked pairs of different components, and only these, whatever the blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(4)
    sets = [(i, sorted(rng.sample(range(26), rng.randint(1, 24)))) for i in range(150)]
    df = ready.createDataFrame(sets, "node long, shingles array<long>").repartition(3)
    some = df.withColumn("root", F.when(df.node % 3 > 0, 100).otherwise(df.node % 50))
    got = {(r.u, r.v) for r in minhash._rest(minhash._prefixes(some, 70), df, 70).collect()}
    want = {(i, j) for i, a in sets for j, b in sets
            if i < j and (i % 3 == 0 and (j % 3 > 0 or i % 50 != j % 50) or i % 3 > 0 and j % 3 == 0) and 100 * len({*a} & {*b}) >= 70 * len({*a} | {*b})}
    assert got == want and len(want) > 20


def test_few_form_letters_reach_the_prefix_join(ready, monkeypatch):
    """4,000 letters that all end in one class: the stars connect them, and the last turn compares next to nothing."""
    left = []
    rest = minhash._rest

    def counted(prefix, sets, percent):
        parts = prefix.groupBy("s", "root").count().groupBy("s").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
        left.append(parts.agg(F.sum(F.expr("n * (n - most)"))).first()[0] or 0)
        return rest(prefix, sets, percent)

    monkeypatch.setattr(minhash, "_rest", counted)
    df = ready.createDataFrame(form_letters(4000, 4, 4, 41), "doc_id long, text string").repartition(4)
    rows = near_duplicates(df).collect()
    assert {r.component_id for r in rows} == {0} and len(rows) == 4000
    assert sum(left) < 4000 * 50


def test_query_matches_brute_force(ready):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet")
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in Q.QUERIES["op10_minhash_near_dedup"](ready, SF_SMALL).collect()}
    assert got == brute_classes(rows, 3, 85)


def test_classes_of_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == 15
    copies = [r for r in rows if r.n_shingles == 3]
    assert len(copies) == 5 and {r.component_id for r in copies} == {1}
    assert sorted((r.doc_id or 0, r.kept) for r in copies) == [(0, False), (1, True), (2, False), (10, False), (10, False)]
    assert all(r.kept and r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert near_duplicates(no_docs).collect() == []


def test_components_of_a_hub_and_a_chain(ready):
    edges = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (5, 6)]
    got = {r.node: r.root for r in components(ready.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(300)}, **{1000 + i: 1000 for i in range(61)}}


def brute_removal(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def removed(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_removal_matches_brute_force(ready, monkeypatch, small):
    if small:  # many chunks, ranges and buckets, and hot leading bytes
        for name, value in (("CHUNK_BYTES", 2000), ("RANGE_BYTES", 3000), ("BUCKET_BYTES", 1500), ("SAMPLE_CHUNK", 512)):
            monkeypatch.setattr(suffixes, name, value)
    rng = random.Random(3)
    base = "".join(rng.choice("abcde fgh") for _ in range(400))
    rows = []
    for i in range(200):
        a, kind = rng.randint(0, 300), rng.random()
        rows.append((i, base[a:a + rng.randint(30, 200)] if kind < .3 else
                     f"x{i}q" + base[a:a + rng.randint(45, 100)] + f"é{i}" + base[:60] if kind < .5 else
                     "ab" * rng.randint(0, 80) if kind < .6 else base if kind < .7 else
                     "".join(rng.choice("abc") for _ in range(rng.randint(0, 200)))))
    rows += [(1000, None), (1001, ""), (1002, "z" * 5000), (1003, "z" * 49), (1004, "z" * 50)]
    df = ready.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df) == brute_removal(rows)


def test_removal_query_matches_brute_force(ready):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet")
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in Q.QUERIES["op7_suffix_dedup"](ready, SF_SMALL).collect()}
    assert got == brute_removal(rows)


def test_removal_of_odd_rows(odd_docs, no_docs):
    rows = remove_repeats(odd_docs, with_text=True).collect()
    assert len(rows) == 15 and all(r.n_removed == 0 and r.kept == b"" for r in rows if r.n_bytes == 0)
    assert sum(r.n_removed for r in rows if r.doc_id != 9) == 0
    assert remove_repeats(no_docs).collect() == []


def test_an_id_that_repeats_is_one_document(ready):
    text = "".join(chr(97 + i * i % 26) for i in range(90))
    df = ready.createDataFrame([(5, text), (5, text), (None, text), (6, text)], "doc_id long, text string")
    assert sorted((r.doc_id or 99, r.n_removed) for r in remove_repeats(df).collect()) == [(5, 0), (5, 0), (6, 90), (99, 90)]


def test_a_round_of_components_is_one_query(ready, monkeypatch):
    """A forest of stars takes one round, one write; a round has no second query that looks for changes."""
    rounds, seen = [], graph.written_observed
    monkeypatch.setattr(graph, "written_observed", lambda *a: rounds.append(1) or seen(*a))
    star = ready.createDataFrame([(i, i % 3) for i in range(3, 90)] + [(5, 5), (None, 1)], "u long, v long")
    sc = ready.sparkContext
    sc.setJobGroup("one star", "")
    got = graph.parents(star)
    jobs = sc.statusTracker().getJobIdsForGroup("one star")
    sc.setJobGroup("other", "")
    assert {(r.node, r.root) for r in got.collect()} == {(i, i % 3) for i in range(3, 90)} and got.count() == 87
    assert len(rounds) == 1 and len(jobs) <= 8
    assert graph.parents(star.limit(0)).collect() == []


def test_bounds_of_candidates_are_not_joined_by_every_star(ready, monkeypatch):
    """However many stars follow: the join that bounds a bucket's members is made twice."""
    calls, possible = [], minhash._possible
    monkeypatch.setattr(minhash, "_possible", lambda *a: calls.append(1) or possible(*a))
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = form_letters(120, 8, 8, 6)
    got = {r.doc_id: r.component_id for r in near_duplicates(
        ready.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {i: c for i, (_, c, _) in brute_classes(rows, 3, 85).items()}
    assert len(calls) == 2


def test_bitmap_takes_no_job_per_partition(ready):
    """Its pages come in one go, whatever the number of partitions."""
    sc = ready.sparkContext
    sc.setJobGroup("bitmap", "")
    bits = bitmap.bitmap_of(ready.range(0, 4000, 7).withColumnRenamed("id", "h"))
    jobs = sc.statusTracker().getJobIdsForGroup("bitmap")
    sc.setJobGroup("other", "")
    assert bitmap.in_bitmap(bits, np.arange(0, 4000, 7)).all() and len(jobs) <= 3


def test_shingles_of_the_same_sets_are_compared_once(ready):
    """Two long sets that share 400 shingles, and a third that has 5 of them: two families, and the same links."""
    rows = [(1, 10, s) for s in range(400)] + [(2, 20, s) for s in range(400)] + [(3, 30, s) for s in range(5)]
    prefix = ready.createDataFrame([(u, r, 400, s) for u, r, s in rows], "node long, root long, n int, s long").repartition(3)
    got = minhash._once(prefix)
    families = {frozenset(r.nodes) for r in got.groupBy("s").agg(F.collect_list("node").alias("nodes")).collect()}
    assert families == {frozenset({1, 2, 3}), frozenset({1, 2})} and got.count() == 5


def test_bounds_of_a_bucket_give_each_member_once(ready):
    """However large a bucket is, its bound adds no rows; members that can't be linked to any size in it go."""
    rng = random.Random(8)
    members = [(key, node) for key in range(6) for node in rng.sample(range(60), 30)]
    n = {i: rng.randint(10, 40) for i in range(60)}
    own = {i: rng.randint(1, 9) for i in range(0, 60, 2)}
    root = {i: i % 7 if i > 6 else i for i in range(60)}
    m = ready.createDataFrame(members, "key long, node long")
    mixed = minhash._mixed(m, ready.createDataFrame([*n.items()], "node long, n long"),
                           ready.createDataFrame([x for x in root.items() if x[0] > 6], "node long, root long"))
    got = minhash._possible(mixed, ready.createDataFrame([*own.items()], "node long, own long"), 80)
    least = {key: min(n[i] for k, i in members if k == key) for key in range(6)}
    want = [(k, i, root[i], n[i], own.get(i, 0)) for k, i in members
            if 100 * (n[i] - own.get(i, 0)) >= 80 * (own.get(i, 0) + max(least[k], n[i] - own.get(i, 0)))]
    assert sorted((r.key, r.node, r.root, r.n, r.own) for r in got.collect()) == sorted(want) and 0 < len(want) < len(members)


def test_a_bucket_of_windows_takes_few_times_its_bytes():
    """Where frequent leading bytes are sent window by window, each window comes with all its bytes."""
    n, length = 10_000, 200
    rng = np.random.default_rng(5)
    blob = np.tile(rng.integers(0, 256, 100 * length, dtype=np.uint8), n // 100)
    tracemalloc.start()
    low, windows = suffixes.smallest_ids(blob, np.full(n, length), np.full(n, 40), np.arange(n), length)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert low.tolist() == [i % 100 for i in range(n)] and windows.tolist() == [1] * n
    assert peak < 8 * len(blob)


def test_rows_are_split_by_a_bitmap_of_ids(ready):
    docs = ready.createDataFrame([(None if i == 7 else i, f"t{i}") for i in range(3000)], "doc_id long, text string")
    clear, others = bitmap.split_by_id(docs.repartition(3), ready.range(0, 3000, 100).withColumnRenamed("id", "h"))
    left, gone = ({r.text for r in x.collect()} for x in (clear, others))
    assert not left & gone and len(left | gone) == 3000 and {"t7", *(f"t{i}" for i in range(0, 3000, 100))} <= gone
    assert len(gone) < 60
