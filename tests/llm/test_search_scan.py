"""Top-k search, benchmark leaks, licences, archives, language and scoring."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from llmcases import no_docs, odd_docs, ready  # noqa: F401
from pyspark.sql import functions as F

from dayfold.llm import contextmix, licences, mtree
from dayfold.llm import decontaminate as D
from dayfold.llm import queries as Q
from dayfold.llm.common import shared_dir
from dayfold.llm.contextmix import Model, score
from dayfold.llm.decontaminate import leaks
from dayfold.llm.langid import identify
from dayfold.llm.licences import scan
from dayfold.llm.mtree import top_k
from dayfold.llm.warc import read_archives, transactions, write_archives


def brute_top(rows, k, query):
    out = set()
    for q, x in rows:
        if query(q):
            best = sorted((-int(x @ y), c) for c, y in rows if c != q)[:k]
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    return out


def test_top_k_matches_brute_force(ready, monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "TREE_ROWS", 60)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 8) * rng.choice([0.2, 1, 3])) for i in range(500)]
    rows += [(1000 + i, np.full(8, 0.5)) for i in range(200)]  # one very common vector
    df = ready.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>").repartition(4)
    got = {tuple(r) for r in top_k(df, query="vec_id % 20 = 0").collect()}
    assert got == brute_top([(i, np.floor(256 * x).astype(np.int64)) for i, x in rows], 5, lambda i: i % 20 == 0)


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_queries_match_their_sql(ready, name):  # noqa: F811
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(Q.ORACLE_SQL[name])
    df = Q.QUERIES[name](ready, SF_SMALL)
    assert df.columns == [c[0] for c in cur.description]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, df.collect()), key=key) == sorted(cur.fetchall(), key=key)


def test_top_k_of_odd_rows(ready):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [2.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, [0.0, 0.0]), (8, [])]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id as pivot", "1 as v")
    assert [tuple(r) for r in top_k(df, scale=1, query="vec_id = 0").collect()] == [(0, 1, 1, 2), (0, 2, 7, 0)]
    assert top_k(df.where("false")).collect() == []


def test_archives_round_trip(ready):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5
    rows = [(1, "http://a.example/x?y=1", inner), (2, "http://b.example", inner), (3, None, None), (4, "bad url \r\n", "é" * 60),
            (5, "http://c.example/", "small"), (6, "http://c.example/", "small"), (0, "http://z.example/", "é" * 60),
            (None, "http://n.example/", inner), (7, "u", ""), (7, "u", "")]
    pages = ready.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as digest", "1 as kind")
    path = shared_dir(ready)
    write_archives(pages, path)
    got = transactions(read_archives(ready, path)).collect()
    assert sum(r.copies for r in got) == 10 and len(got) == 9
    by = {r.metadata.fields["page-id"]: r for r in got}
    assert bytes(by["1"].response.payload).decode() == inner and by["1"].response.kind == "response"
    assert by["1"].request.status == "GET /x?y=1 HTTP/1.1"
    assert by["2"].response.kind == by["none"].response.kind == "revisit" and by["2"].response.refers_to == by["1"].capture_id
    assert by["2"].response.payload_digest == by["1"].response.payload_digest and by["2"].response.payload is None
    assert by["2"].response.payload_bytes == len(inner)
    assert by["4"].response.refers_to == by["0"].capture_id
    assert by["5"].response.kind == by["6"].response.kind == "response"
    empty = shared_dir(ready)
    write_archives(pages.where("false"), empty)
    assert transactions(read_archives(ready, empty)).collect() == []


PLAIN = re.compile(r"[a-z0-9\x80-\xff]+")


def plain_words(text):
    return PLAIN.findall((text or "").encode().decode("latin1").translate({c: c + 32 for c in range(65, 91)}))


def brute_leaks(docs, items, k=5, percent=80):
    def grams(w):
        return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))

    out = {}
    for d, text in docs:
        w = plain_words(text)
        for i, item in items:
            x = plain_words(item)
            if not w or not x:
                continue
            g = grams(x)
            for s in range(max(1, len(w) - len(x) + 1)):
                h = grams(w[s:s + len(x)])
                both, every = sum((g & h).values()), sum((g | h).values())
                if 100 * both >= percent * every:
                    out[d, i] = max(out.get((d, i), (0, 0)), (both / every, -s))
    return out


def test_leaks_match_brute_force(ready):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 9, 20, 20, 45])))) for i in range(25)]
    docs = []
    for d in range(120):
        w = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            x = items[rng.randrange(len(items))][1].split()
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                x[rng.randrange(len(x))] = word()
            at = rng.randint(0, len(w))
            w[at:at] = x[:rng.choice([len(x), len(x), len(x) - 1])]
        docs.append((d, ", ".join(w).upper() if d % 3 else " ".join(w)))
    docs += [(1000, None), (1001, ""), (1002, items[3][1])]
    items += [(100, None), (101, "  "), (102, "a a a a a a a a a")]
    docs += [(1003, "b " + "a " * 40)]
    got = leaks(ready.createDataFrame(docs, "doc_id long, text string").repartition(3),
                ready.createDataFrame(items, "item_id long, text string")).collect()
    want = brute_leaks(docs, items)
    assert len(want) > 30
    assert {(r.doc_id, r.item_id): (r.similarity, -r.start_word) for r in got} == want


def test_leaks_of_odd_rows(ready, odd_docs, no_docs):
    items = ready.createDataFrame([(1, "ONE two, three four five six"), (1, "one two three four five six"), (None, "short")],
                                  "item_id long, text string").selectExpr("*", "1 as content")
    got = sorted({(r.doc_id or 0, r.item_id or 0) for r in leaks(odd_docs, items).collect()})
    assert got == [(0, 1), (1, 1), (2, 1), (6, 0), (10, 1)]
    assert leaks(no_docs, items).collect() == [] and leaks(odd_docs, items.where("false")).collect() == []


def test_unrelated_windows_rarely_meet_an_item(ready):
    """Of all pairs of one length below a tenth meet in a block, and nearly none is left to confirm."""
    rng = random.Random(8)
    texts = [(i, " ".join(f"w{rng.randint(0, 50_000)}" for _ in range(40))) for i in range(900)]
    known = D.item_table(ready.createDataFrame(texts, "item_id long, text string"), 5)
    items = known.where("item_id < 200")
    contents = known.where("item_id >= 200").selectExpr(
        "item as content", "n_words", "item_print as print", "item_print2 as print2")
    met = D.meetings(contents, items).agg(
        F.count("*").alias("n"), F.sum(F.expr(f"int(hamming <= {D.CONFIRM})")).alias("left")).first()
    assert 0 < met.n < 0.1 * 200 * 700 and met.left < 20


@pytest.mark.parametrize("n", [4, 9, 12, 20, 36, 100, 400])
def test_recall_of_the_blocks_at_the_threshold(n):
    """Item and window of n shingles that share just enough of them for 80 %: the pair meets and is confirmed."""
    rng = np.random.default_rng(n)
    share = D.need(n, n, 80)
    a = rng.integers(0, 2**63, (800, n), dtype=np.uint64) * np.uint64(2)
    b = np.concatenate([a[:, :share], rng.integers(0, 2**63, (800, n - share), dtype=np.uint64) * np.uint64(2) + np.uint64(1)], axis=1)
    apart = np.stack([x ^ y for x, y in zip(D.fingerprints(a), D.fingerprints(b))], axis=1).view(np.uint16)
    bits = np.bitwise_count(apart)
    found = (bits <= D.BLOCK_RADIUS).any(axis=1) & (bits.sum(axis=1) <= D.CONFIRM)
    assert found.mean() >= 0.99


def brute_licences(docs, templates, percent=80):
    def grams(t):
        w = plain_words(t)
        return Counter(zip(w, w[1:])) if len(w) > 1 else Counter([tuple(w)] * len(w))

    out = {}
    for d, text in docs:
        parts = [("text", -1, text or "")] + [("line", n, x) for n, x in enumerate((text or "").split("\n"))]
        for name, t in templates.items():
            g = grams(t)
            for scope, at, x in parts:
                h = grams(x)
                both, n = sum((g & h).values()), sum(h.values())
                if both and 200 * both >= percent * (n + sum(g.values())):
                    key = (2 * both / (n + sum(g.values())), n, -at)
                    out[d, name] = max(out.get((d, name), (key, "")), (key, scope))
    return {k: (v[0][0], v[0][1], -v[0][2], v[1]) for k, v in out.items()}


def test_licences_match_brute_force(ready):
    rng = random.Random(6)
    names = list(licences.NOTICES)
    docs = [(0, None), (1, ""), (2, "MIT"), (3, licences.NOTICES["MIT"]), (4, "x\n" + licences.NOTICES["MIT"].upper() + "!")]
    for d in range(5, 150):
        lines = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 5))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            w = licences.NOTICES[rng.choice(names)].split()
            if rng.random() < .5:
                w.insert(rng.randint(0, len(w)), "extra")
            lines.insert(rng.randint(0, len(lines)), " ".join(w))
        docs.append((d, "\n".join(lines)))
    got = scan(ready.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    want = brute_licences(docs, licences.NOTICES)
    assert len(want) > 80
    assert {(r.doc_id, r.licence): (r.dice, r.n_bigrams, -1 if r.line is None else r.line, r.scope) for r in got} == want


def brute_windows(docs, templates, percent=80):
    def grams(w):
        return Counter(zip(w, w[1:])) if len(w) > 1 else Counter([tuple(w)] * len(w))

    out = {}
    for d, text in docs:
        text = text or ""
        w, lines = plain_words(text), [i for i, x in enumerate(text.split("\n")) for _ in plain_words(x)]
        for name, t in templates.items():
            x = plain_words(t)
            g = grams(x)
            for s in range(len(w) - len(x) + 1):
                both = sum((g & grams(w[s:s + len(x)])).values())
                if 100 * both >= percent * sum(g.values()):
                    out[d, name] = max(out.get((d, name), (0, 0)), (both / sum(g.values()), -lines[s]))
    return out


def test_licence_windows_match_brute_force(ready):
    rng = random.Random(8)
    templates = licences.NOTICES | licences.TEXTS | {"twice": "a b a b a b c a b"}
    docs = [(0, None), (1, "Some words of another kind.\nLicensed under the Apache License,\nVersion 2.0.\nAnd more words after it."),
            (2, "It has no price at all. Released under the MIT License. So take it, use it and give it on."),
            (3, "a b " * 9 + "c a b"), (4, "Sum of it.\n\n" + licences.TEXTS["MIT text"] + "\n" + "more words " * 300)]
    for d in range(5, 100):
        w = [rng.choice("a b c the of this work is licensed under License to use".split()) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 1, 2])):
            x = templates[rng.choice(list(templates))].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                x[rng.randrange(len(x))] = "other"
            at = rng.randint(0, len(w))
            w[at:at] = x
        docs.append((d, "".join(x + rng.choice("  \n") for x in w)))
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.licence): r for r in scan(df, templates, windows=True).collect()}
    want, other = brute_windows(docs, templates), brute_licences(docs, templates)
    assert len(want) > 60 and {(1, "Apache-2.0"), (2, "MIT"), (4, "MIT text")} <= want.keys() - other.keys()
    assert got.keys() == want.keys() | other.keys()
    for key, r in got.items():
        assert r.dice == max(x[key][0] for x in (want, other) if key in x)
        if r.scope == "window":
            assert (r.dice, -r.line) == want[key]


def test_licences_of_odd_rows(odd_docs, no_docs):
    assert scan(odd_docs).collect() == [] and scan(no_docs).collect() == []
    rows = scan(odd_docs, {"s": "short", "none": " ", "n": "one two three four five six seven"}).collect()
    assert sorted((r.doc_id or 0, r.licence) for r in rows) == [(0, "n"), (1, "n"), (2, "n"), (6, "s"), (10, "n")]


def test_language_of_held_out_documents(ready):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    t = pq.read_table(f"{sf}/documents.parquet")
    lang = dict(zip(t["doc_id"].to_pylist(), t["lang"].to_pylist()))
    rows = Q.QUERIES["op9_language_id"](ready, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd_docs, no_docs):
    rows = identify(odd_docs).collect()
    assert len(rows) == 15
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, 5, 7, None}
    assert identify(no_docs).collect() == []
    assert {r.lang_pred for r in identify(odd_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def brute_base(rows):
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + ["\n"] for i, t in rows}
    learn = {i for i in tokens if zlib.crc32(str(i).encode()) % 10}
    c = Counter(w for i in learn for w in tokens[i])
    n, v = sum(c.values()), len(c)
    return {i: (i not in learn, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for i, w in tokens.items()}


def test_scores(ready):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet")
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    got = {r.doc_id: r for r in Q.QUERIES["op6_context_mixing"](ready, SF_SMALL).collect()}
    want = brute_base(rows)
    assert got.keys() == want.keys()
    for i, w in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and abs(r.base_score - w[4]) < 1e-6 * abs(w[4])
    bits = -sum(r.score for r in got.values() if r.held_out) / math.log10(2)
    size = sum(len(x.encode()) + 1 for i, x in rows if got[i].held_out)
    assert bits / size < 3.2


def test_bits_per_byte(ready):
    texts = [None, "", "é", "some text and more", "x" * 500]
    rows = score(ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        size = len((texts[r.doc_id] or "").encode()) + 1
        assert abs(r.bits_per_byte * size + r.score / math.log10(2)) < 1e-6


def test_parts_of_ranges_do_not_change_the_model(ready, monkeypatch):  # noqa: F811
    docs = ready.createDataFrame([(i, f"some text {i % 7} and {i * i} more") for i in range(60)], "doc_id long, text string")
    monkeypatch.setattr(contextmix, "MOST_RANGES", 2)
    one = sorted(map(tuple, score(docs).collect()))
    monkeypatch.setattr(contextmix, "RANGE_BYTES", 150)
    monkeypatch.setattr(contextmix, "CHUNK_BYTES", 100)
    many = sorted(map(tuple, score(docs).collect()))
    assert [r[:5] for r in one] == [r[:5] for r in many] and all(r[6] < 0 for r in many)


def test_counters_are_those_of_every_context():
    rng = np.random.default_rng(3)
    g = np.unique(rng.integers(0, 4, (3000, 6)) @ (1 << 8 * np.arange(6)) + 97).astype(np.uint64)
    n = rng.integers(0, 3, len(g))
    high, want = contextmix.Counters(g, n), Counter()
    for x, times in zip(g.tolist(), n.tolist()):
        for order in contextmix.HASHED:
            for bit in range(8):
                context = x >> 8 & (1 << 8 * order) - 1
                want[order, context, (1 << bit) | (x & 255) >> 8 - bit, x >> 7 - bit & 1] += times
    found = high.find(g)
    for bit in range(8):
        for order, got in zip(contextmix.HASHED, high.counts(found, bit, None)):
            for x, pair in zip(g.tolist(), got.tolist()):
                key = (order, x >> 8 & (1 << 8 * order) - 1, (1 << bit) | (x & 255) >> 8 - bit)
                assert pair == [want[*key, 0], want[*key, 1]]


def test_byte_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    m = Model(rng.integers(0, 9, (4, 64, 2)).astype(np.uint16), rng.integers(0, 9, 65536), 2)
    m.weights = rng.normal(0.3, 0.2, m.weights.shape).astype(np.float32)
    for context in (0, 0x6162636465, 0xFFFFFFFFFF):
        g = np.uint64(context << 8) + np.arange(256, dtype=np.uint64)
        assert abs((10 ** m.log10(g)).sum() - 1) < 1e-4


def test_scores_of_odd_rows(odd_docs, no_docs):
    rows = score(odd_docs).collect()
    assert len(rows) == 15 and all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4, 5))
    assert all(r.held_out for r in rows if r.doc_id is None) and all(r.score < 0 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert score(no_docs).collect() == []
    nothing = score(odd_docs.selectExpr("cast(null as long) as doc_id", "text")).collect()
    assert {r.train_tokens for r in nothing} == {0}


def dealt(g, ranges, parts):
    place = contextmix.place_of(g, ranges, parts)
    return np.bincount(place, minlength=ranges * parts)


def test_no_place_holds_a_frequent_byte_pair():
    rng = np.random.default_rng(5)
    g = np.unique(rng.integers(0, 2**48, 400_000, dtype=np.uint64))
    hot = rng.random(len(g)) < 0.5  # half of all grams have one byte pair before their last byte
    g[hot] = g[hot] & ~np.uint64(0xFFFF00) | np.uint64(0x206500)
    g = np.unique(g)
    for parts in (8, 32):  # as the corpus grows, so does the number of parts, and the largest place shrinks
        assert dealt(g, 16, parts).max() < 0.6 * len(g) / parts
    assert len(np.unique(contextmix.place_of(g, 16, 1))) == 16


def test_places_are_bounded_when_the_corpus_grows(ready, monkeypatch):  # noqa: F811
    monkeypatch.setattr(contextmix, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(contextmix, "GATHER", 100)
    words = "the then there these them they their thence other others mother father weather whether".split()
    rng = np.random.default_rng(2)
    rows = [(i, True, " ".join(rng.choice(words, 40))) for i in range(150)]
    docs = ready.createDataFrame(rows, "doc_id long, learn boolean, text string")
    every, size = Counter(), {}
    for _, _, text in rows:
        b = b"\xff" * 5 + text.encode() + b"\xff"
        every.update(int.from_bytes(b[i:i + 6]) for i in range(len(b) - 5))
    for parts in (1, 16):
        chunks = contextmix.chunked(docs, 2, parts, 1)
        sent = chunks.where("place is not null").groupBy("place").agg({"block": "count"}).collect()
        assert {r.place // parts for r in sent} == {0, 1}
        counted = contextmix.gathered(chunks, parts).collect()
        got, size[parts] = Counter(), max(len(r.block) for r in counted)
        for r in counted:
            g, n = contextmix.unblock(r.block)
            assert (np.diff(g.astype(np.int64)) > 0).all() and (r.near is None) == (parts == 1)
            got.update(dict(zip(g.tolist(), n.tolist())))
        assert got == every
    assert size[16] < size[1] / 2


def test_parts_have_the_counters_of_their_whole_range(ready, monkeypatch):  # noqa: F811
    docs = ready.createDataFrame([(i, i % 5 > 0, f"other texts {i % 7} and {i * i} more, the others é {i}") for i in range(80)],
                                 "doc_id long, learn boolean, text string")
    monkeypatch.setattr(contextmix, "CHUNK_BYTES", 300)
    chunks = contextmix.chunked(docs, 2, 5, 1)
    t = contextmix.gathered(chunks, 5).toArrow()
    rows = [(place.as_py(), *contextmix.unblock(b.as_buffer()), contextmix.near_of(near))
            for place, b, near in zip(t["place"], t["block"], t["near"])]
    whole = {}
    for half in (0, 1):
        g, n = contextmix.merged(*(np.concatenate(x) for x in zip(*[(g, n) for p, g, n, _ in rows if p // 5 == half])))
        whole[half] = g, contextmix.Counters(g, n)
    assert len(rows) > 5 and any(n.sum() for _, _, n, _ in rows)
    for place, g, n, near in rows:
        mine, theirs = contextmix.Counters(g, n, near), whole[place // 5][1]
        at, found = mine.find(g), theirs.find(g)
        for bit in range(8):
            for a, b in zip(mine.counts(at, bit, None), theirs.counts(found, bit, None)):
                assert (a == b).all()


def test_sums_of_more_than_32_bits():
    k, n = np.array([3, 2**33, 2**47], np.uint64), np.array([0, 2**32 + 5, 2**50], np.int64)
    assert [x.tolist() for x in contextmix.unblock_sums(contextmix.sums_block(k, n))] == [k.tolist(), n.tolist()]


def test_texts_of_chunks_stay_where_they_were_written(ready):  # noqa: F811
    docs = ready.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string")
    plan = score(docs)._jdf.queryExecution().executedPlan().toString()
    exchanged = [x for x in re.split(r"\n", plan) if "Exchange" in x]
    assert len(exchanged) == 1 and "texts" not in "".join(exchanged)
