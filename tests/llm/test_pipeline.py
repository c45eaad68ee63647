"""The pipeline's stages on planted cases, against brute force, and on odd tables."""

import random

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from llmcases import no_docs, odd_docs, ready  # noqa: F401
from test_counting_packing import check_pieces
from test_dedup import brute_classes, brute_removal
from test_search_scan import brute_leaks

import __spark_entry__ as E
import corpus_pipeline as P

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def frame(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "minhash_near_dedup", "suffix_dedup", "decontaminate", "packing"]
    assert E.queries()["pipeline"] is P.run


def test_planted_cases(ready):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def prose(n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n)) + "."

    item = pq.read_table(f"{SF_SMALL}/benchmark.parquet")["text"][0].as_py()
    passage = prose(60)
    clean = [prose(rng.randint(1, 200)) for _ in range(20)]
    base = prose(200).split()
    near = list(base)
    near[50] = "zzz"
    texts = [*enumerate(clean), (100, None), (101, "12 !?"), (200, " ".join(base)), (201, " ".join(near)), (202, " ".join(base)),
             (300, prose(50) + " " + passage + " é " + prose(50)), (301, prose(80) + " é" + passage + "ü " + prose(10)),
             (302, passage), (400, prose(40) + " " + item + " " + prose(30)), (401, item.upper())]
    docs = frame(ready, texts)
    for _, stage in P.STAGES[:-1]:
        docs = P.written(stage(ready, docs, SF_SMALL))
        assert docs.columns == COLUMNS
    left = {r.doc_id: r for r in docs.collect()}
    assert set(left) == {*range(20), 200, 300, 301}
    assert all(left[i].text == t for i, t in texts if i < 20 or i in (200, 300))
    assert all(r.n_chars == len(r.text) for r in left.values())
    assert passage[20:-20] not in left[301].text and "ü" in left[301].text
    pieces = P.STAGES[-1][1](ready, docs, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == set(left)


def brute(rows, items):
    """The pipeline's documents by brute force: letters, classes, passages, leaks."""
    rows = [(i, t) for i, t in rows if t is not None and any(c.isalpha() for c in t)]
    kept = brute_classes(rows, 5, 80)
    rows = [(i, t) for i, t in rows if kept[i][2]]
    removed = brute_removal(rows, P.PASSAGE_BYTES)
    first = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - P.PASSAGE_BYTES + 1):
            w = b[p:p + P.PASSAGE_BYTES]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - P.PASSAGE_BYTES + 1):
            if first[b[p:p + P.PASSAGE_BYTES]] < i:
                gone[p:p + P.PASSAGE_BYTES] = b"\1" * P.PASSAGE_BYTES
        assert sum(gone) == removed[i][1]
        left = bytes(c for c, g in zip(b, gone) if not g).decode(errors="ignore")
        if not any(gone) or left.split():
            out.append((i, left))
    leaked = {d for d, _ in brute_leaks(out, items)}
    return [(i, t) for i, t in out if i not in leaked]


def test_run_matches_brute_force(ready):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet")
    b = pq.read_table(f"{SF_SMALL}/benchmark.parquet")
    want = brute(list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist())),
                 list(zip(b["item_id"].to_pylist(), b["text"].to_pylist())))
    rows = P.run(ready, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in want} and len(want) < len(t)
    ids = {i: n for n, (i, _) in enumerate(want)}
    check_pieces([r for r in _renumbered(rows, ids)], [x for _, x in want])


def _renumbered(rows, ids):
    from types import SimpleNamespace

    return [SimpleNamespace(**{**r.asDict(), "doc_id": ids[r.doc_id]}) for r in rows]


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_on_odd_tables(ready, odd_docs, no_docs, name, stage):  # noqa: F811
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "cast(n as string) as source", "n as n_chars")
    rows = stage(ready, docs, SF_SMALL).collect()
    assert stage(ready, docs.where("false"), SF_SMALL).collect() == []
    if name == "packing":
        return
    assert all(list(r.asDict()) == COLUMNS for r in rows)
    ids = sorted(r.doc_id or 0 for r in rows)
    assert ids == {"language_id": [0, 1, 2, 6, 8, 9, 10, 10, 11, 12],
                   "minhash_near_dedup": [0, 0, 1, 3, 4, 5, 6, 7, 8, 9, 11, 12]}.get(name, ids)
    if name == "decontaminate":
        assert len(rows) == 15


@pytest.mark.parametrize("name", ["minhash_near_dedup", "decontaminate"])
def test_texts_that_stay_are_not_moved(ready, monkeypatch, name):
    """Only the rows that a decision may concern reach its join, with the texts; the others stay where they are."""
    seen, split = [], P.split_by_id
    monkeypatch.setattr(P, "split_by_id", lambda *a: seen.append(split(*a)) or seen[-1])
    item = pq.read_table(f"{SF_SMALL}/benchmark.parquet")["text"][0].as_py()
    some = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(500)]
    docs = frame(ready, [*some, (500, "a1 b1 c1 d1 e1 f1"), (501, item), (501, item),
                         (502, "x y z"), (502, "u v w"), (None, "o p q"), (None, "a2 b2 c2 d2 e2 f2")])
    rows = dict(P.STAGES)[name](ready, docs, SF_SMALL).collect()
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in rows)
    assert ids == {"minhash_near_dedup": [-1, -1, *range(500), 501, 502, 502],
                   "decontaminate": [-1, -1, *range(501), 502, 502]}[name]
    clear, others = seen[0]
    assert clear.count() > 490 and others.count() < 20
