"""Token counts and packing against the tokenizer library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from conftest import SF_SMALL
from llmcases import no_docs, odd_docs, ready  # noqa: F401
from dayfold.llm import queries as Q
from dayfold.llm.packing import pack, pack_rests, step_groups
from dayfold.llm.tokencount import count_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def random_texts(n, seed, letters="aB1 \n\t\xa0\x85'’é²½_.!?<|>\x00\x1c\x1f日ſßİ​sdtmlvreÀ×"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


SPECIAL = ["a<|endoftext|>b <|endoftext|><|endoftext|>  x", "<|startoftext|>", "", None, "it's 'll''re", "   ", "x y " * 5000]


def test_counts_are_the_librarys(ready):
    texts = random_texts(800, 1) + SPECIAL
    tok = Tokenizer.from_file(BYTES)
    got = {r.doc_id: r for r in count_tokens(frame(ready, texts), BYTES, limit=20, chunk_bytes=3000, range_bytes=2000).collect()}
    for i, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 20)


def test_counts_of_odd_rows(odd_docs, no_docs):
    rows = count_tokens(odd_docs, BYTES).collect()
    assert len(rows) == 15 and sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 10 for r in rows) == 2
    assert {r.n_tokens for r in rows if r.n_bytes == 0} == {0}
    assert count_tokens(no_docs, BYTES).collect() == []


def check_pieces(rows, texts):
    tok = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == rows[0].sequence_tokens <= 2048


def test_pieces_round_trip(ready):
    texts = random_texts(800, 2) + random_texts(800, 3, "aBsSTtmMdDrRvVlLeE'''''ÀéßÞ× .\n1") + SPECIAL
    check_pieces(pack(frame(ready, texts), WORDS, group_bytes=20_000).collect(), texts)


def test_packing_query_pads_little(ready):
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet")
    rows = Q.QUERIES["op5_packing"](ready, SF_SMALL).collect()
    order = dict(zip(texts["doc_id"].to_pylist(), texts["text"].to_pylist()))
    check_pieces(rows, [order[i] for i in range(len(order))])
    sizes = {r.sequence_id: r.sequence_tokens for r in rows}
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.values())
    assert padding < 2048 and len(sizes) < sum(sizes.values()) / 256


def test_windows_are_full_and_balanced():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.choice([1, rng.randint(1, 300), rng.randint(1, 6000)]) for _ in range(rng.randint(1, 60))]
        windows = pack_rests(lengths, (2048, 1024, 512, 256))
        seen = defaultdict(list)
        for w in windows:
            assert 0 < sum(n for _, _, n in w) <= 2048
            for d, s, n in w:
                seen[d].append((s, n))
        for d, n in enumerate(lengths):
            at = 0
            for s, m in sorted(seen[d]):
                assert s == at and m > 0
                at += m
            assert at == n
        sizes = [sum(n for _, _, n in w) for w in windows]
        assert sum(s & (s - 1) != 0 for s in sizes) <= 1
        loads = defaultdict(int)
        for s, g in zip(sizes, step_groups(sizes, 8192)):
            loads[g] += s
        assert max(loads.values()) - min(loads.values()) <= 2048


def test_packing_of_odd_rows(odd_docs, no_docs):
    rows = pack(odd_docs, WORDS, with_ids=True).collect()
    assert sum(r.start == 0 for r in rows) == 15
    assert [r.ids for r in rows if r.doc_id == 3] == [[1]]
    assert all(len(r.ids) == r.length for r in rows)
    assert pack(no_docs, WORDS).collect() == []


def test_texts_of_other_scripts_are_not_kept():
    """The same ids as the library's, and neither time nor memory grows with the texts seen before."""
    import random
    import time

    import numpy as np
    import public_tokenizers
    import pyarrow as pa

    from dayfold.llm import kernel as K
    from dayfold.llm.packing import WordTokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, rng = WordTokenizer(path), random.Random(4)
    tok.clear()
    spent, kept = [], []
    for turn in range(10):
        texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(300)) for _ in range(500)]
        texts += ["plain words 12 it's", "\u0131 x\u0131y", "", "mixed \u4e00 and <|endoftext|> Latin"]
        buf, offs = K.text_buffer(pa.array(texts))
        at = time.process_time()
        ids, first = tok(buf, offs, 1)
        spent.append(time.process_time() - at)
        kept.append((tok.n, sum(map(len, (k for k in tok.index if type(k) is str)))))
        if turn in (0, 9):
            want = [tok.tok.encode(t, add_special_tokens=False).ids + [1] for t in texts]
            assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == want
    assert len(set(kept)) == 1 and kept[0][0] < 50
    assert min(spent[5:]) < 3 * min(spent[:5])
    tok.clear()
    assert tok.learn([]).tolist() == [] and tok.learn([[5], [], [6, 7]]).tolist() == [0, 1, 2]
    big = tok.learn([list(range(3000))] * 5)
    assert tok.first[big[-1] + 1] - tok.first[big[-1]] == 3000 and np.array_equal(tok.flat[:3], [5, 6, 7])
