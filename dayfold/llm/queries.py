"""Contract queries of the operators: thin wrappers over the given tables, whole tables, production parameters."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, ship, table, written
from .contextmix import score
from .decontaminate import leaks
from .langid import identify
from .licences import NOTICES, TEXTS, scan
from .minhash import near_duplicates
from .mtree import top_k
from .oph import spliced
from .packing import pack
from .suffixes import remove_repeats
from .tokencount import count_tokens
from .trie import coded_turns, end_digests, prefix_trie
from .vectorcode import encode, sum_by_label
from .warc import read_archives, transactions, write_archives


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op1_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256, query="vec_id % 50 = 0")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives in the shared folder, read back, assembled, and reduced to digests."""
    path = shared_dir(spark)
    write_archives(table(spark, sf_dir, "pages"), path)
    captures = transactions(read_archives(spark, path, with_payload=False))
    page = F.expr("try_cast(metadata.fields['page-id'] as bigint)")
    rows = captures.select("capture_id", page.alias("page_id"), F.expr("response.payload_bytes"),
                           F.expr("response.payload_digest"), F.expr("response.kind").alias("record_type"),
                           F.expr("response.refers_to").alias("named"), F.expr("explode(sequence(1, copies))").alias("copy"))
    rows = written(rows)
    first = rows.where("record_type = 'response' and copy = 1").select(F.col("capture_id").alias("named"),
                                                                      F.col("page_id").alias("refers_to"))
    first = first.join(rows.select("named").distinct(), "named", "left_semi")
    return rows.join(first, "named", "left").select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                    "refers_to")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=50)


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op8_licence_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan with windows over the whole text, for notices, licence texts and file headers."""
    return scan(table(spark, sf_dir, "documents"), NOTICES | TEXTS, windows=True)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of rebuilt conversations: the first h turns of conversation c - c % 5, then c's own after its first h."""
    turns = written(coded_turns(table(spark, sf_dir, "conversations")))
    lead = F.expr("crc32(cast(conv_id as string)) % 9")
    convs = turns.where("pos = 1").select("conv_id", F.expr("conv_id - conv_id % 5").alias("base"), lead.alias("h"))
    lent = turns.where("pos <= 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    rebuilt = turns.where(F.col("pos") > lead).unionByName(
        convs.join(lent, "base").where("pos <= h").select(*turns.columns))
    every = convs.selectExpr("conv_id", "cast(null as int) as pos", "cast(null as binary) as code", "0L as n_bytes")
    nodes, ends = prefix_trie(rebuilt.unionByName(every))
    return nodes.join(end_digests(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints in hexadecimal, of each document and of its text with a quarter taken from the next one."""
    rows = spliced(table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op13_slice_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = encode(table(spark, sf_dir, "embeddings"))
    code = F.expr("array_join(transform(codes, c -> lower(lpad(hex(c), 2, '0'))), '')")
    rows = sum_by_label(rows, "error", "label", "label_error")
    return rows.select("vec_id", code.alias("code"), "error", "label_error",
                       F.lit(books.sha256() if books else hashlib.sha256().hexdigest()).alias("codebooks_sha256"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _shipped(f) for f in (
    op1_mtree_topk, op2_token_counts, op3_benchmark_decontamination, op4_warc_transactions, op5_packing,
    op6_context_mixing, op7_suffix_dedup, op8_licence_scan, op8_licence_passages, op9_language_id,
    op10_minhash_near_dedup, op11_prefix_trie, op12_one_permutation, op13_slice_codes)}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOTICES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in NOTICES.items())


def _codes_sql(scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every part against every entry of its codebook, round by round; distances from dot products of integers, which
    are exact in doubles here."""
    def assigned(i: int) -> str:
        return f"""a{i} as materialized (
            select x.id, x.p, min(cast(x.n + y.n - 2 * list_dot_product(x.w, y.w) as bigint) * {entries} + y.e) as best
            from x join b{i} y on x.p = y.p group by x.id, x.p)"""

    def learnt(i: int) -> str:
        return f"""m{i} as (
            select p, e, i, (s - ((s % c) + c) % c) // c as z from (
                select p, e, i, sum(z) as s, count(*) as c from (
                    select x.p, best % {entries} as e, unnest(range(len(w))) as i, unnest(w) as z
                    from a{i} join x using (id, p)) group by p, e, i)),
        b{i + 1} as materialized (
            select p, e, w, list_dot_product(w, w) as n from (
                select b{i}.p, b{i}.e, coalesce(any_value(m.w), any_value(b{i}.w)) as w
                from b{i} left join (select p, e, list(cast(z as double) order by i) as w from m{i} group by p, e) m
                    using (p, e) group by b{i}.p, b{i}.e))"""

    steps = [step for i in range(rounds) for step in (assigned(i), learnt(i))] + [assigned(rounds)]
    return f"""
        with kept as materialized (
            select row_number() over (order by vec_id) - 1 as id, vec_id, label, v from (
                select vec_id, label, list_transform(embedding, lambda x: floor({scale} * cast(x as double))) as v
                from embeddings where embedding is not null and len(embedding) > 0
                  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)),
        x as materialized (
            select *, list_dot_product(w, w) as n from (
                select id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] as w
                from kept, range({parts}) as r(p))),
        b0 as materialized (select p, id as e, w, n from x where id < {entries}),
        {(","+chr(10)+"        ").join(steps)},
        coded as (
            select id, string_agg(printf('%02x', best % {entries}), '' order by p) as code,
                   cast(sum(best // {entries}) as bigint) as error from a{rounds} group by id),
        hashed as (
            select sha256(string_agg(cast(cast(z as bigint) as varchar), ',' order by p, e, i)) as codebooks_sha256
            from (select p, e, unnest(range(len(w))) as i, unnest(w) as z from b{rounds}))
        select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
        from kept join coded using (id), hashed"""


ORACLE_SQL: dict[str, str] = {
    "op11_prefix_trie": """
        with crc as (
            select list_transform(range(256), lambda n: list_reduce(
                list_prepend(n, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) as t),
        turns as (
            select conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) as x, row_number() over (
                partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
            from conversations where conv_id is not null),
        own as (select conv_id, list(x order by pos) as x from turns group by conv_id),
        lead as (
            select own.*, xor(list_reduce(list_prepend(4294967295, list_transform(
                range(1, length(cast(conv_id as varchar)) + 1), lambda i: cast(ascii(cast(conv_id as varchar)[i]) as bigint))),
                lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 9 as h from own, crc),
        rebuilt as (
            select l.conv_id, list_concat(coalesce(o.x[1:l.h], []), l.x[l.h + 1:]) as x
            from lead l left join own o on o.conv_id = l.conv_id - l.conv_id % 5),
        paths as (select conv_id, len(x) as n, unnest(range(len(x) + 1)) as depth, x from rebuilt),
        nodes as (
            select x[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs, max(n) = depth as leaf,
                   coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = depth), '') as ends
            from paths group by 1, 2),
        sized as (
            select *, case when depth = 0 then 0 else (n_convs - 1) * strlen(path[depth].t) end as saved from nodes),
        below as (select leaf, saved, depth as low, path, unnest(range(depth + 1)) as depth from sized),
        sums as (
            select path[1:depth] as path, sum(cast(leaf as bigint)) as n_leaves, sum(saved) as saved,
                   sum(cast(low = depth + 1 as bigint)) as n_children from below group by 1)
        select a.conv_id, a.depth, b.conv_id as parent_conv_id, a.n_convs, cast(n_children as bigint) as n_children,
               cast(n_leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens, sha256(a.ends) as ends_sha256
        from sized a join sums s using (path) left join sized b on b.depth = a.depth - 1 and b.path = a.path[1:a.depth - 1]""",
    "op13_slice_codes": _codes_sql(),
    "op1_mtree_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
            from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
        r as (
            select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
                   vec_id, score from s)
        select query_id, rank, vec_id, score from r where rank <= 5""",
    "op4_warc_transactions": """
        with p as (select page_id, coalesce(html, '') as body from pages),
        d as (select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest from p),
        f as (select payload_digest, min(page_id) as first_id from d where payload_bytes >= 100 group by 1)
        select page_id, payload_bytes, d.payload_digest,
               case when first_id is not null and page_id <> first_id then 'revisit' else 'response' end as record_type,
               case when page_id <> first_id then first_id end as refers_to
        from d left join f on d.payload_digest = f.payload_digest and payload_bytes >= 100""",
    "op8_licence_scan": f"""
        with names(licence, body) as (values {_NOTICES}),
        parts as (
            select licence, null as doc_id, null as scope, null as line, body from names
            union all select null, doc_id, 'text', null, text from documents where text is not null
            union all
            select null, doc_id, 'line', unnest(range(len(x))), unnest(x)
            from (select doc_id, string_split(text, chr(10)) as x from documents where text is not null)),
        words as (
            select row_number() over () as id, licence, doc_id, scope, line, regexp_extract_all(
                translate(body, '{_UPPER}', '{_LOWER}'), '(?:[a-z0-9]|[^\\x00-\\x7F])+') as w from parts),
        sized as (select *, len(w) - cast(len(w) > 1 as bigint) as n from words where len(w) > 0),
        near as (
            select * from sized s where licence is not null
               or exists (select 1 from sized k where k.licence is not null and s.n * 120 >= k.n * 80 and k.n * 120 >= s.n * 80)),
        grams as (
            select id, x, count(*) as c from (
                select id, unnest(case when len(w) = 1 then [w]
                                       else list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) end) as x from near)
            group by id, x),
        met as (
            select s.id, k.id as k, sum(least(g.c, h.c)) as c
            from near s join grams g on g.id = s.id join grams h on h.x = g.x join near k on k.id = h.id
            where s.licence is null and k.licence is not null group by 1, 2),
        hits as (
            select s.doc_id, k.licence, cast(2 * c as double) / (s.n + k.n) as dice, s.scope, s.line, s.n as n_bigrams
            from met join near s on s.id = met.id join near k on k.id = met.k where 200 * c >= 80 * (s.n + k.n)),
        best as (
            select *, row_number() over (partition by doc_id, licence
                                         order by dice desc, n_bigrams desc, coalesce(line, -1)) as rn from hits)
        select doc_id, licence, dice, scope, line, n_bigrams from best where rn = 1""",
    "op10_minhash_near_dedup": f"""
        with recursive t as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
            from documents),
        s as (
            select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [w] else list_distinct(list_transform(
                range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) end as g from t),
        e as (select doc_id, len(g) as n, unnest(g) as x from s),
        p as (
            select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c
            from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
        l as (select a, b from p where 100 * c >= 85 * (na + nb - c)),
        r as (
            select doc_id, doc_id as other from s
            union
            select r.doc_id, case when l.a = r.other then l.b else l.a end from r join l on r.other in (l.a, l.b))
        select doc_id, any_value(len(g)) as n_shingles, min(other) as component_id, doc_id = min(other) as kept
        from r join s using (doc_id) group by doc_id""",
}
