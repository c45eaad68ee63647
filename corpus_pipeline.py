"""Training-data pipeline: language ID, near-duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of ``documents``. Rows that share a doc_id are one document to the stages that decide by id (near-duplicates, leaks):
one copy of equal rows stays, and a leak in one removes all. A null doc_id is never removed by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.llm.bitmap import split_by_id
from dayfold.llm.common import ship, table, written
from dayfold.llm.decontaminate import leaks
from dayfold.llm.langid import UNKNOWN, identify
from dayfold.llm.minhash import near_duplicates
from dayfold.llm.packing import pack
from dayfold.llm.suffixes import remove_repeats

#: Bytes of a repeated passage; passages of 50 words are longer, chance repetitions in clean prose are shorter.
PASSAGE_BYTES = 200


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without a letter go; which language is recognised has no effect here."""
    ship(spark)
    return identify(docs, with_row=True).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest doc_id."""
    ship(spark)
    left = near_duplicates(docs, k=5, percent=80).groupBy(F.col("doc_id").alias("its id")).agg(F.count_if("kept").alias("n left"))
    left = written(left.where("`n left` <> 1 or `its id` is null"))
    clear, others = split_by_id(docs, left.select(F.col("its id").alias("h")))
    found = others.join(left, others.doc_id.eqNullSafe(left["its id"]), "left").where("coalesce(`n left`, 1) > 0")
    out = clear.unionByName(found.where("`its id` is null").select(docs.columns))
    if left.where("`n left` > 1 and `its id` is not null").head(1):
        again = found.where("`its id` is not null").dropDuplicates(["doc_id", "text"])
        out = out.unionByName(again.select(docs.columns))
    return out


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out (to whole characters); a document of nothing else goes."""
    ship(spark)
    others = [c for c in docs.columns if c != "text"]
    marked = docs.withColumn("no text", F.col("text").isNull())
    cut = remove_repeats(marked, length=PASSAGE_BYTES, with_text=True, carry=(*others, "no text"))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    text = F.when(~F.col("rest.`no text`"), F.when(F.col("n_removed") == 0, text).otherwise(
        F.regexp_replace(text, "\ufffd", "")))
    out = cut.withColumn("cut", text).where("n_removed = 0 or cut rlike '[^ \\t-\\r]'")
    new = {"text": F.col("cut"), "n_chars": F.when(F.col("n_removed") == 0, F.col("rest.n_chars")).otherwise(
        F.char_length("cut").cast("long"))}
    return out.select(*(new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship(spark)
    found = written(leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct())
    clear, others = split_by_id(docs, found.withColumnRenamed("doc_id", "h"))
    return clear.unionByName(others.join(found, "doc_id", "left_anti").select(docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed training sequences."""
    ship(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("minhash_near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

ORACLE_SQL = None  # classes, fingerprints, suffixes and packing are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
