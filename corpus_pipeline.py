"""Corpus pipeline: from ``documents`` to packed training sequences.

Five stages, each one operator of ``abtforge.llm`` over everything that its predecessor kept:

1. quality classifier   documents that it rejects go
2. SimHash near-dedup   one document of each group of near-duplicates stays
3. suffix-array dedup   repeated 200-byte passages are cut out of the texts; every row stays
4. source mixing        every document as often as its source's rate and its draw say
5. packing              pieces of sequences of at most 2048 tokens, with their token ids

Stages 1 to 4 return the columns of ``documents``.  ``run`` writes each stage as Parquet to the
shared folder of the cluster and reads it back, so a lost executor repeats one stage at most.

Null or empty texts: scored by the prior in stage 1, fingerprint zero in stage 2 (they are one
group), unchanged in 3, drawn like any row in 4 (no words), and one piece of the end id in 5.
Repeated rows are scored alike and one of them stays after stage 2.  Empty tables give empty
results.  Extra columns of ``documents`` are carried through stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abtforge.llm.mixing import mix
from abtforge.llm.packing import pack
from abtforge.llm.quality import keep_quality
from abtforge.llm.simhash import one_per_group
from abtforge.llm.store import table, written
from abtforge.llm.suffix_dedup import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("source mixing", source_mixing),
    ("packing", packing),
]

# several stages have no SQL form; tests/llm compares the pipeline with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is read from the last stage's written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
