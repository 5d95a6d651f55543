"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

1. language ID: rows in which no language can be told (no letter, or nothing to learn from) go; every other text stays, gibberish too
2. line dedup: blocks of lines that repeat an earlier document are cut; a document that is left without text goes
3. n-gram Jaccard join: one document of each group of near copies stays; documents count as near copies by what is left of them
   and, where less than seven tenths of the characters are left, by their whole texts before lines were cut, so that no copy stays as a shred
4. benchmark decontamination: documents that hold a test item go
5. mixing sources to target weights: every document gets its position in the mix; sources that run out start over

Rows with null or empty text have no language and go in stage 1.  Rows without doc_id pass stages 2 to 4 as they are.  An empty table
gives empty tables.  Columns besides those of documents are kept; ``mix_position`` and ``mix_epoch`` come with the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.decontaminate import without_contaminated
from kerbside.llm.langid import rows_in_known_language
from kerbside.llm.line_dedup import uncut_texts, without_repeated_lines
from kerbside.llm.ngram_join import keep_one_per_group
from kerbside.llm.pfair import pfair_mix
from kerbside.llm.tables import prepare, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    # nothing is measured here, so no rows are held out; and no least score: it only compares the learned languages with each other
    return rows_in_known_language(docs, F.lit(True), 0.0)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return without_repeated_lines(docs).filter(F.col("text").rlike(r"[^\x20\t-\r]"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return keep_one_per_group(docs, uncut_texts(docs, spark.read.parquet(f"{sf_dir}/documents.parquet")))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pfair_mix(docs)


STAGES = [
    ("language id", known_language),
    ("line dedup", fresh_lines),
    ("n-gram jaccard join", one_of_each_group),
    ("benchmark decontamination", clean_of_benchmark),
    ("pfair mixing", mixed),
]

#: SQL has no suffix automata, patience diffs or schedules; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
