"""A training-data pipeline over the table ``documents``.

Each stage takes what its predecessor wrote and returns the documents that stay, with the columns of
``documents``; the last one returns packed sequences.  Rows that no stage has a reason to drop stay
as they are, null ids and null values in other columns included.

Defined results, for all stages: an empty table gives an empty result; extra columns pass through whatever their names;
texts are read whole, however long; ids are integers, decimals, strings or dates.  Null texts, empty texts, ties and
repeated rows: see each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from symcube.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from symcube.llm.common import materialize, read
from symcube.llm.queries import tokenizer

#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
WORDS, LINK = 5, (80, 100)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, trained on the labelled documents of the input, rejects go.

    Null and empty texts all get the score of a text without words, and repeated rows share theirs: they stay or go
    together.  A score of exactly the threshold stays.  Without labels of both classes the score is their share.
    """
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts, apart from white space, stays.

    That is the one with the longest text, then the smallest id (null ids last); of its repeated rows one stays.
    Null, empty and blank texts are one group.
    """
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id (null ids last).

    Equal ids: the one with the least hash of its text.  Repeated rows of it all stay (the stage before left none).
    Null texts and texts without words are near nothing and stay.
    """
    return ngram_join.keep_first_of_class(docs, words=WORDS, link=LINK)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold nothing and stay; so do all documents if the items are empty.  Repeated rows share their fate.
    """
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens.

    Null and empty texts give a piece with the end id alone; every row is packed, repeated rows too, in stored order.
    """
    return packing.pack(docs, tokenizer(), length=2048, end_id=1, cache_words=100_000)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]
#: Trained and hashed stages have no SQL form; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
