"""From raw documents to packed training sequences, in five stages.

Each stage takes all that its predecessor kept, as a table of documents, and all but the last return
one. ``run`` writes each stage's result to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelane.llm import line_runs, mixing, ngram_join, packing, quality
from tidelane.llm.common import stored
from tidelane.llm.queries import BUDGET, CLASSES, tokenizer

#: No SQL can say the first, fourth and fifth stage; tests hold each against a plain version.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (a score of at least 0.3)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).filter("predicted = 1").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that 10 of them or more hold; ``n_chars`` follows the text."""
    kept = line_runs.drop_frequent_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*docs.columns)


def one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return ngram_join.ngram_join(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target shares of 0.8 of the tokens."""
    return mixing.mix(docs, classes=CLASSES, budget=BUDGET).filter("sampled").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality", keep_good), ("lines", drop_lines), ("near copies", one_of_alike), ("mixture", mix_sources), ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
