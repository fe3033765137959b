"""The corpus pipeline: five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and is written as Parquet before the next one reads it, so a lost
executor costs tasks of a stage and never an earlier stage. All stages but the
last return the columns of ``documents``; the last returns pieces of packed
sequences. Empty tables, null columns and repeated rows have the results that
each operator's docstring states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm import line_dedup, mixing, near_dup, packing, toxicity
from hirelake.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.clean_stage(spark, docs, sf_dir)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share stay in one document only."""
    return line_dedup.line_stage(spark, docs, sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dup.near_stage(spark, docs, sf_dir)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of domains, languages and sources come to their weights."""
    return mixing.mix_stage(spark, docs, sf_dir)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, packing.public_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Stage 1 scores with a trained model, which SQL cannot express; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
