"""The corpus pipeline: documents -> inoffensive, distinct, uncontaminated documents -> packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm.common import materialize, read_table
from txrisk.llm.decontaminate import keep_uncontaminated
from txrisk.llm.exact_dedup import keep_first_copies
from txrisk.llm.minhash import keep_one_of_each
from txrisk.llm.packing import pack_documents
from txrisk.llm.toxicity import keep_inoffensive

#: Near-duplicates share at least so many hundredths of their five-word shingles.
NEAR_PERCENT = 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among ``docs``, doesn't reject."""
    return keep_inoffensive(docs, read_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_first_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return keep_one_of_each(docs, NEAR_PERCENT)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return keep_uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The toxicity model, the alignment scores and the tokenizer are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
