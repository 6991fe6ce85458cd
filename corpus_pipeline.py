"""The corpus pipeline: stages over the documents table, each written as
Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import stages
from strata.llm.tables import table, written

STAGES = [
    ("language_id", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("secret_scan", stages.secret_scan),
    ("byte_bpe", stages.byte_bpe),
]

#: The tokenizer stage has no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
