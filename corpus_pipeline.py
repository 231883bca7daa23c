"""A corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, source mixing.

Each stage reads what the one before kept. The first three drop documents, the fourth replaces personal data in the
texts, the last returns the mix: a row for each copy of a document, with its epoch and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlake.llm import decontaminate, mixing, near_dedup, pii, quality_rules
from postlake.llm.tables import staged, table

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dedup.stage),
    ("decontaminate", decontaminate.stage),
    ("pii", pii.stage),
    ("mix_sources", mixing.stage),
]

#: Trained scores and token selection have no SQL form. Tests compare near-dedup, decontamination and personal data with
#: brute force, and check the columns, sentinel rows and budgets of the others and of the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
