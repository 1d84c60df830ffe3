"""The corpus pipeline: language ID, quality rules, near-duplicates, personal data, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the
documents it keeps (the last: the packed pieces).  ``run`` writes every stage's result as
Parquet to the shared folder and hands it, read again, to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.llm import stages
from fleetscope.llm.common import stored, table

STAGES = [
    ("language_id", stages.language_id),
    ("quality_rules", stages.quality_rules),
    ("near_duplicates", stages.near_duplicates),
    ("personal_data", stages.personal_data),
    ("packing", stages.packing),
]

#: SQL can express neither the fitted models nor the tokenizer; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
