"""Corpus pipeline over ``documents``: each stage applies one operator to all
rows that the stage before it kept, is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from envstats.llm import stages
from envstats.llm.common import read, written

STAGES = stages.STAGES
ORACLE_SQL = None   # learned classifiers, sketches and BPE are not SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
