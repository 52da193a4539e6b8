"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> rows.

Each stage judges all rows of its own input; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envstats.llm import bpe, common, decontam, neardup, pii, toxicity
from envstats.llm.catalog import VOCABULARY

NEAR = 80   # hundredths of similarity from which the stage links two texts


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Non-negative PU classifier; texts scored 0.5 or more go."""
    return toxicity.reject(docs, toxicity.fit(docs, common.read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash bands and odd sketches; of texts alike from 0.8 on (words in fives)
    the smallest id of each group stays."""
    return neardup.keep_one(docs, like=NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Template windows; texts that contain a benchmark item go."""
    return decontam.remove(docs, common.read(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; ``n_chars`` follows the text."""
    clean = pii.redact(docs, pii.fit(docs))
    i, j = (common.position(clean, c) for c in ("text", "n_chars"))
    plain = clean.toDF(*[f"_c{k}" for k in range(len(clean.columns))])
    size = F.length(f"_c{i}").cast(plain.schema[j].dataType)
    return plain.withColumn(f"_c{j}", size).toDF(*clean.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: digests of the ids and of the bytes decoded from them."""
    tokens = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(bpe.encode(docs, tokens, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("bpe", encode_tokens),
]
