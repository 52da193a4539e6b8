"""Quality (operator 9): importance resampling over hashed n-grams.

Two generative models give each bucket of hashed word unigrams and bigrams a
probability: the target model counts the texts labelled good, the raw model
counts all texts.  A document's log-weight is the sum of
``log p_target - log p_raw`` over its n-grams; adding Gumbel noise (a hash
of the id, so a re-run draws the same) and keeping the ``k`` largest sums
samples ``k`` documents without replacement in proportion to their weights.

Counts cover all rows; per task one array of ``BUCKETS`` counts is summed
before the shuffle.  The k-th largest sum is found by narrowing a value
bracket with distributed counts, never by sorting all rows into one task.

Defined results: null text is the empty text with log-weight 0; rows that
tie with the k-th sum (repeated rows) are all kept; without good labels all
log-weights are 0 and the sample is uniform; an empty table gives an empty
table; a document labelled more than once is good if any row says so.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common

BUCKETS = 10_000     # hashed n-grams of each model
SMOOTHING = 1.0      # added to each bucket's count
BINS = 1024          # cells of one narrowing pass
CACHED = 200_000     # words kept per worker (memory bound)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class NGrams:
    """Buckets of the words and neighbouring word pairs of texts."""

    def __init__(self):
        self.cache: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, text number) of every n-gram of the texts."""
        words = [t.lower().split() for t in texts]
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
        for w in set(chain.from_iterable(words)) - cache.keys():
            b = w.encode()
            cache[w] = zlib.crc32(b) | zlib.adler32(b) << 32
        n = np.fromiter(map(len, words), np.int64, len(words))
        h = np.fromiter(map(cache.__getitem__, chain.from_iterable(words)), np.uint64, int(n.sum()))
        doc = np.repeat(np.arange(len(words)), n)
        h = (h ^ h >> np.uint64(29)) * _MIX
        same = doc[1:] == doc[:-1]
        pair = ((h[:-1] * np.uint64(3) ^ h[1:] >> np.uint64(7)) * _MIX)[same]
        bucket = np.concatenate([h, pair]) >> np.uint64(32)
        return ((bucket % np.uint64(BUCKETS)).astype(np.int64),
                np.concatenate([doc, doc[1:][same]]))


def _blocks(texts: pd.Series, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(texts.map(len).tolist()):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> np.ndarray:
    """log p_target - log p_raw of each bucket, from all rows."""
    good = (common.pick(labels, key=key, y=label).where("y = 1 and key is not null")
            .select("key").distinct().withColumn("good", F.lit(True)))
    rows = (common.pick(docs, key=key, text=text)
            .select("key", common.text_of(F.col("text")).alias("text"))
            .join(good.hint("merge"), "key", "left")   # the same plan at every size
            .select("text", F.coalesce("good", F.lit(False)).alias("good")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, total = NGrams(), np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for lo, hi in _blocks(b["text"]):
                bucket, doc = grams(b["text"].iloc[lo:hi].tolist())
                good = b["good"].to_numpy(bool)[lo:hi][doc]
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                total[1] += np.bincount(bucket[good], minlength=BUCKETS)
        yield pd.DataFrame({"bucket": np.arange(BUCKETS), "raw": total[0], "target": total[1]})

    got = (rows.mapInPandas(count, "bucket int, raw long, target long")
           .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
           .collect())                                       # BUCKETS rows
    counts = np.zeros((2, BUCKETS))
    for r in got:
        counts[:, r["bucket"]] = r["raw"], r["target"]
    if not counts[1].any():
        return np.zeros(BUCKETS)
    p = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def weigh(docs: DataFrame, ratio: np.ndarray, key: str = "doc_id", text: str = "text",
          seed: int = 7) -> DataFrame:
    """(key, log_weight, draw): draw is the log-weight plus Gumbel noise."""

    @F.pandas_udf("double")
    def log_weight(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = NGrams()
        for texts in parts:
            out = [np.zeros(0)]
            for lo, hi in _blocks(texts):
                bucket, doc = grams(texts.iloc[lo:hi].tolist())
                out.append(np.bincount(doc, ratio[bucket], hi - lo))
            yield pd.Series(np.concatenate(out))

    rows = common.pick(docs, key=key, text=text).select(
        "key", log_weight(common.text_of(F.col("text"))).alias("log_weight"))
    uniform = (F.pmod(F.xxhash64(F.col("key"), F.lit(seed)), F.lit(2**52)) + 0.5) / 2.0**52
    return rows.withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform)))


def kth_largest(df: DataFrame, column: str, k: int, enough: int = 4096) -> float | None:
    """The k-th largest value (None without rows; k is cut to the row count).

    Each pass counts the values of ``BINS`` cells of the open bracket; once a
    cell holds at most ``enough`` rows (or one value) its values are read.
    """
    v = F.col(column)
    r = df.agg(F.count(v), F.min(v), F.max(v)).first()
    n, lo, hi = r
    if not n or k < 1:
        return None
    k = min(k, n)
    while True:
        inside = df.where((v >= lo) & (v <= hi))
        if n <= enough or lo == hi:
            return lo if lo == hi else sorted(
                (x[0] for x in inside.select(v).collect()), reverse=True)[k - 1]
        width = (hi - lo) / BINS
        cell = F.least(F.floor((v - lo) / width), F.lit(BINS - 1))
        cells = sorted(inside.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).collect(),
            key=lambda r: -r["cell"])
        for c in cells:
            if k <= c["n"]:
                n, lo, hi = c["n"], c["lo"], c["hi"]
                break
            k -= c["n"]


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, key: str = "doc_id",
             text: str = "text", label: str = "quality", seed: int = 7) -> DataFrame:
    """(doc_id, log_weight, draw, kept) of every row.

    ``k`` documents are kept; by default the share of good rows among the
    labelled ones, of all rows.
    """
    weighed = common.written(
        weigh(docs, fit(docs, labels, key, text, label), key, text, seed), "weighed")
    if k is None:
        share = common.pick(labels, y=label).agg(F.avg("y")).first()[0]
        k = math.ceil(weighed.count() * (1.0 if share is None else share))
    cut = kth_largest(weighed, "draw", k)
    return weighed.select(
        F.col("key").alias("doc_id"), "log_weight", "draw",
        (F.col("draw") >= F.lit(math.inf if cut is None else cut)).alias("kept"))
