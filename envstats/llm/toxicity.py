"""Toxicity (operator 3): non-negative positive-unlabelled learning.

The classifier is linear over the presence of character 4- and 5-grams of the
words (hashed to ``BUCKETS``), so it also meets inflected and compounded
forms.  It learns from confirmed toxic documents
(positives) and a sample of all documents of the training fold (unlabelled,
whatever their label) by the non-negative risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss; when the corrected negative risk falls below zero,
the step ascends it instead.  The class prior is the toxic share of the
labelled training rows, unless given.

Bounds (documented parameters, they do not touch which rows are scored):
``POSITIVES`` and ``UNLABELLED`` documents by hash order fit the model, and
up to ``FEATURES`` features are kept: those whose lift among positives over
unlabelled documents is at least ``MIN_LIFT`` of the largest possible one
(1 / prior) and at least ``MIN_Z`` standard errors from none.

Labels, language, source and id never enter a score.  Defined results: null
text is the empty text, whose score is that of the bias alone; a document
labelled more than once counts as toxic if any of its rows says so;
repeated rows get equal scores; without any positive or unlabelled row the
model scores every text by the prior; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstats.llm import common

BUCKETS = 1 << 22        # hashed character n-grams
FEATURES = 1024          # features kept for the classifier
POSITIVES = 6_000        # toxic documents that fit the model, at most
UNLABELLED = 12_000      # unlabelled documents that fit the model, at most
MIN_LIFT, MIN_Z = 0.4, 4.0   # a kept feature's share of the largest lift, and its certainty
CHUNK_CHARS = 400_000   # texts are folded in groups of about this many characters
STEPS, RATE, DECAY = 400, 0.05, 1e-4

# Lower-case letter of each code point of the basic plane, a blank for all else.
_FOLD = np.array([ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else
                  ord(c) if c.isalpha() else 32 for c in map(chr, range(1 << 16))], np.uint32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every character 4- and 5-gram of the texts,
    folded to lower-case letters with one blank around each word."""
    n = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    raw = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.where(raw < 1 << 16, _FOLD[np.minimum(raw, 0xFFFF)], raw)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    keep = np.append(True, (c[1:] != 32) | (c[:-1] != 32) | (doc[1:] != doc[:-1]))[:len(c)]
    c, doc = c[keep], doc[keep]
    found = []
    h = np.zeros(len(c), np.uint32)
    for k in range(1, 6):
        m = max(0, len(c) - k + 1)
        h = h[:m] * np.uint32(0x01000193) + c[k - 1:k - 1 + m]
        if k >= 4:
            mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) + np.uint32(k)
            ok = doc[:m] == doc[len(doc) - m:]
            found.append((doc[:m][ok], ((mixed ^ mixed >> np.uint32(12)) % np.uint32(BUCKETS))[ok]))
    return tuple(np.concatenate(x) for x in zip(*found))


def presence(texts: list[str], chosen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs; with ``chosen`` buckets, their
    (text number, column) pairs only."""
    doc, bucket = grams(texts)
    if chosen is not None:
        column = np.full(BUCKETS, -1, np.int16)
        column[chosen] = np.arange(len(chosen), dtype=np.int16)
        at = column[bucket]
        hit = np.flatnonzero(at >= 0)
        doc, bucket = doc[hit], at[hit]
    pairs = np.unique(doc.astype(np.int64) * BUCKETS + bucket)
    return pairs // BUCKETS, pairs % BUCKETS


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about CHUNK_CHARS characters."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= CHUNK_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


@dataclass
class Model:
    """Chosen buckets, their weights, and the bias."""

    chosen: list[int]
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for lo, hi in blocks(texts):
            z = np.full(hi - lo, self.bias)
            if self.chosen:
                doc, column = presence(texts[lo:hi], self.chosen)
                z += np.bincount(doc, self.weights[column], hi - lo)
            out.append(1 / (1 + np.exp(-np.clip(z, -60, 60))))
        return np.concatenate(out)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS,
               rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear non-negative PU classifier (Adam, all
    rows in each step; same rows, same result)."""
    d = positive.shape[1]
    w = np.zeros(d + 1, np.float32)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def loss_grad(x: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        z = np.clip(sign * (x @ w[:-1] + w[-1]), -60, 60)
        slope = (-sign / (1 + np.exp(z)) / len(x)).astype(np.float32)
        return float(np.log1p(np.exp(-z)).mean()), np.append(slope @ x, slope.sum())

    for step in range(1, steps + 1):
        _, grad_pp = loss_grad(positive, 1.0)
        risk_pn, grad_pn = loss_grad(positive, -1.0)
        risk_un, grad_un = loss_grad(unlabelled, -1.0)
        if risk_un - prior * risk_pn >= 0:
            grad = prior * grad_pp + grad_un - prior * grad_pn
        else:
            grad = prior * grad_pn - grad_un
        grad = grad.astype(np.float32)
        grad[:-1] += np.float32(decay) * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _first_by_hash(ids: DataFrame, most: int, seed: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("key", F.lit(seed)), "key").limit(most)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", prior: float | None = None) -> Model:
    """Learn from the training fold of ``docs`` and ``labels``."""
    marked = (common.pick(labels, key=key, y=label).where("key is not null and y is not null")
              .where(~held_out(F.col("key"))).groupBy("key").agg(F.max("y").alias("y")))
    rows = common.pick(docs, key=key, text=text).where(F.col("key").isNotNull())
    if prior is None:
        share = marked.agg(F.avg("y")).first()[0]
        prior = 0.5 if share is None else share
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    sample = (_first_by_hash(marked.where("y = 1").select("key"), POSITIVES, 1)
              .withColumn("role", F.lit(1))
              .unionByName(_first_by_hash(rows.select("key").where(~held_out(F.col("key")))
                                          .distinct(), UNLABELLED, 2)
                           .withColumn("role", F.lit(0))))
    # at most POSITIVES + UNLABELLED rows of two numbers: a proven bound
    texts = common.written(
        rows.join(F.broadcast(sample), "key").dropDuplicates(["key", "role"])
        .select("role", common.text_of(F.col("text")).alias("text")), "toxic-sample")

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, role = b["text"].tolist(), b["role"].to_numpy()
            for lo, hi in blocks(texts):
                doc, bucket = presence(texts[lo:hi])
                pairs, n = np.unique(bucket * 2 + role[lo:hi][doc], return_counts=True)
                yield pd.DataFrame({"bucket": pairs // 2, "role": pairs % 2, "n": n})

    size = {r["role"]: r["n"] for r in texts.groupBy("role").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Model([], np.zeros(0), float(np.log(prior / (1 - prior))))
    p, u = (F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)) / size[r] for r in (1, 0))
    counted = (texts.mapInPandas(buckets, "bucket long, role long, n long")
               .groupBy("bucket").agg(p.alias("p"), u.alias("u")))
    error = F.sqrt(F.greatest(F.col("p") * (1 - F.col("p")), F.lit(0.0)) / size[1]
                   + F.greatest(F.col("u") * (1 - F.col("u")), F.lit(0.0)) / size[0]) + 1e-6
    chosen = [r["bucket"] for r in counted.withColumn("z", (F.col("p") - F.col("u")) / error)
              .where((F.col("p") >= MIN_LIFT / prior * F.col("u")) & (F.col("z") >= MIN_Z))
              .orderBy(F.desc("z"), "bucket").limit(FEATURES).collect()]

    def columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in blocks(texts):
                doc, column = presence(texts[lo:hi], chosen)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                column = column.astype("<u2")
                yield pd.DataFrame({"role": b["role"].iloc[lo:hi], "x": [
                    column[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]})

    got = sorted(texts.mapInPandas(columns, "role int, x binary").collect(),
                 key=lambda r: (r["role"], r["x"]))
    x = np.zeros((len(got), len(chosen)), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["x"], "<u2")] = 1.0
    role = np.array([r["role"] for r in got])
    weights, bias = train_nnpu(x[role == 1], x[role == 0], prior)
    return Model(chosen, weights, bias)


def scorer(model: Model):
    """A pandas UDF text -> score in [0, 1]."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return score


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.  No shuffle."""
    of = scorer(model)
    rows = common.pick(docs, key=key, text=text).select(
        "key", of(common.text_of(F.col("text"))).alias("score"))
    return rows.select(F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"),
                       "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more."""
    of = scorer(model)
    return common.keep_where(docs, lambda text: of(common.text_of(text)) < 0.5, text=text)
