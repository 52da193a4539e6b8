"""Hard negatives (operator 12): segment summary filtering.

Vectors are scaled to integers and compared by their exact inner product.  For
an anchor, its positives are the best other rows of its label; for each positive
its negatives are the best rows of other labels whose score lies in a band
around a share of the positive's score.

Every vector is cut into segments at nested levels (``SEGMENTS``), and each
segment's mean and deviation are stored beside the vector.  For two segments of
length n with means m, m' and deviations s, s' (Cauchy-Schwarz)

    n (m m' - s s')  <=  <x, y>  <=  n (m m' + s s'),

so the sums over a level bound the score.  A pair leaves when its bounds miss
every band of the anchor, or lie below the worst of the best found so far; what
remains is refined at the next level, and only the last survivors are scored.
The bounds are widened by more than the rounding of the arithmetic, so nothing
is lost.

Scale: anchors (a stated share of all rows) meet all rows in a grid of blocks,
``ROWS`` rows by ``ANCHORS`` anchors, keyed by hashes: a label with most rows is
spread like any other.  A block returns at most the wanted number per anchor
and band, so the ranking after it reads (blocks of rows) x (wanted) rows per key.
Nothing is broadcast or collected but three counts.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; of rows that repeat an id, that with the
smallest (label, vector) counts; vectors of different length are padded with
zeros; an empty vector scores 0; ties go to the smaller id; a tie or a score of
0 or less is no special case; an anchor without positives, or a positive
without negatives in its band, has no rows; an empty table gives an empty
table.  Scores must fit 64 bits, else an error is raised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstats.llm import common

SEGMENTS = (1, 4, 16)            # of a vector, at each level; each divides the next
ROWS, ANCHORS = 8_192, 4_096     # of one block
TILE = 1_024                     # rows of a block compared at once (fewer at first)
DENSE = 0.1                      # share of live pairs from which a level runs as one matrix product
PIECE = 1 << 18                  # pairs gathered at once below it
NONE = np.iinfo(np.int64).min    # score of an empty place


def quantised(df: DataFrame, anchor: str, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, anchor, v) of the rows that take part, one per id.  ``anchor``
    is an SQL condition on ``id`` and ``label``."""
    rows = (common.pick(df, id=key, label=label, v=vector)
            .where("id is not null and label is not null and v is not null")
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                            & (F.abs(x.cast("double")) < float("inf")))))
    whole = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    one = (rows.select("id", F.struct("label", whole.alias("v")).alias("row"))
           .groupBy("id").agg(F.min("row").alias("row")))
    return one.select("id", "row.label", "row.v").withColumn("anchor", F.expr(anchor))


def summaries(v: np.ndarray) -> np.ndarray:
    """Means and deviations of every level's segments, both times the root of the
    segment's length: products of two rows are then the terms of the bounds."""
    out = []
    for k in SEGMENTS:
        parts = v.reshape(len(v), k, -1).astype(np.float64)
        mean = parts.mean(2)
        spread = np.sqrt(((parts - mean[:, :, None]) ** 2).sum(2))
        out += [mean * np.sqrt(parts.shape[2]), spread]
    return np.concatenate(out, 1)


def _packed(rows: DataFrame, dim: int) -> DataFrame:
    """``rows`` with v as 64-bit integers and s as the summaries' doubles."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                v = np.zeros((len(b), dim), "<i8")
                for i, x in enumerate(b["v"]):
                    v[i, :len(x)] = x
                b["s"] = [x.tobytes() for x in summaries(v).astype("<f8")]
                b["v"] = [x.tobytes() for x in v]
                yield b[["id", "label", "anchor", "v", "s"]]

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInPandas(run, f"id long, label {kind}, anchor boolean, v binary, s binary")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of integer rows, exact."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    bound = a.shape[1] * max(1, int(np.abs(a).max())) * max(1, int(np.abs(b).max()))
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound >= 1 << 63:
        raise OverflowError("a score would leave 64 bits")
    return a @ b.T


class Best:
    """The best ``k`` (score, id) of every anchor and band."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.score = np.full((*low.shape, k), NONE)
        self.id = np.zeros((*low.shape, k), np.int64)

    def may(self, a, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Pairs of anchors ``a`` whose bounds leave some band open."""
        open_ = np.zeros(lower.shape, bool)
        for j in range(self.low.shape[1]):
            least = np.maximum(self.low[a, j], self.score[a, j, -1]).astype(np.float64)
            most = self.high[a, j].astype(np.float64)
            if lower.ndim == 2:
                least, most = least[:, None], most[:, None]
            open_ |= (upper >= least) & (lower <= most)
        return open_

    def add(self, a: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        for j in range(self.low.shape[1]):
            ok = (score >= np.maximum(self.low[a, j], self.score[a, j, -1])) & (score <= self.high[a, j])
            if not ok.any():
                continue
            touched = np.unique(a[ok])
            slot = np.concatenate([np.repeat(touched, self.k), a[ok]])
            s = np.concatenate([self.score[touched, j].ravel(), score[ok]])
            i = np.concatenate([self.id[touched, j].ravel(), ids[ok]])
            order = np.lexsort((i, -np.maximum(s, NONE + 1), slot))
            slot, s, i = slot[order], s[order], i[order]
            first = np.searchsorted(slot, touched)
            rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
            keep = rank < self.k
            self.score[slot[keep], j, rank[keep]] = s[keep]
            self.id[slot[keep], j, rank[keep]] = i[keep]


def _gathered(x: np.ndarray, y: np.ndarray, a: np.ndarray, r: np.ndarray, exact: bool) -> np.ndarray:
    out = [np.zeros(0, np.int64 if exact else np.float64)]
    for at in range(0, len(a), PIECE):
        out.append(np.einsum("ij,ij->i", x[a[at:at + PIECE]], y[r[at:at + PIECE]]))
    return np.concatenate(out)


def search(best: Best, av: np.ndarray, asum: np.ndarray, rv: np.ndarray, rsum: np.ndarray,
           rid: np.ndarray, pairs) -> int:
    """Put all rows that belong there into ``best``; ``pairs(lo, hi)`` tells which
    (anchor, row) pairs of rows lo to hi count.  Returns how many were scored."""
    norm = np.sqrt((asum[:, :2] ** 2).sum(1).max(initial=0) * (rsum[:, :2] ** 2).sum(1).max(initial=0))
    slack, scored, lo, size = 0.5 + 1e-9 * norm, 0, 0, 64
    products(av[:1] * 0 + np.abs(av).max(initial=0), rv[:1] * 0 + np.abs(rv).max(initial=0))  # the range
    while lo < len(rv):
        hi = min(len(rv), lo + size)
        live, at = pairs(lo, hi), 0
        for k in SEGMENTS:
            cut = [slice(at, at + k), slice(at + k, at + 2 * k)]
            at += 2 * k
            share = live.mean() if live.size else 0
            if share >= DENSE:
                mid, off = (asum[:, c] @ rsum[lo:hi, c].T for c in cut)
                live &= best.may(np.arange(len(av)), mid - off - slack, mid + off + slack)
            elif share:
                a, r = np.nonzero(live)
                mid, off = (_gathered(asum[:, c], rsum[lo:hi, c], a, r, False) for c in cut)
                gone = ~best.may(a, mid - off - slack, mid + off + slack)
                live[a[gone], r[gone]] = False
        a, r = np.nonzero(live)
        scored += len(a)
        if live.size and live.mean() >= DENSE:
            score = products(av, rv[lo:hi])[a, r]
        else:
            score = _gathered(av, rv[lo:hi], a, r, True)
        best.add(a, rid[lo:hi][r], score)
        lo, size = hi, min(TILE, 2 * size)
    return scored


def _matrices(rows: pd.DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(rows["v"]), "<i8").reshape(len(rows), dim),
            np.frombuffer(b"".join(rows["s"]), "<f8").reshape(len(rows), 2 * sum(SEGMENTS)))


def _bands(anchors: pd.DataFrame, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores from low to high hundredths of each positive's, as whole numbers;
    a missing positive has a band that holds none."""
    width = anchors["positives"].map(len).max()
    lows, highs = np.full((len(anchors), width), 1), np.full((len(anchors), width), 0)
    for i, scores in enumerate(anchors["scores"]):
        s = np.asarray(scores, object)      # whole numbers of any size
        lows[i, :len(s)], highs[i, :len(s)] = -(-low * s // 100), high * s // 100
    return lows, highs


def _grid(packed: DataFrame, anchors: DataFrame, rows: int, n_anchors: int) -> tuple[DataFrame, DataFrame]:
    across, down = max(1, -(-rows // ROWS)), max(1, -(-n_anchors // ANCHORS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    return (packed.withColumn("row_block", part(across, 1)).withColumn("anchor_block", every(down)),
            anchors.withColumn("anchor_block", part(down, 2)).withColumn("row_block", every(across)))


def _best_per(rows: DataFrame, most: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(df: DataFrame, anchor: str, key: str = "vec_id", vector: str = "embedding",
         label: str = "label", scale: int = 256, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor``: SQL condition on ``id`` and ``label``.  A negative's score is from
    ``low`` to ``high`` hundredths of the positive's.
    """
    rows = common.written(quantised(df, anchor, key, vector, label, scale), "quantised")
    size = rows.agg(F.max(F.size("v")), F.count("*"), F.count_if("anchor")).first()
    dim = SEGMENTS[-1] * max(1, -(-(size[0] or 0) // SEGMENTS[-1]))
    packed = common.written(_packed(rows, dim), "vectors")
    of_anchor = common.written(packed.where("anchor").drop("anchor"), "anchors")
    packed = packed.drop("anchor")

    def same_label(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        got = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("anchor_id", "id", "score")})]
        for value, own in anchors.groupby("label"):
            alike = rows[rows["label"] == value]
            if not len(alike):
                continue
            aid, rid = own["id"].to_numpy(), alike["id"].to_numpy()
            best = Best(np.full((len(own), 1), NONE), np.full((len(own), 1), np.iinfo(np.int64).max), positives)
            search(best, *_matrices(own, dim), *_matrices(alike, dim), rid,
                   lambda lo, hi: aid[:, None] != rid[None, lo:hi])
            a, _, place = np.nonzero(best.score != NONE)
            got.append(pd.DataFrame({"anchor_id": aid[a], "id": best.id[a, 0, place],
                                     "score": best.score[a, 0, place]}))
        return pd.concat(got)

    def other_labels(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(anchors):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in
                                 ("anchor_id", "positive_id", "positive_score", "id", "score")})
        kinds, _ = pd.factorize(pd.concat([anchors["label"], rows["label"]]))
        own, other = kinds[:len(anchors)], kinds[len(anchors):]
        best = Best(*_bands(anchors, low, high), negatives)
        search(best, *_matrices(anchors, dim), *_matrices(rows, dim), rows["id"].to_numpy(),
               lambda lo, hi: own[:, None] != other[None, lo:hi])
        a, j, place = np.nonzero(best.score != NONE)
        ids, scores = anchors["positives"].tolist(), anchors["scores"].tolist()
        return pd.DataFrame({
            "anchor_id": anchors["id"].to_numpy()[a],
            "positive_id": np.array([ids[x][y] for x, y in zip(a, j)], np.int64),
            "positive_score": np.array([scores[x][y] for x, y in zip(a, j)], np.int64),
            "id": best.id[a, j, place], "score": best.score[a, j, place]})

    def over_grid(anchors: DataFrame, run, schema: str) -> DataFrame:
        a, b = _grid(packed, anchors, size[1], size[2])
        return (a.groupBy("row_block", "anchor_block").cogroup(b.groupBy("row_block", "anchor_block"))
                .applyInPandas(run, schema))

    found = _best_per(over_grid(of_anchor, same_label, "anchor_id long, id long, score long"),
                      positives, "anchor_id")
    in_order = F.array_sort(F.collect_list(F.struct("rank", "id", "score")))
    found = common.written(found.groupBy("anchor_id").agg(in_order.alias("p")).select(
        F.col("anchor_id").alias("id"), F.col("p.id").alias("positives"),
        F.col("p.score").alias("scores")), "positives")
    hard = _best_per(over_grid(of_anchor.join(found, "id"), other_labels,
                               "anchor_id long, positive_id long, positive_score long, id long, score long"),
                     negatives, "anchor_id", "positive_id")
    return hard.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))
