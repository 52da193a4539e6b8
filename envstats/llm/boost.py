"""Gradient-boosted trees (logistic loss, histogram splits) and isotonic
calibration, of arrays in memory or of all rows of a table.

A table's rows are spread as blocks of binned rows; each level of a tree is one
job that sums gradients and curvatures by node, feature and bin in every task.
Sums are whole numbers of ``1 / UNIT``, so a model does not depend on the order
or the partitions of the rows.  The driver gets one histogram per task and level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstats.session import shared_dir

UNIT = 1 << 20                               # sums are exact up to 2**33 rows
TASK_ROWS, BLOCK_ROWS = 100_000, 50_000      # binned rows of a task, and of an array in it
LINEAGE = 10                                 # trees after which the rows are checkpointed
FLAT_TASKS = 64                              # up to here histograms go to the driver at once


@dataclass
class Boosted:
    """Complete trees of one depth: split feature and threshold by node, leaf values."""

    bias: float
    depth: int
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, threshold, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def matrix(rows: pd.Series) -> np.ndarray:
    """Feature rows written as little-endian doubles."""
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def _cells(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1).astype(np.uint8)


def _nodes(cells: np.ndarray, feature: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    node, rows = np.zeros(len(cells), np.int64), np.arange(len(cells))
    for _ in range(depth):
        node = 2 * node + 1 + (cells[rows, feature[node]] > at[node])
    return node - (2**depth - 1)


def _sums(block: tuple, feature: np.ndarray, at: np.ndarray, level: int, bins: int) -> np.ndarray:
    """Gradient and curvature by (node of the level, feature, bin), times UNIT."""
    cells, n, pos, out = block
    p = 1 / (1 + np.exp(-out))
    first = _nodes(cells, feature, at, level) * bins
    parts = [np.rint(w * UNIT) for w in (n * p - pos, np.maximum(n * p * (1 - p), 1e-9))]
    return np.stack([np.stack([np.bincount(first + c, w, 2**level * bins).reshape(-1, bins) for c in cells.T], 1)
                     for w in parts]).astype(np.int64)


def _moved(block: tuple, feature: np.ndarray, at: np.ndarray, leaf: np.ndarray, depth: int) -> tuple:
    cells, n, pos, out = block
    return cells, n, pos, out + leaf[_nodes(cells, feature, at, depth)]


def _boost(model: Boosted, edges: list[np.ndarray], total, advance, trees: int, rate: float,
           bins: int, ridge: float) -> Boosted:
    """Boost on rows of which ``total`` sums ``_sums`` and which ``advance`` moves by a tree."""
    depth = model.depth
    used = np.array([np.arange(bins) < len(e) for e in edges])
    for _ in range(trees):
        feature, at = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins)
        for level in range(depth):
            g, h = total(feature, at, level).cumsum(-1) / UNIT
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = np.where(used, g**2 / (h + ridge) + (all_g - g)**2 / (all_h - h + ridge)
                            - all_g**2 / (all_h + ridge), 0.0).reshape(2**level, -1)
            top = gain.argmax(1)
            node = np.arange(2**level)
            better = gain[node, top] > 1e-6
            first = 2**level - 1
            feature[first:first + 2**level] = np.where(better, top // bins, 0)
            at[first:first + 2**level] = np.where(better, top % bins, bins)
        # the last level's sums on both sides of its splits are those of the leaves
        cut = (node, feature[first:], np.minimum(at[first:], bins - 1))
        left_g, left_h = g[cut], h[cut]
        leaf = -rate * (np.stack([left_g, all_g[:, 0, 0] - left_g], 1)
                        / (np.stack([left_h, all_h[:, 0, 0] - left_h], 1) + ridge)).ravel()
        advance(feature, at, leaf)
        model.trees.append((feature, np.array([edges[f][i] if i < bins else np.inf
                                               for f, i in zip(feature, at)]), leaf))
    return model


def _start(rows: float, positives: float, depth: int) -> Boosted:
    share = np.clip(positives / rows if rows else 0.0, 1e-4, 1 - 1e-4)
    return Boosted(float(np.log(share / (1 - share))), depth)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2,
        bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Boost ``trees`` trees on rows ``x`` with 0/1 labels ``y``."""
    model = _start(len(y), y.sum(), depth)
    if len(np.unique(y)) < 2:
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    block = [(_cells(x, edges), np.ones(len(y)), y, np.full(len(y), model.bias))]

    def advance(feature, at, leaf) -> None:
        block[0] = _moved(block[0], feature, at, leaf, depth)

    return _boost(model, edges, lambda feature, at, level: _sums(block[0], feature, at, level, bins),
                  advance, trees, rate, bins, ridge)


def _edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Per feature the distinct quantiles k / ``bins`` of all rows, exactly: values are
    counted in each task, so a window holds the distinct values of one feature."""

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                found = [np.unique(c, return_inverse=True) for c in matrix(b["x"]).T]
                yield pd.DataFrame({"f": np.repeat(np.arange(len(found)), [len(v) for v, _ in found]),
                                    "v": np.concatenate([v for v, _ in found]),
                                    "n": np.concatenate([np.bincount(i, b["n"]) for _, i in found])})

    of = Window.partitionBy("f")
    counted = (rows.select("x", "n").mapInPandas(values, "f int, v double, n long")
               .groupBy("f", "v").agg(F.sum("n").alias("n"))
               .withColumn("upto", F.sum("n").over(of.orderBy("v"))).withColumn("total", F.sum("n").over(of)))
    # values at the ranks around (total - 1) * k / bins: under 2 * bins a feature
    wanted = F.expr(f"exists(sequence(1, {bins - 1}), k -> (total - 1) * k div {bins} < upto "
                    f"and ((total - 1) * k + {bins - 1}) div {bins} >= upto - n)")
    out: dict[int, list] = {}
    for r in counted.where(wanted).orderBy("f", "v").collect():
        out.setdefault(r["f"], []).append(r)
    return [_quantiles(out[f], bins) for f in sorted(out)]


def _quantiles(found: list, bins: int) -> np.ndarray:
    """The distinct quantiles k / ``bins`` from the values at the ranks around them."""
    v, upto = np.array([r["v"] for r in found]), np.array([r["upto"] for r in found])
    h = (found[0]["total"] - 1) * np.linspace(0, 1, bins + 1)[1:-1]
    lo, hi = (v[np.searchsorted(upto, k, side="right")] for k in (np.floor(h), np.ceil(h)))
    return np.unique(lo + (hi - lo) * (h - np.floor(h)))


def fit_rows(rows: DataFrame, trees: int = 40, depth: int = 3, rate: float = 0.2,
             bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Boost on all rows of a written table (x, n, pos): features as little-endian
    doubles, how many rows have them and how many of these are positive."""
    size = rows.agg(F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("pos").alias("pos")).first()
    model = _start(size["n"] or 0, size["pos"] or 0, depth)
    if not size["m"] or size["pos"] in (0, size["n"]):
        return model
    edges, bias = _edges(rows, bins), model.bias

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def block() -> pd.DataFrame:
            b = pd.concat(held)
            return pd.DataFrame({"cells": [_cells(matrix(b["x"]), edges).tobytes()],
                                 "n": [b["n"].to_numpy("<f8").tobytes()],
                                 "pos": [b["pos"].to_numpy("<f8").tobytes()]})

        held: list[pd.DataFrame] = []
        for b in batches:
            held.append(b)
            if sum(map(len, held)) >= BLOCK_ROWS:
                yield block()
                held = []
        if sum(map(len, held)):
            yield block()

    def arrays(r) -> tuple:
        n, pos = np.frombuffer(r["n"], "<f8"), np.frombuffer(r["pos"], "<f8")
        return np.frombuffer(r["cells"], np.uint8).reshape(len(n), -1), n, pos, np.full(len(n), bias)

    tasks = -(-size["m"] // TASK_ROWS)
    shared_dir(rows.sparkSession)            # where lineage is cut
    state = (rows.select("x", "n", "pos").repartition(tasks)
             .mapInPandas(binned, "cells binary, n binary, pos binary").rdd.map(arrays)
             .persist(StorageLevel.MEMORY_AND_DISK))
    kept = [state]                           # the rows as they are, after those before the last tree

    def total(feature, at, level) -> np.ndarray:
        out = (kept[-1].map(lambda b: _sums(b, feature, at, level, bins))
               .treeReduce(np.add, depth=1 if tasks <= FLAT_TASKS else 2))
        while len(kept) > 1:
            kept.pop(0).unpersist()
        return out

    def advance(feature, at, leaf) -> None:
        kept.append(kept[-1].map(lambda b: _moved(b, feature, at, leaf, depth))
                    .persist(StorageLevel.MEMORY_AND_DISK))
        if len(model.trees) % LINEAGE == LINEAGE - 1:
            kept[-1].checkpoint()

    try:
        return _boost(model, edges, total, advance, trees, rate, bins, ridge)
    finally:
        for rdd in kept:
            rdd.unpersist()


def _pool(pools: list[list], more) -> None:
    """Pool-adjacent-violators: append [positives, rows, lowest, highest score] of
    distinct ascending scores."""
    for b in more:
        pools.append(list(b))
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            pos, n, _, high = pools.pop()
            a = pools[-1]
            a[0], a[1], a[3] = a[0] + pos, a[1] + n, high


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (score, probability) steps, both ascending."""
    s, at = np.unique(score, return_inverse=True)
    pools: list[list] = []
    _pool(pools, zip(np.bincount(at, y, len(s)).tolist(), np.bincount(at, minlength=len(s)).tolist(), s.tolist(), s.tolist()))
    return np.array([b[2] for b in pools]), np.array([b[0] / b[1] for b in pools])


def isotonic_rows(rows: DataFrame) -> dict[int, list[list]]:
    """Steps [positives, rows, lowest, highest score] per kind of all rows of a table
    (kind, score, n, pos): each range of scores is pooled in its task, the pools of
    all ranges once more.  Steps differ in their share, so they are few."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pools: dict[int, list[list]] = {}
        for b in batches:
            for kind, part in b.groupby("kind"):
                s = part["score"].tolist()
                _pool(pools.setdefault(kind, []), zip(part["pos"].tolist(), part["n"].tolist(), s, s))
        for kind, steps in pools.items():
            yield pd.DataFrame([(kind, *x) for x in steps], columns=["kind", "pos", "n", "low", "high"])

    grouped = rows.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    got = (grouped.repartitionByRange("kind", "score").sortWithinPartitions("kind", "score")
           .mapInPandas(run, "kind int, pos long, n long, low double, high double").collect())
    out: dict[int, list[list]] = {}
    for r in sorted(got, key=lambda r: (r["kind"], r["low"])):
        _pool(out.setdefault(r["kind"], []), [(r["pos"], r["n"], r["low"], r["high"])])
    return out
