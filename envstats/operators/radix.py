"""Exact quantiles of many columns by radix selection (AGG-23, AGG-24).

Each wanted order statistic lies in a *cell*, an interval of values of one column;
at first the cell is the whole column.  A pass cuts all open cells of all columns
into digits that keep the order of the doubles, counts them together and keeps the
least and greatest value of each.  Running counts give the digit that holds the
wanted rank; its least and greatest value are the next cell.  The first digit is
sign and binary exponent (``binade``); inside a binade doubles lie evenly, so a
later digit is the number of steps from the cell's least value (``steps``: the
difference of the 64-bit patterns), ``BITS`` bits at a time from the top.  A target
ends when its cell holds one value, or when its rank is the cell's first or last:
a hot value, however many rows hold it, or a column of few values, ends early.

A cell of a binade has at most 2**54 steps and every pass divides them by
2**BITS, so ``1 + ceil(54 / BITS)`` passes always suffice.  A task emits at most
2**BITS rows a cell (4,305 in the first pass), counted in numpy arrays as long as the
values are those of the columns, without a row per value; running counts are windows over
so many rows.  Once the open cells hold a small share of all values and more than one
pass is to come, these values are written to the shared folder and the later
passes read only them.  The driver gets a row per target and pass.

Nulls and NaN take no part; 0.0 and -0.0 are one value; infinities are values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 12             # digit size of a pass
WRITE_SHARE = 64      # open cells are written once they hold less than 1 / WRITE_SHARE of the values
_LIMIT = 1076         # above the exponent of any finite double, as below that of the least one


def binade(x: Column) -> Column:
    """Sign and binary exponent of ``x`` (no NaN) as one integer, 0 for zero.  The
    logarithm rounds, but keeps the order, and so does this digit."""
    size = F.abs(x)
    exponent = F.floor(F.log2(F.least(size, F.lit(sys.float_info.max)))).cast("int")
    digit = F.when(size > F.lit(sys.float_info.max), F.lit(2 * _LIMIT)).otherwise(
        exponent + F.lit(_LIMIT))
    return F.when(x == 0, F.lit(0)).when(x < 0, -digit).otherwise(digit)


def steps(x, lo, unit):
    """Numbers between ``lo`` and ``x`` in a cell whose neighbours are ``unit`` apart."""
    return (x - lo) / unit


def long_values(df: DataFrame, columns) -> DataFrame:
    """(pos, x): the values of the columns, null and NaN left out."""
    doubles = F.array(*[F.col(c).cast("double") for c in columns])
    return (df.select(F.posexplode(doubles).alias("pos", "x"))
            .where(F.col("x").isNotNull() & ~F.isnan("x")))


class _Cell:
    """An interval of values of a column and the ranks wanted in it."""

    def __init__(self, pos: int, lo: float, hi: float, n: int, ranks: dict):
        self.pos, self.lo, self.hi, self.n, self.ranks = pos, lo, hi, n, ranks

    def unit(self) -> float:
        return math.ulp(min(abs(self.lo), abs(self.hi)))

    def shift(self, bits: int) -> int:
        return max(0, int(steps(self.hi, self.lo, self.unit())).bit_length() - bits)


def _wide(df: DataFrame, columns) -> DataFrame:
    """The columns as doubles, named by their numbers."""
    return df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


def _starts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])


def _tables(wide: DataFrame, slots: list[tuple], size: int) -> DataFrame:
    """(cell, digit, n, lo, hi) counted in each task.  A slot is a column and a function from
    its ascending values (no NaN) to the part of them that counts and its digits, which
    ascend and are below ``size``; a batch of a column is sorted once for all its slots."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((len(slots), size), np.int64)
        lo, hi = np.full(n.shape, np.inf), np.full(n.shape, -np.inf)
        for b in batches:
            distinct = {}
            for column in {c for c, _ in slots}:
                x = np.sort(b[column].to_numpy(float))
                x = x[:np.searchsorted(x, np.nan)]
                at = _starts(x)
                distinct[column] = x[at], np.append(at, len(x))
            for i, (column, digits) in enumerate(slots):
                v, at = distinct[column]
                part, digit = digits(v)
                v, at = v[part], at[part.start:part.stop + 1]
                first = _starts(digit)
                last = np.append(first[1:], len(v))[:len(first)]
                d = digit[first]
                n[i, d] += at[last] - at[first]
                lo[i, d] = np.minimum(lo[i, d], v[first])
                hi[i, d] = np.maximum(hi[i, d], v[last - 1])
        cell, digit = np.nonzero(n)
        yield pd.DataFrame({"cell": cell, "digit": digit, "n": n[cell, digit],
                            "lo": lo[cell, digit], "hi": hi[cell, digit]})

    return wide.mapInPandas(run, "cell int, digit long, n long, lo double, hi double")


def _binades(x: np.ndarray) -> tuple[slice, np.ndarray]:
    """Digits of the first pass from 0 on, in the order of ``binade``."""
    digit = np.where(np.isinf(x), 2 * _LIMIT, np.frexp(np.abs(x))[1] + _LIMIT)
    return slice(0, len(x)), 2 * _LIMIT + np.where(x == 0, 0, np.where(x < 0, -digit, digit)).astype(np.int64)


def _digits_of(cell: _Cell, bits: int):
    lo, hi, unit, shift = cell.lo, cell.hi, cell.unit(), cell.shift(bits)

    def digits(x: np.ndarray) -> tuple[slice, np.ndarray]:
        part = slice(int(np.searchsorted(x, lo, "left")), int(np.searchsorted(x, hi, "right")))
        return part, steps(x[part], lo, unit).astype(np.int64) >> shift

    return digits


def _open_values(values: DataFrame, cells: list[_Cell], bits: int) -> DataFrame:
    """(cell, digit, pos, x) of the values in the cells, which do not overlap."""
    rows = [(i, c.pos, c.lo, c.hi, c.unit(), c.shift(bits)) for i, c in enumerate(cells)]
    table = values.sparkSession.createDataFrame(
        rows, "cell int, at int, lo double, hi double, unit double, shift int")
    # bounded: at most one row per wanted order statistic
    inside = values.join(F.broadcast(table), (F.col("pos") == F.col("at")) & (F.col("x") >= F.col("lo"))
                         & (F.col("x") <= F.col("hi")))
    return inside.select("cell", F.call_function(
        "shiftright", steps(F.col("x"), F.col("lo"), F.col("unit")).cast("long"), F.col("shift"))
        .alias("digit"), "pos", "x")


def _single(inside: DataFrame) -> DataFrame:
    return inside.select("cell", "digit", F.lit(1).alias("n"), F.col("x").alias("lo"), F.col("x").alias("hi"))


def _digits(inside: DataFrame) -> DataFrame:
    """(cell, digit, n, lo, hi, below): digit counts with running counts."""
    counted = (inside.groupBy("cell", "digit")
               .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    before = Window.partitionBy("cell").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _hits(digits: DataFrame, cells: list[_Cell]) -> list:
    """Per (cell, rank): the digit that holds the rank."""
    wanted = digits.sparkSession.createDataFrame(
        [(i, r) for i, c in enumerate(cells) for r in c.ranks], "of int, rank long")
    return digits.join(F.broadcast(wanted), (F.col("cell") == F.col("of")) & (F.col("rank") >= F.col("below"))
                       & (F.col("rank") < F.col("below") + F.col("n"))).select(
        "cell", "rank", "digit", "n", "lo", "hi", "below").collect()


def _ranks(n: int, probs) -> set[int]:
    return {k for p in probs for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}


def order_statistics(df: DataFrame, columns, probs, *, bits: int = BITS,
                     write_share: int = WRITE_SHARE) -> tuple[list[int], dict]:
    """(count per column, {(column number, 0-based rank): value}) of the order
    statistics that the quantiles ``probs`` lie between."""
    cols = list(columns)
    # first pass: digits are sign and exponent, whose counts give the columns' sizes and ranks
    digits = _digits(_tables(_wide(df, cols), [(f"c{i}", _binades) for i in range(len(cols))], 4 * _LIMIT + 1))
    size = digits.groupBy("cell").agg(F.sum("n").alias("total"))
    fits = F.lit(False)
    for p in probs:
        h = (F.col("total") - 1) * F.lit(float(p))
        for k in (F.floor(h), F.ceil(h)):
            fits |= (k >= F.col("below")) & (k < F.col("below") + F.col("n"))
    rows = digits.join(F.broadcast(size), "cell").where(fits).collect()    # at most 2 per quantile
    counts = [0] * len(cols)
    found: dict = {}
    cells: list[_Cell] = []
    for r in rows:
        counts[r["cell"]] = r["total"]
        ranks = {k - r["below"]: k for k in _ranks(r["total"], probs)
                 if r["below"] <= k < r["below"] + r["n"]}
        cells += _settled(_Cell(r["cell"], r["lo"], r["hi"], r["n"], ranks), found)
    total, written = sum(counts), False
    while cells:
        used = sorted({c.pos for c in cells})
        if not written and max(c.n for c in cells) > 2 ** bits \
                and sum(c.n for c in cells) * write_share <= total:
            values = long_values(df, [cols[i] for i in used])
            values = values.withColumn("pos", F.get(F.lit(used), F.col("pos")))
            values, written = _written(_open_values(values, cells, bits)), True
        if written:
            inside = _single(_open_values(values, cells, bits))
        else:
            inside = _tables(_wide(df, [cols[i] for i in used]),
                             [(f"c{used.index(c.pos)}", _digits_of(c, bits)) for c in cells], 2 ** bits)
        nxt: dict = {}
        for r in _hits(_digits(inside), cells):
            old = cells[r["cell"]]
            cell = nxt.setdefault((r["cell"], r["digit"]),
                                  _Cell(old.pos, r["lo"], r["hi"], r["n"], {}))
            cell.ranks[r["rank"] - r["below"]] = old.ranks[r["rank"]]
        cells = [c for cell in nxt.values() for c in _settled(cell, found)]
    return counts, found


def _settled(cell: _Cell, found: dict) -> list[_Cell]:
    """Write the ranks that the cell's ends answer to ``found``; the cell, if any are left."""
    for rank, k in list(cell.ranks.items()):
        if cell.lo == cell.hi or rank == 0 or rank == cell.n - 1:
            found[cell.pos, k] = cell.lo if rank == 0 else cell.hi
            del cell.ranks[rank]
    return [cell] if cell.ranks else []


def _written(inside: DataFrame) -> DataFrame:
    from envstats.session import shared_dir
    shared_dir(inside.sparkSession)
    return inside.select("pos", "x").checkpoint(eager=True)


def quantile_values(df: DataFrame, columns, probs=(0.25, 0.5, 0.75), **kw) -> list[tuple]:
    """(column, p, value, n) of the exact ``quantile_cont`` of every column."""
    cols = list(columns)
    counts, at = order_statistics(df, cols, probs, **kw)
    out = []
    for i, c in enumerate(cols):
        for p in probs:
            h = (counts[i] - 1) * p
            if not counts[i]:
                out.append((c, float(p), None, 0))
                continue
            lo, hi, part = at[i, math.floor(h)], at[i, math.ceil(h)], h - math.floor(h)
            # the weighting of Spark's percentile
            value = lo if part == 0 or lo == hi else lo * (1.0 - part) + hi * part
            out.append((c, float(p), float(value), counts[i]))
    return out


def radix_quantiles(df: DataFrame, columns, probs=(0.25, 0.5, 0.75), **kw) -> DataFrame:
    """Exact ``quantile_cont`` per (column, p) -> DataFrame(column, p, value, n)."""
    return df.sparkSession.createDataFrame(quantile_values(df, columns, probs, **kw),
                                           "column string, p double, value double, n long")


def box_stats(df: DataFrame, columns, whisker: float = 1.5, **kw) -> DataFrame:
    """Quartiles, fences, whisker ends, outlier count and fraction per column, the
    rows of ``quantiles.box_stats``; counts and extremes inside the fences of all
    columns come from one more grouped pass."""
    cols = list(columns)
    quartiles: dict = {c: {} for c in cols}
    for c, p, value, n in quantile_values(df, cols, (0.25, 0.5, 0.75), **kw):
        quartiles[c][p] = value
    fences = []
    for i, c in enumerate(cols):
        q1, q3 = quartiles[c][0.25], quartiles[c][0.75]
        if q1 is not None:
            fences.append((i, q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)))
    spark = df.sparkSession

    def fenced(lower: float, upper: float):
        return lambda x: (slice(0, len(x)), (x >= lower).astype(np.int64) + (x > upper))

    # bounded: three rows per column; digit 1 is inside the fences
    parts: dict = {}
    if fences:
        seen = _tables(_wide(df, [cols[i] for i, _, _ in fences]),
                       [(f"c{k}", fenced(lower, upper)) for k, (_, lower, upper) in enumerate(fences)], 3)
        parts = {(fences[r["cell"]][0], r["digit"]): r for r in _digits(seen).collect()}
    rows = []
    for i, c in enumerate(cols):
        if quartiles[c][0.25] is None:
            rows.append((c, *[None] * 6, 0, 0, None, None, None))
            continue
        q1, median, q3 = (quartiles[c][p] for p in (0.25, 0.5, 0.75))
        out, iqr = sum(parts[i, k]["n"] for k in (0, 2) if (i, k) in parts), q3 - q1
        lo, hi, n = (parts[i, 1][k] for k in ("lo", "hi", "n")) if (i, 1) in parts else (None, None, 0)
        rows.append((c, q1, median, q3, iqr, q1 - whisker * iqr, q3 + whisker * iqr, n + out, out,
                     lo, hi, out / (n + out)))
    return spark.createDataFrame(
        rows, "column string, q1 double, median double, q3 double, iqr double, lower_fence double, "
              "upper_fence double, n long, n_outliers long, whisker_low double, whisker_high double, "
              "outlier_fraction double")
