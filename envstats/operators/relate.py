"""Correlation of measures (ML-1, AGG-22).

``Correlation.corr`` aggregates a d x d Gramian in one distributed pass; the
d x d result (bounded by the number of measures, not rows) is returned in
long form (feature_x, feature_y, corr).  A constant column gives NaN there,
reported as null (T16).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.operators.layout import spread


def assemble(df: DataFrame, columns, output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Dense vector of ``columns`` (ML-1, ML-2).  ``handle_invalid``: "error"
    fails on null (the default of the source), "skip" drops such rows."""
    va = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)
    return va.transform(df)


def correlation_matrix(df: DataFrame, columns, method: str = "pearson",
                       handle_invalid: str = "error") -> DataFrame:
    """Long-form correlation matrix of ``columns``, all of which must exist.  A
    null value is an error unless the caller drops its rows ("skip")."""
    cols = list(columns)
    missing = [c for c in cols if c not in set(df.columns)]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    vec = assemble(df.select(*[F.col(c).cast("double") for c in cols]), cols, "__v",
                   handle_invalid).select("__v")
    m = Correlation.corr(vec, "__v", method).head()[0].toArray()
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = float(m[i][j])
            rows.append((a, b, None if math.isnan(v) else v))
    return df.sparkSession.createDataFrame(rows, "feature_x string, feature_y string, corr double")


def correlation_pairs(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every pair, long form (AGG-22); null pairs are skipped
    pair by pair (SQL semantics), where the matrix form drops a row when any
    column is null.

    One mergeable aggregate: every row becomes the vector of its pairs' terms
    (both present, x, x^2, y, y^2, x y; zero where one is null), whose element-wise
    sum is a single ``Summarizer`` aggregate with a partial sum per task.  Values
    are taken from their column's mean (one cheap pass before), so that the
    co-moments do not cancel.
    """
    cols = list(columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    x = [F.col(c).cast("double") - F.lit(means[i] or 0.0) for i, c in enumerate(cols)]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    zero, one = F.lit(0.0), F.lit(1.0)
    here = spread(df.select(*[v.alias(f"x{i}") for i, v in enumerate(x)]))   # costly rows: all cores
    x = [F.col(f"x{i}") for i in range(len(cols))]

    def terms(i: int, j: int) -> list:
        both = x[i].isNotNull() & x[j].isNotNull()
        return [F.when(both, t).otherwise(zero)
                for t in (one, x[i], x[i] * x[i], x[j], x[j] * x[j], x[i] * x[j])]

    row = array_to_vector(F.array(*[t for p in pairs for t in terms(*p)]))
    sums = (here.select(row.alias("v")).agg(Summarizer.metrics("sum").summary(F.col("v")).alias("s"))
            .select(vector_to_array(F.col("s.sum")).alias("s")))
    names = F.array(*[F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b")) for i, j in pairs])
    each = sums.select("s", F.posexplode(names).alias("at", "p"))
    n, sx, sxx, sy, syy, sxy = (F.get("s", F.col("at") * 6 + k) for k in range(6))
    dx, dy, dxy = (u - F.try_divide(v * w, n) for u, v, w in ((sxx, sx, sx), (syy, sy, sy), (sxy, sx, sy)))
    corr = F.when((dx > 0) & (dy > 0), F.try_divide(dxy, F.sqrt(dx) * F.sqrt(dy)))
    found = each.select(F.col("p.a").alias("feature_x"), F.col("p.b").alias("feature_y"), corr.alias("corr"))
    turned = found.where("feature_x <> feature_y").select(
        F.col("feature_y").alias("feature_x"), F.col("feature_x").alias("feature_y"), "corr")
    return found.unionByName(turned)
