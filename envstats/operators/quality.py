"""Profiling and cleaning (AGG-1..6, FLT-1..3).

Every profile is one global aggregate with a map-side partial stage, so a
single pass over the table answers it however skewed the keys are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from envstats.functions.scalar import col as _col
from envstats.session import materialize


def drop_null(df: DataFrame, subset, nan_is_null: bool = True) -> DataFrame:
    """Drop rows with null in any ``subset`` column (FLT-1, FLT-2).

    Written as ``IS NOT NULL`` predicates plus a NaN test, which is what
    ``dropna(subset=...)`` means for doubles.  The null test reaches the scan
    when ``df``'s columns are those of the files; after a rewriting of the
    column (NaN to null) it cannot, so readers filter first.
    """
    dtypes = dict(df.dtypes)
    cond = None
    for c in ([subset] if isinstance(subset, str) else subset):
        p = F.col(c).isNotNull()
        if nan_is_null and dtypes.get(c) in ("double", "float"):
            p = p & ~F.isnan(F.col(c))
        cond = p if cond is None else cond & p
    return df.where(cond) if cond is not None else df


def keep_not_null(df: DataFrame, c: str) -> DataFrame:
    """``IS NOT NULL`` only; NaN rows are kept (FLT-3, FLT-7)."""
    return df.where(F.col(c).isNotNull())


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """Global row count as a one-row DataFrame (AGG-1)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Per column, the number of nulls; one row, one column per input column (AGG-2)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_profile_long(df: DataFrame, columns=None) -> DataFrame:
    """Same as ``null_profile`` in long form (column, n_null), still one pass."""
    cols = list(columns or df.columns)
    wide = null_profile(df, cols)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null"))
                    for c in cols])
    return wide.select(F.inline(arr))


def dedup(df: DataFrame, subset=None) -> DataFrame:
    """Full-row (or key-subset) deduplication (AGG-3).

    Planned as a hash aggregate with a partial stage: identical rows are
    collapsed in each map task before the shuffle, so a row repeated
    millions of times ships once per task.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def dedup_by_digest(df: DataFrame) -> DataFrame:
    """Full-row deduplication that exchanges 128-bit digests, not rows (AGG-3).

    A first pass counts the rows of each digest (two 64-bit hashes of all
    columns).  Rows whose digest is alone are passed on from the scan; only rows
    of a repeated digest are exchanged, and are compared by value, so two
    different rows of one digest both stay.  The repeated digests are broadcast
    behind the usual size check; where they are too many, most rows have copies
    and the plain ``dedup`` is used, with the same rows.
    """
    from envstats.operators.joins import fits_broadcast
    cols = [F.col(f"`{c}`") for c in df.columns]
    marked = df.withColumns({"__d1": F.xxhash64(*cols, F.lit(1)), "__d2": F.xxhash64(F.lit(2), *cols)})
    twice = (marked.groupBy("__d1", "__d2").agg(F.count(F.lit(1)).alias("__n"))
             .where("__n > 1").select("__d1", "__d2", F.lit(True).alias("__twice")))
    twice = materialize(twice, "digests")
    if not fits_broadcast(twice):
        return dedup(df)
    rows = marked.join(F.broadcast(twice), ["__d1", "__d2"], "left").drop("__d1", "__d2")
    alone = rows.where(F.col("__twice").isNull()).drop("__twice")
    return alone.unionByName(rows.where("__twice").drop("__twice").dropDuplicates())


def duplicate_report(df: DataFrame, subset=None) -> DataFrame:
    """Rows before and after deduplication, in one job (AGG-4)."""
    cols = list(subset) if subset else df.columns
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_distinct(F.struct(*[F.col(c) for c in cols])).alias("rows_after")) \
             .withColumn("duplicates", F.col("rows_before") - F.col("rows_after"))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """Distinct values of one column (AGG-5)."""
    return df.select(c).distinct()


def numeric_columns(df: DataFrame, wanted=None) -> list[str]:
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if wanted is None:
        return num
    s = set(num)
    return [c for c in wanted if c in s]


def summary_stats(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column (AGG-6), typed.

    ``describe()`` gives the same numbers as text; this long form keeps them
    as numbers: (column, count, mean, stddev, min, max).  One aggregate pass,
    then the single result row is turned into one row per column.
    """
    cols = numeric_columns(df, columns)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                             F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                             F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                    for i, c in enumerate(cols)])
    return wide.select(F.inline(arr))


def describe(df: DataFrame, columns=None) -> DataFrame:
    """Spark's own text summary (count, mean, stddev, min, max)."""
    return df.describe(*(columns or []))


def sample_rows(df: DataFrame, fraction: float, seed: int = 42,
                with_replacement: bool = False) -> DataFrame:
    """Seeded Bernoulli sample (SMP-1, SMP-2); always seeded."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def extrema(df: DataFrame, columns) -> DataFrame:
    """Global min and max of some columns in one row (AGG-28)."""
    aggs = []
    for c in columns:
        aggs += [F.min(_col(c)).alias(f"min_{c}"), F.max(_col(c)).alias(f"max_{c}")]
    return df.agg(*aggs)
