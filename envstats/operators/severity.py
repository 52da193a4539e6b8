"""Severity labelling and severity aggregates (CASE-1..3, AGG-7..9, AGG-11,
AGG-13/14, AGG-27, SRT-3, SRT-6, FLT-9).

All aggregates are hash aggregates with partial + final stages; group keys
(region, county, year) are bounded by geography and calendar, so final
results are small even at full scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstats import constants as C
from envstats.functions.scalar import (count_where, flag_at_least, pad_key, pct,
                                       severity_label)
from envstats.spec import DEFAULT, Spec


def enrich(df: DataFrame, spec: Spec = DEFAULT, mode: str = "exact") -> DataFrame:
    """Label (``severity_label`` mode) + drought flag + high-risk flag (STR-3
    minus the filter).

    Works the same on a batch or a streaming DataFrame.
    """
    return df.withColumns({
        spec.label: severity_label(spec.score, mode=mode),
        spec.is_drought: flag_at_least(spec.score, spec.drought),
        spec.high_risk: flag_at_least(spec.score, spec.severe),
    })


def mean_by_region(df: DataFrame, spec: Spec = DEFAULT, region: str | None = None,
                   name: str = "Average_Drought_Score") -> DataFrame:
    """Mean score by region (AGG-7)."""
    r = region or spec.region
    return df.groupBy(r).agg(F.avg(spec.score).alias(name))


def mean_of_columns(df: DataFrame, by, columns, names: dict | None = None) -> DataFrame:
    """Mean of several columns by key, renamed from a map (AGG-8, PRJ-2, PRJ-4).

    Columns absent from ``df`` are skipped; names default to the column.
    """
    names = names or {}
    have = set(df.columns)
    aggs = [F.avg(c).alias(names.get(c, c)) for c in columns if c in have]
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(*aggs)


def landuse_by_region(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Mean land-use shares by region with display names (AGG-8)."""
    return mean_of_columns(df, spec.region, C.LAND_USE_COLUMNS, C.LAND_USE_NAMES)


def severity_profile(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Mean weather by rounded score, ordered (AGG-9).  ``round`` is HALF_UP."""
    return (df.groupBy(F.round(F.col(spec.score)).alias("score_binned"))
              .agg(F.avg(spec.precip).alias("avg_precipitation"),
                   F.avg(spec.temp).alias("avg_temp"),
                   F.avg(spec.humidity).alias("avg_humidity"),
                   F.avg(spec.wind).alias("avg_wind"))
              .orderBy("score_binned"))


def severe_share(df: DataFrame, by, spec: Spec = DEFAULT, with_mean: bool = True,
                 names=("avg_score", "severe_weeks", "total_weeks", "pct_severe")) -> DataFrame:
    """Share of observations at or above the severe threshold, by key (AGG-11).

    ``total`` counts non-null scores; the percentage is a guarded ratio
    (null when a group has no scores).
    """
    keys = [by] if isinstance(by, str) else list(by)
    s = F.col(spec.score)
    aggs = []
    if with_mean:
        aggs.append(F.avg(s).alias(names[0]))
    aggs += [count_where(s >= F.lit(spec.severe)).alias(names[1]),
             F.count(s).alias(names[2])]
    return df.groupBy(*keys).agg(*aggs).withColumn(names[3], pct(names[1], names[2]))


def with_padded_key(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Key as zero-padded text (SCL-7)."""
    return df.withColumn(spec.key, pad_key(spec.key, spec.key_width))


def county_risk(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Severe share by padded county key, with the county mean (AGG-13)."""
    return severe_share(with_padded_key(df, spec), spec.key, spec,
                        names=("overall_avg_score", "weeks_in_severe_drought",
                               "total_weeks_recorded", "pct_severe_drought"))


def county_risk_by_year(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Severe share by (year, padded county key) (AGG-14)."""
    return (severe_share(with_padded_key(df, spec), [spec.year, spec.key], spec, with_mean=False,
                         names=(None, "severe_weeks", "total_weeks", "pct_severe_drought"))
            .orderBy(spec.year))


def top_k(df: DataFrame, order_col: str, k: int, tie_keys=(), ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``order_col`` with a total order (SRT-3, SRT-4, T15).

    Planned as ``TakeOrderedAndProject``: each task keeps its own k best rows,
    so only k rows per task reach the final merge.
    """
    o = F.col(order_col).asc_nulls_last() if ascending else F.col(order_col).desc_nulls_last()
    return df.orderBy(o, *[F.col(t).asc_nulls_first() for t in tie_keys]).limit(k)


def worst_regions(df: DataFrame, spec: Spec = DEFAULT, k: int = 10) -> DataFrame:
    """Top-k regions by severe share (AGG-11 + SRT-3)."""
    return top_k(severe_share(df, spec.region, spec), "pct_severe", k, tie_keys=(spec.region,))


def worst_group_drilldown(summary: DataFrame, order_col: str, group: str, member: str,
                          mean_name: str = "group_mean", materialize: bool = False) -> DataFrame:
    """Rows of the group that holds the top-ranked row, plus the group's mean
    of ``order_col`` (SRT-6, FLT-9, AGG-27).

    The top row is found with a one-row top-k; its group key is joined back
    as a one-row broadcast (a proven size), so nothing passes the driver.
    Rows whose group key is null cannot be drilled into and are skipped.
    The summary feeds both the ranking and the rows; ``materialize`` writes
    it once as a reliable checkpoint in the shared folder, so the fact under
    it is scanned once instead of twice.
    """
    if materialize:
        from envstats.session import shared_dir
        shared_dir(summary.sparkSession)
        summary = summary.checkpoint(eager=True)
    ranked = summary.where(F.col(group).isNotNull())
    top = top_k(ranked, order_col, 1, tie_keys=(group, member)).select(group)
    rows = ranked.join(F.broadcast(top), on=group, how="left_semi")
    w = Window.partitionBy(group)
    return (rows.withColumn(mean_name, F.avg(order_col).over(w))
                .orderBy(F.col(order_col).asc(), F.col(member).asc_nulls_first()))


def unweighted_mean(summary: DataFrame, c: str, name: str = "mean_of_means") -> DataFrame:
    """Plain mean of group means, not weighted by group size (AGG-27)."""
    return summary.agg(F.avg(c).alias(name))
