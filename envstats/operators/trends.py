"""Time trends (SCL-1..6, AGG-10, AGG-12, AGG-16, AGG-25, WIN-1/2, SRT-5).

The time index is an ordinary column pair (year, month) or a ``yyyy-MM``
text; no event-time window is involved.  Windows always run on the
aggregated (region, month) table and are partitioned by region, so no
window ever collects the whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstats import constants as C
from envstats.functions.scalar import month_bucket, month_start, parse_date
from envstats.spec import DEFAULT, Spec


def add_date_parts(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Date text -> date, plus year and month (SCL-1, SCL-2)."""
    d = F.col(spec.date) if dict(df.dtypes).get(spec.date) == "date" else parse_date(spec.date)
    return df.withColumn(spec.date, d).withColumns(
        {spec.year: F.year(spec.date), spec.month: F.month(spec.date)})


def monthly_trend(df: DataFrame, spec: Spec = DEFAULT, by=(), ordered: bool = True) -> DataFrame:
    """Mean score and precipitation by (year, month), optionally by region
    (AGG-10, AGG-12), with the first day of the month (SCL-6).

    ``ordered`` adds the presentation sort; chains that feed a window or a
    join leave it off (a global sort there is a wasted range shuffle).
    """
    keys = list(by) + [spec.year, spec.month]
    out = (df.groupBy(*keys)
             .agg(F.avg(spec.score).alias("avg_drought_score"),
                  F.avg(spec.precip).alias("avg_precipitation"))
             .withColumn("month_start", month_start(spec.year, spec.month)))
    return out.orderBy(*keys) if ordered else out


def monthly_trend_for(df: DataFrame, region_value: str, spec: Spec = DEFAULT) -> DataFrame:
    """Monthly trend of one region (FLT-4 + AGG-12)."""
    return monthly_trend(df.where(F.col(spec.region) == F.lit(region_value)), spec)


def rolling_trend(df: DataFrame, spec: Spec = DEFAULT, rows: int = C.ROLLING_ROWS,
                  by=None) -> DataFrame:
    """Trailing ``rows``-row mean of the monthly means, partial at the start
    (WIN-1, WIN-2).

    The frame counts months that have data, not calendar months (T9).
    Partitioned by region, so each region's series is one window partition.
    """
    by = [spec.region] if by is None else list(by)
    m = monthly_trend(df, spec, by=by, ordered=False)
    w = (Window.partitionBy(*by) if by else Window.partitionBy()) \
        .orderBy(spec.year, spec.month).rowsBetween(-(rows - 1), 0)
    return m.withColumns({
        "rolling_drought": F.avg("avg_drought_score").over(w),
        "rolling_precip": F.avg("avg_precipitation").over(w),
    })


def month_bucket_trend(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Trend by ``yyyy-MM`` text (AGG-16); works on batch and stream input.

    ``avg_temp_c`` is the mean of the daily maximum, as in the source (T18).
    """
    return (df.withColumn("year_month", month_bucket(spec.date))
              .groupBy("year_month")
              .agg(F.count(F.lit(1)).alias("obs_count"),
                   F.round(F.avg(spec.score), 3).alias("avg_drought_score"),
                   F.round(F.avg(spec.precip), 3).alias("avg_precip_mm"),
                   F.round(F.avg(spec.temp_max), 2).alias("avg_temp_c"),
                   F.sum(spec.is_drought).cast("long").alias("drought_obs")))


def last_periods(trend: DataFrame, n: int = 10, period: str = "year_month") -> DataFrame:
    """Last ``n`` periods with a period key, re-sorted ascending (SRT-5, FLT-7)."""
    t = trend.where(F.col(period).isNotNull())
    return t.orderBy(F.col(period).desc()).limit(n).orderBy(period)


def season_pivot(trend: DataFrame, value: str = "avg_drought_score",
                 period: str = "year_month") -> DataFrame:
    """Year x month table of ``value``, months named Jan..Dec (AGG-25, SCL-4/5).

    The twelve month values are given, so no extra job looks them up; a
    month without data stays null.
    """
    months = [f"{m:02d}" for m in range(1, 13)]
    p = (trend.where(F.col(period).isNotNull())
              .select(F.substring(period, 1, 4).alias("year"),
                      F.substring(period, 6, 2).alias("month"), F.col(value))
              .groupBy("year").pivot("month", months).agg(F.first(value)))
    return p.select("year", *[F.col(m).alias(C.MONTH_NAMES[i]) for i, m in enumerate(months)])
