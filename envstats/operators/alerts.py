"""Regional summaries and alert analytics (AGG-15, AGG-17..21, AGG-26,
STR-5, FLT-5/6/8, SCL-13).  Same function bodies serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats import constants as C
from envstats.functions.scalar import month_bucket, parse_date, pct_decimal, place_label
from envstats.operators.severity import top_k
from envstats.spec import DEFAULT, Spec


def region_summary(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Per (region, subregion): counts, rounded means, flag sums (AGG-15)."""
    return (df.groupBy(spec.region, spec.subregion)
              .agg(F.count(F.lit(1)).alias("total_obs"),
                   F.round(F.avg(spec.score), 3).alias("avg_drought_score"),
                   F.round(F.avg(spec.precip), 3).alias("avg_precip_mm"),
                   F.round(F.avg(spec.temp_max), 2).alias("avg_max_temp_c"),
                   F.sum(spec.is_drought).cast("long").alias("drought_obs"),
                   F.sum(spec.high_risk).cast("long").alias("high_risk_obs")))


def region_summary_pct(summary: DataFrame, min_support: int = C.MIN_SUPPORT,
                       ordered: bool = True) -> DataFrame:
    """Support filter and two percentages, one decimal, as double (AGG-17, FLT-6).
    ``ordered``: strongest first (presentation sort; off inside chains)."""
    out = (summary.where(F.col("total_obs") >= F.lit(min_support))
                  .withColumns({
                      "drought_pct": pct_decimal("drought_obs", "total_obs", 1),
                      "high_risk_pct": pct_decimal("high_risk_obs", "total_obs", 1)}))
    return out.orderBy(F.col("avg_drought_score").desc()) if ordered else out


def top_regions(summary_pct: DataFrame, n: int = 20, spec: Spec = DEFAULT) -> DataFrame:
    """First ``n`` rows by mean score with a ``place`` label (SRT-4, SCL-13)."""
    t = top_k(summary_pct, "avg_drought_score", n, tie_keys=(spec.region, spec.subregion))
    return t.withColumn("place", place_label(spec.subregion, spec.region))


def label_distribution(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Rows per severity label, ordered by label (AGG-20)."""
    return df.groupBy(spec.label).agg(F.count(F.lit(1)).alias("count")).orderBy(spec.label)


def label_weather_summary(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Count and rounded weather means per label (AGG-21)."""
    return (df.groupBy(spec.label)
              .agg(F.count(F.lit(1)).alias("count"),
                   F.round(F.avg(spec.precip), 3).alias("avg_precip"),
                   F.round(F.avg(spec.temp_max), 2).alias("avg_max_temp"),
                   F.round(F.avg(spec.wind), 2).alias("avg_wind"))
              .orderBy(spec.label))


def alert_feed(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """High-risk rows, eight columns, date as ``yyyy-MM-dd`` text (STR-5, FLT-5)."""
    cols = [spec.region, spec.subregion, spec.date, spec.label, spec.score,
            spec.precip, spec.temp_max, spec.wind]
    return (df.where(F.col(spec.high_risk) == F.lit(1))
              .select(*[F.col(c).cast("string").alias(c) if c == spec.date else F.col(c)
                        for c in cols]))


def alert_summary(alerts: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Per label: count and rounded means, strongest first (AGG-18)."""
    return (alerts.groupBy(spec.label)
                  .agg(F.count(F.lit(1)).alias("alert_count"),
                       F.round(F.avg(spec.score), 2).alias("avg_score"),
                       F.round(F.avg(spec.precip), 3).alias("avg_precip_mm"),
                       F.round(F.avg(spec.temp_max), 2).alias("avg_max_temp_c"),
                       F.round(F.avg(spec.wind), 2).alias("avg_wind_ms"))
                  .orderBy(F.col("avg_score").desc()))


def alert_frequency(alerts: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """Alerts per (year, label), labels other than Unknown (AGG-19, FLT-8)."""
    return (alerts.where(F.col(spec.label) != F.lit(C.UNKNOWN_LABEL))
                  .withColumn("year", F.year(parse_date(spec.date)))
                  .groupBy("year", spec.label)
                  .agg(F.count(F.lit(1)).alias("alert_count"))
                  .orderBy("year"))


def severe_labels(spec: Spec = DEFAULT) -> list[str]:
    """Labels whose score is at or above the severe threshold."""
    return [text for value, text in C.SEVERITY_LABELS if value >= spec.severe]


def alert_year_pivot(alerts: DataFrame, spec: Spec = DEFAULT, labels=None) -> DataFrame:
    """Year x label alert counts, missing cells 0 (AGG-19 + AGG-26, SCL-14).

    Label columns are given (default: the severe labels), so the pivot needs
    no extra job to find them.
    """
    labels = list(labels or severe_labels(spec))
    freq = alert_frequency(alerts, spec)
    p = freq.groupBy("year").pivot(spec.label, labels).agg(F.sum("alert_count"))
    return p.na.fill(0, subset=labels).select(
        "year", *[F.col(f"`{lab}`").cast("long").alias(lab) for lab in labels]).orderBy("year")


def captured_counts(df: DataFrame, spec: Spec = DEFAULT,
                    min_support: int = C.MIN_SUPPORT) -> DataFrame:
    """Group cardinality of the two stream summaries (AGG-29): regions with at
    least ``min_support`` rows ("Regions captured") and months with a
    ``yyyy-MM`` key ("Monthly periods captured").

    One scan: grouping sets count both groupings in the same aggregate
    (map-side partial counts, one exchange), then one global count.
    """
    ym = "year_month"
    keys = [spec.region, spec.subregion, ym]
    g = (df.withColumn(ym, month_bucket(spec.date))
           .groupingSets([[spec.region, spec.subregion], [ym]], *keys)
           .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))
    region_set, month_set = 1, 6          # grouping_id bits of (region, subregion, year_month)
    return g.agg(
        F.count_if((F.col("gid") == F.lit(region_set)) & (F.col("n") >= F.lit(min_support)))
         .alias("regions_captured"),
        F.count_if((F.col("gid") == F.lit(month_set)) & F.col(ym).isNotNull())
         .alias("months_captured"))
