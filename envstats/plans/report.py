"""Batch report: enrich once, write it once, run every analysis from it.

The cleaned, joined, repaired and labelled table is written as parquet
partitioned by year under the shared folder (a lineage cut that survives
executor loss), and every batch analysis reads that compact table: each one
prunes to its own columns, and year filters prune partitions.  The results
are written next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from envstats.operators import alerts, severity, trends
from envstats.plans.batch import build_features
from envstats.session import scratch_path
from envstats.spec import DEFAULT, Spec


def materialize(df: DataFrame, path: str, partition_by=("year",)) -> DataFrame:
    """Write ``df`` once (distributed) and return a scan of the written table.

    A partitioned write straight from the scan tasks would give every task
    one file per partition value it holds (tasks x years small files at
    scale).  The ``rebalance`` hint lets adaptive execution shuffle the rows
    by the partition columns into advisory-size partitions, splitting a hot
    year over several tasks and coalescing small ones, so each year gets a
    few files of a useful size for the analyses that read the table.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def analyses(enr: DataFrame, spec: Spec = DEFAULT) -> dict[str, DataFrame]:
    """Every batch analysis over one enriched table (lazy DataFrames)."""
    summary_pct = alerts.region_summary_pct(alerts.region_summary(enr, spec), ordered=False)
    month = trends.month_bucket_trend(enr, spec)
    feed = alerts.alert_feed(enr, spec)
    return {
        "mean_by_region": severity.mean_by_region(enr, spec),
        "landuse_by_region": severity.landuse_by_region(enr, spec),
        "severity_profile": severity.severity_profile(enr, spec),
        "monthly_trend": trends.monthly_trend(enr, spec),
        "rolling_trend": trends.rolling_trend(enr, spec),
        "severe_share_by_region": severity.severe_share(enr, spec.region, spec),
        "worst_regions_top10": severity.worst_regions(enr, spec, 10),
        "county_risk": severity.county_risk(enr, spec),
        "county_risk_by_year": severity.county_risk_by_year(enr, spec),
        "region_summary_pct": summary_pct,
        "top20_regions": alerts.top_regions(summary_pct, 20, spec),
        "month_bucket_trend": month,
        "last10_months": trends.last_periods(month, 10),
        "season_pivot": trends.season_pivot(month),
        "label_distribution": alerts.label_distribution(enr, spec),
        "label_weather_summary": alerts.label_weather_summary(enr, spec),
        "alert_summary": alerts.alert_summary(feed, spec),
        "alert_year_pivot": alerts.alert_year_pivot(feed, spec),
    }


def run_report(spark: SparkSession, obs: DataFrame, soil: DataFrame | None,
               geo: DataFrame | None, spec: Spec = DEFAULT,
               out_dir: str | None = None, concurrent_jobs: int = 4) -> dict[str, DataFrame]:
    """Enrich, write the enriched table, run and write every analysis.

    The analyses are independent jobs over the same written table; up to
    ``concurrent_jobs`` of them are submitted at once from driver threads,
    so the scheduler can fill executors that one small job leaves idle.
    Returns scans of the written results, keyed by analysis name.
    """
    from concurrent.futures import ThreadPoolExecutor
    out_dir = out_dir or scratch_path(spark, "report")
    enr = severity.enrich(build_features(obs, soil, geo, spec), spec)
    table = materialize(enr, f"{out_dir}/enriched")

    def write(item):
        name, df = item
        df.write.mode("errorifexists").parquet(f"{out_dir}/{name}")
        return name

    todo = analyses(table, spec)
    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        done = list(pool.map(write, todo.items()))
    return {name: spark.read.parquet(f"{out_dir}/{name}") for name in done}
