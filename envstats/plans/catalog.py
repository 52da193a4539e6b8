"""Named queries over the fixture tables: one per operator group of the
survey's inventory.  Each takes ``(spark, sf_dir)`` and returns a DataFrame.

``checked`` normalises output for the SQL comparison only: doubles are
rounded to 6 decimals (summation order differs between engines) and dates
become ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envstats import constants as C
from envstats import schemas
from envstats.functions.scalar import pad_key
from envstats.operators import (alerts, ensemble, incremental, joins, ml, quality, radix, relate,
                                severity, trends)
from envstats.plans.batch import build_features
from envstats.session import data_version, materialize, scratch_path, session_key
from envstats.sources import fixtures as fx
from envstats.sources.files import (existing, publish_parquet, read_dimension, read_observations,
                                    split_rejects)
from envstats.spec import DEFAULT

CHECK_DECIMALS = 6


def checked(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        t = f.dataType.typeName()
        if t in ("double", "float"):
            # + 0.0 turns a rounded -0.0 into 0.0
            out.append((F.round(F.col(name).cast("double"), CHECK_DECIMALS) + F.lit(0.0)).alias(f.name))
        elif t == "date":
            out.append(F.col(name).cast("string").alias(f.name))
        else:
            out.append(F.col(name))
    return df.select(*out)


# --- Entry A: profiling, cleaning, joins, repair -----------------------------

def q_null_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_profile(fx.feat(spark, d))


def q_duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_report(fx.obs_raw(spark, d))


def q_duplicate_report_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_report(fx.obs_raw(spark, d), subset=["fips", "date"])


def q_dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.dedup(fx.obs_raw(spark, d)).transform(checked)


def q_dedup_rows_digest(spark: SparkSession, d: str) -> DataFrame:
    """The distinct rows of a table in which a tenth of the counties reports twice."""
    rows = fx.obs_raw(spark, d)
    return quality.dedup_by_digest(rows.unionByName(rows.where("fips % 10 = 0"))).transform(checked)


HOT_KEY, HOT_EVERY = 1011, 3      # a third of the rows moved to one county


def q_salted_join(spark: SparkSession, d: str) -> DataFrame:
    """Left join with the attributes by shuffle alone, a third of the rows on one key:
    rows and mean score by one attribute."""
    obs = fx.obs_raw(spark, d).select("PRECTOT", "score", F.when(
        F.col("PRECTOT") % HOT_EVERY == 0, F.lit(HOT_KEY)).otherwise(F.col("fips")).alias("fips"))
    out = joins.salted_left_join(obs, fx.soil(spark, d).select("fips", "NVG_LAND"))
    return out.groupBy("NVG_LAND").agg(F.count("*").alias("n_rows"), F.avg("score").alias("avg_score")) \
        .transform(checked)


def q_incremental_county_risk(spark: SparkSession, d: str) -> DataFrame:
    """County risk from partial states: half of the files, then the rest, of which
    the second update reads the new files only."""
    path = scratch_path(spark, "county-files")
    rows = fx.feat(spark, d, dims=()).select(DEFAULT.key, DEFAULT.score, "date")
    score, first = F.col(DEFAULT.score), F.col("date") < F.lit("1998-07-01").cast("date")
    sums = {"n": score.isNotNull().cast("long"), "total": score, "severe": (score >= 3).cast("long")}
    summary = incremental.Summary(
        spark, scratch_path(spark, "county-states"), lambda p: spark.read.schema(rows.schema).parquet(*p),
        {DEFAULT.key: F.col(DEFAULT.key)}, sums)
    rows.where(first).write.parquet(path)
    before = summary.update(path)
    rows.where(~first).write.mode("append").parquet(path)
    assert not set(summary.update(path)) & set(before)
    t = summary.table()
    share = F.col("severe").cast("double") / F.col("n") * 100.0
    return t.select(pad_key(DEFAULT.key).alias(DEFAULT.key),
                    (F.col("total") / F.col("n")).alias("overall_avg_score"),
                    F.col("severe").alias("weeks_in_severe_drought"), F.col("n").alias("total_weeks_recorded"),
                    share.alias("pct_severe_drought")).transform(checked)


def q_unmatched_keys(spark: SparkSession, d: str) -> DataFrame:
    """Fact keys without a (repaired) geocode row."""
    return joins.unmatched_keys(quality.drop_null(fx.obs_raw(spark, d), "score"),
                                fx.geo_repaired(spark, d), "fips")


def q_unmatched_before_repair(spark: SparkSession, d: str) -> DataFrame:
    """Null-probe form over the unrepaired join."""
    obs = quality.drop_null(fx.obs_raw(spark, d), "score")
    return joins.unmatched_after_join(joins.join_dimension(obs, fx.geo(spark, d), "fips"),
                                      "State_Code", "fips")


def q_key_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return joins.duplicate_keys(fx.geo_repaired(spark, d), "fips")


def q_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Days that a county reports more than once."""
    return joins.duplicate_keys(fx.obs_raw(spark, d), ["fips", "date"]).transform(checked)


def q_join_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Rows before and after the two dimension joins, one pass over the fact."""
    obs = quality.drop_null(fx.obs_raw(spark, d), "score")
    return joins.left_join_coverage(obs, [fx.soil(spark, d), fx.geo_repaired(spark, d)], "fips")


def q_override_repair(spark: SparkSession, d: str) -> DataFrame:
    # the repair itself (FIX-1), not the per-session prepared copy
    return joins.repair_dimension(fx.geo(spark, d), fx.geo_overrides(spark), key="fips")


def q_summary_stats(spark: SparkSession, d: str) -> DataFrame:
    f = fx.feat(spark, d, dims=("soil",))
    return quality.summary_stats(f, existing(f, C.OUTLIER_COLUMNS)).transform(checked)


# --- Batch severity and trends -----------------------------------------------

def q_mean_by_region(spark, d):
    return severity.mean_by_region(fx.feat(spark, d, dims=("geo",))).transform(checked)


def q_landuse_by_region(spark, d):
    return severity.landuse_by_region(fx.feat(spark, d, dims=("soil", "geo"))).transform(checked)


def q_severity_profile(spark, d):
    return severity.severity_profile(fx.feat(spark, d, dims=())).transform(checked)


def q_monthly_trend(spark, d):
    return trends.monthly_trend(fx.feat(spark, d, dims=())).transform(checked)


def q_monthly_trend_by_region(spark, d):
    return trends.monthly_trend(fx.feat(spark, d, dims=("geo",)), by=[DEFAULT.region]).transform(checked)


def q_monthly_trend_region(spark, d):
    """Trend of one region (FLT-4)."""
    return trends.monthly_trend_for(fx.feat(spark, d, dims=("geo",)), "NATION_3").transform(checked)


def q_rolling_trend(spark, d):
    return trends.rolling_trend(fx.feat(spark, d, dims=("geo",))).transform(checked)


def q_severe_share_by_region(spark, d):
    return severity.severe_share(fx.feat(spark, d, dims=("geo",)), DEFAULT.region).transform(checked)


def q_worst_regions_top10(spark, d):
    return severity.worst_regions(fx.feat(spark, d, dims=("geo",)), k=10).transform(checked)


def q_county_risk(spark, d):
    return severity.county_risk(fx.feat(spark, d, dims=())).transform(checked)


def q_county_risk_by_year(spark, d):
    return severity.county_risk_by_year(fx.feat(spark, d, dims=())).transform(checked)


# --- Labels, regional summaries, alerts (batch form of the stream outputs) --

def _summary_pct(spark, d, ordered=True):
    return alerts.region_summary_pct(alerts.region_summary(fx.enr(spark, d, dims=("geo",))),
                                     ordered=ordered)


def q_region_summary(spark, d):
    return alerts.region_summary(fx.enr(spark, d, dims=("geo",))).transform(checked)


def q_region_summary_pct(spark, d):
    return _summary_pct(spark, d).transform(checked)


def q_top20_regions(spark, d):
    return alerts.top_regions(_summary_pct(spark, d, ordered=False), 20).transform(checked)


def q_worst_region_drilldown(spark, d):
    return severity.worst_group_drilldown(_summary_pct(spark, d, ordered=False), "avg_drought_score",
                                          DEFAULT.region, DEFAULT.subregion,
                                          "state_mean", materialize=True).transform(checked)


def q_overall_mean_line(spark, d):
    """Unweighted mean of the regional means (reference line), overall and
    per state (AGG-27), in one aggregate: a rollup over the state gives the
    per-state rows and the grand total together."""
    sp = _summary_pct(spark, d, ordered=False)
    r = F.col(DEFAULT.region)
    agg = (sp.rollup(r).agg(F.avg("avg_drought_score").alias("mean_of_means"),
                            F.grouping(r).alias("__total")))
    return (agg.where((F.col("__total") == 1) | r.isNotNull())
               .select(F.when(F.col("__total") == 1, F.lit("ALL")).otherwise(r).alias("scope"),
                       "mean_of_means")
               .transform(checked))


def q_plot_ranges(spark, d):
    """Global extrema used as plot ranges (AGG-28): highest severe share of a
    county, most weeks of a county, lowest and highest score - one scan: the
    county aggregate carries each county's score range."""
    f = severity.with_padded_key(fx.feat(spark, d, dims=()))
    s = F.col(DEFAULT.score)
    per_county = (f.groupBy(DEFAULT.key)
                   .agg(F.count_if(s >= F.lit(DEFAULT.severe)).alias("sev"), F.count(s).alias("n"),
                        F.min(s).alias("lo"), F.max(s).alias("hi")))
    return per_county.agg(
        F.max(F.try_divide(F.col("sev").cast("double"), F.col("n").cast("double")) * F.lit(100.0))
         .alias("max_pct_severe"),
        F.max("n").alias("max_weeks"), F.min("lo").alias("min_score"),
        F.max("hi").alias("max_score")).transform(checked)


def q_captured_counts(spark, d):
    """Regions and monthly periods captured (AGG-29)."""
    return alerts.captured_counts(fx.enr(spark, d, dims=("geo",)))


def q_month_bucket_trend(spark, d):
    return trends.month_bucket_trend(fx.enr(spark, d, dims=())).transform(checked)


def q_last10_months(spark, d):
    return trends.last_periods(trends.month_bucket_trend(fx.enr(spark, d, dims=())), 10).transform(checked)


def q_season_pivot(spark, d):
    return trends.season_pivot(trends.month_bucket_trend(fx.enr(spark, d, dims=()))).transform(checked)


def q_label_distribution(spark, d):
    return alerts.label_distribution(fx.enr(spark, d, dims=()))


def q_label_weather_summary(spark, d):
    return alerts.label_weather_summary(fx.enr(spark, d, dims=())).transform(checked)


def q_alert_feed(spark, d):
    return alerts.alert_feed(fx.enr(spark, d, dims=("geo",))).transform(checked)


def q_alert_summary(spark, d):
    return alerts.alert_summary(alerts.alert_feed(fx.enr(spark, d, dims=("geo",)))).transform(checked)


def q_alert_frequency(spark, d):
    return alerts.alert_frequency(alerts.alert_feed(fx.enr(spark, d, dims=("geo",))))


def q_alert_year_pivot(spark, d):
    return alerts.alert_year_pivot(alerts.alert_feed(fx.enr(spark, d, dims=("geo",))))


# --- Outliers and correlation ----------------------------------------------

_BOXES: dict = {}


def _boxes(spark, d):
    """Box statistics of every listed column: one search for both queries."""
    key = (session_key(spark), *(data_version(fx.table(spark, d, t))
                                 for t in ("lineitem", "supplier")))
    if key not in _BOXES:
        f = fx.feat(spark, d, dims=("soil",))
        _BOXES[key] = radix.box_stats(f, existing(f, C.OUTLIER_COLUMNS))
    return _BOXES[key]


def q_box_stats(spark, d):
    b = _boxes(spark, d)
    return b.select("column", "q1", "median", "q3", "iqr", "lower_fence", "upper_fence",
                    "whisker_low", "whisker_high").transform(checked)


def q_outlier_fraction(spark, d):
    b = _boxes(spark, d)
    return b.select("column", "n", "n_outliers", "outlier_fraction").transform(checked)


def q_outlier_fraction_events(spark, d):
    b = radix.box_stats(fx.table(spark, d, "events"), ["value"])
    return b.select("column", "q1", "median", "q3", "n", "n_outliers",
                    "outlier_fraction").transform(checked)


def q_correlation_long(spark, d):
    f = fx.feat(spark, d, dims=())
    return relate.correlation_matrix(f, C.METEO_COLUMNS).transform(checked)


def q_correlation_nulls(spark, d):
    """Correlations of measures with gaps: pairs are skipped where one is null."""
    f = fx.feat(spark, d, dims=())
    gaps = {c: F.when(F.col("fips") % (len(c) + 1) != 0, F.col(c)).alias(c) for c in C.METEO_COLUMNS}
    return relate.correlation_pairs(f.select(*gaps.values()), list(gaps)).transform(checked)


# --- Streaming: staged files -> file stream -> sinks -> read back ------------

STREAM_ROWS_PER_FILE = 5_000     # several files and micro-batches even on the small tables,
STREAM_BYTES_PER_ROW = 600       # and files that grow with the feed (about 30 of them)
STREAM_FILES = 4                 # files of one micro-batch: compaction and state merges are exercised
STREAM_COMPACT = 2
STREAM_CODEC = "gzip"            # the staged text is most of what a stream query writes
_STAGED: dict = {}


def _feed_files(spark, d, files=STREAM_FILES):
    """(rows of a staged file, files of a micro-batch of a large feed): the rows of a
    batch are those of ``files`` files of about a thirtieth of the feed, dealt to files
    for all cores, because a compressed file is read by one task."""
    size = sum(f[1] for f in data_version(fx.table(spark, d, "lineitem")))
    rows = max(STREAM_ROWS_PER_FILE, size // STREAM_BYTES_PER_ROW)
    pieces = min(-(-spark.sparkContext.defaultParallelism // files), rows // STREAM_ROWS_PER_FILE)
    return rows // pieces, files * pieces


def _stream(spark, d):
    """Staged stream input, shared by the stream queries of one session and
    data folder (one feed, several stream queries over it).  Each query
    still has its own sink and checkpoint."""
    from envstats.streaming.stream import StreamRun
    facts = data_version(fx.table(spark, d, "lineitem"))
    key = (session_key(spark), facts, *(data_version(fx.table(spark, d, t))
                                        for t in ("supplier", "nation")))
    if key not in _STAGED:
        rows, files = _feed_files(spark, d, max(STREAM_FILES, spark.sparkContext.defaultParallelism // 2))
        _STAGED[key] = StreamRun(spark, fx.feat(spark, d), rows_per_file=rows,
                                 max_files_per_trigger=files, compression=STREAM_CODEC)
    return _STAGED[key]


_SUMMARIES: dict = {}
_SERIAL = itertools.count()


def _stream_summary(spark, d):
    """Regional summary of the stream: one drained snapshot for its queries."""
    run = _stream(spark, d)
    if run.root not in _SUMMARIES:
        _SUMMARIES[run.root] = run.aggregate(
            alerts.region_summary, [DEFAULT.region, DEFAULT.subregion],
            compact_every=STREAM_COMPACT)
    return _SUMMARIES[run.root]


def q_stream_region_summary(spark, d):
    return _stream_summary(spark, d).transform(checked)


def q_stream_month_trend(spark, d):
    return _stream(spark, d).aggregate_in_memory(trends.month_bucket_trend).transform(checked)


def _view(df: DataFrame, name: str) -> str:
    from envstats.streaming.stream import unique_name
    view = unique_name(name)
    df.createOrReplaceTempView(view)
    return view


def q_stream_region_pct_sql(spark, d):
    """SQL over the named stream result table (AGG-17): percentages of the
    supported regions of the stream's regional summary."""
    t = _view(_stream_summary(spark, d), "region")
    return spark.sql(f"""
        WITH supported AS (SELECT * FROM {t} WHERE total_obs >= {C.MIN_SUPPORT})
        SELECT supported.*,
               CAST(round(try_divide(100.0 * drought_obs, total_obs), 1) AS DOUBLE) AS drought_pct,
               CAST(round(try_divide(100.0 * high_risk_obs, total_obs), 1) AS DOUBLE) AS high_risk_pct
        FROM supported""").transform(checked)


def q_stream_trend_sql(spark, d):
    """SQL over the stream's monthly table: the ten latest months (STR-12)."""
    t = _view(_stream(spark, d).aggregate_in_memory(trends.month_bucket_trend), "trend")
    return spark.sql(f"""
        SELECT * FROM {t} WHERE year_month IS NOT NULL
        ORDER BY year_month DESC LIMIT 10""").transform(checked)


def q_stream_alert_summary_sql(spark, d):
    """SQL over the stream's alert table: alerts by label (AGG-18)."""
    t = _view(_stream(spark, d).append_parquet(alerts.alert_feed), "alerts")
    return spark.sql(f"""
        SELECT drought_label, count(*) AS alert_count,
               round(avg(score), 2) AS avg_score, round(avg(PRECTOT), 3) AS avg_precip_mm
        FROM {t} GROUP BY drought_label""").transform(checked)


def q_stream_alert_years_sql(spark, d):
    """SQL over the stream's alert table: alerts by year and label (AGG-19)."""
    t = _view(_stream(spark, d).append_parquet(alerts.alert_feed), "alerts")
    return spark.sql(f"""
        SELECT year(try_to_date(CAST(date AS STRING), 'yyyy-MM-dd')) AS year, drought_label,
               count(*) AS alert_count
        FROM {t} WHERE drought_label <> '{C.UNKNOWN_LABEL}' GROUP BY 1, 2""")


def q_stream_alerts(spark, d):
    return _stream(spark, d).append_parquet(alerts.alert_feed).transform(checked)


def q_stream_parquet_readback(spark, d):
    return alerts.label_distribution(_stream(spark, d).append_parquet())


def q_stream_severe_memory(spark, d):
    """Memory table of the most severe alerts by region (SNK-3): counted in the
    stream, so the driver holds one row per region however long the feed is."""
    return _stream(spark, d).aggregate_in_memory(
        lambda s: alerts.alert_feed(s).where(F.col(DEFAULT.score) >= 5)
        .groupBy(DEFAULT.region).agg(F.count("*").alias("alert_count")))


def q_stream_published(spark, d):
    """The alert table, published twice at one place, counted by label (SNK-6)."""
    run = _stream(spark, d)
    src, dst = (f"{run.root}/{unique}" for unique in
                (f"alerts-{next(_SERIAL)}", f"published-{next(_SERIAL)}"))
    run.append_parquet(alerts.alert_feed).write.parquet(src)
    publish_parquet(spark, src, dst)
    return alerts.label_distribution(publish_parquet(spark, src, dst))


def q_stream_labels_seen(spark, d):
    """Append-mode memory table of a bounded feed (SNK-3): each region's labels as
    they are first seen, six per region at most."""
    region = DEFAULT.region
    return _stream(spark, d).append_in_memory(
        lambda s: s.select(region, "drought_label").dropDuplicates([region, "drought_label"]))


_RESTARTED: dict = {}


def _restarted(spark, d):
    """(alert table, region summary) of streams that were stopped in mid-feed: half of
    the files, then the rest on the same checkpoints (STR-10, SNK-4)."""
    from envstats.streaming import durable, stream
    key = (session_key(spark), data_version(fx.table(spark, d, "lineitem")))
    if key not in _RESTARTED:
        rows, files = _feed_files(spark, d)
        feed = durable.LiveFeed(spark, fx.feat(spark, d), rows, compression=STREAM_CODEC)
        alerts_at, summary_at, keys = f"{feed.root}/alerts", f"{feed.root}/summary", [DEFAULT.region, DEFAULT.subregion]
        for share in (0.5, 1.0):
            feed.release(share)
            enr = stream.enrich_stream(stream.read_stream(spark, feed.path, max_files_per_trigger=files))
            stream.run_bounded([
                stream.to_parquet(alerts.alert_feed(enr), alerts_at, f"{alerts_at}-ckpt"),
                stream.to_snapshot(alerts.region_summary(enr), summary_at, f"{summary_at}-ckpt", keys=keys,
                                   compact_every=STREAM_COMPACT,
                                   state_partitions=stream.default_state_partitions(spark))])
        _RESTARTED[key] = spark.read.parquet(alerts_at), stream.read_snapshot(spark, summary_at, keys)
    return _RESTARTED[key]


def q_stream_alerts_restarted(spark, d):
    return _restarted(spark, d)[0].transform(checked)


def q_stream_summary_restarted(spark, d):
    return _restarted(spark, d)[1].transform(checked)


def q_stream_state(spark, d):
    """County counts read from a stream's RocksDB state, as its checkpoint holds it
    (STR-4)."""
    from envstats.streaming import durable, stream
    run = _stream(spark, d)
    out = f"{run.root}/state-{next(_SERIAL)}"
    body = run.enriched().groupBy("fips").agg(F.count("*").alias("n"), F.sum("is_drought").alias("drought_obs"),
                                              F.max("score").alias("top_score"))
    with durable.rocksdb(spark):
        q = stream.to_snapshot(body, out, f"{out}-ckpt", keys=["fips"], compact_every=STREAM_COMPACT,
                               state_partitions=run.state_partitions)
    stream.run_bounded([q])
    return durable.state_table(spark, f"{out}-ckpt", ["fips"], ["n", "drought_obs", "top_score"]).transform(checked)


_RAW: dict = {}


def _raw_feed(spark, d):
    """(good rows, rejected text, progress) of a stream over all observations, in
    which very wet, calm days have a malformed score."""
    from envstats.streaming import durable, stream
    key = (session_key(spark), data_version(fx.table(spark, d, "lineitem")))
    if key not in _RAW:
        root, spoil = scratch_path(spark, "raw"), (F.col("PRECTOT") == BAD_RAIN) & (F.col("WS10M") == BAD_WIND)
        size, files = _feed_files(spark, d)
        durable.stage_raw(fx.obs_raw(spark, d), f"{root}/in", size, spoil, compression=STREAM_CODEC)
        rows = durable.read_stream_with_rejects(spark, f"{root}/in", max_files_per_trigger=files)
        log = durable.ProgressLog(spark)
        try:
            stream.run_bounded([durable.to_good_and_rejects(rows, f"{root}/out", f"{root}/ckpt")])
        finally:
            log.close()
        _RAW[key] = *durable.read_good_and_rejects(spark, f"{root}/out"), durable.summarise(log.table())
    return _RAW[key]


def q_stream_rejects(spark, d):
    """Rows with a score and malformed rows, from the two sinks (SRC-5)."""
    good, lost, _ = _raw_feed(spark, d)
    return good.agg(F.count("*").alias("rows_good"), F.sum("score").alias("total_score")).crossJoin(
        F.broadcast(lost.agg(F.count("*").alias("rows_rejected")))).transform(checked)      # one row


def q_stream_progress(spark, d):
    """What the listener saw of the whole run: rows read, rejected, without a score
    (STR-7)."""
    return _raw_feed(spark, d)[2].select("rows_in", *[
        F.col("metrics")[f"feed.{m}"].alias(m) for m in ("rows_read", "rejected", "null_score")])


# --- Models --------------------------------------------------------------------

BAD_RAIN, BAD_WIND = 50.0, 0.0        # rows whose staged date is malformed
TIME_CUTOFF = "2000-01-01"
_MODELS: dict = {}


def _baseline_predictions(spark, d):
    train, test = ml.time_split(fx.feat(spark, d, dims=()), "date", TIME_CUTOFF)
    return ml.group_mean_model(train, test, "fips")


def q_regression_metrics(spark, d):
    return ml.regression_metrics(_baseline_predictions(spark, d), model="county_mean") \
             .transform(checked)


def q_calibration_bins(spark, d):
    return ml.calibration_bins(_baseline_predictions(spark, d)).transform(checked)


MODEL_PARTS, SAMPLE_EVERY = 5, 500    # test rows: key divisible by 5; their sample: by 500
TREES = {"random_forest": ml.fit_random_forest, "gbt": ml.fit_gbt}


def _tree_model(spark, d, kind):
    """(model, train, test): fitted once per session and data version on all 21
    features (null attributes become the training mean) and kept as a saved
    pipeline in the shared folder, which every model query reads."""
    train, test = _model_sides(spark, d)
    return ml.PipelineModel.load(_model_path(spark, d, kind)), train, test


def _model_sides(spark, d):
    return ml.key_split(fx.model_rows(spark, d), "row_key", MODEL_PARTS)


def _model_path(spark, d, kind):
    key = (session_key(spark), kind, *(data_version(fx.table(spark, d, t))
                                       for t in ("lineitem", "supplier")))
    if key not in _MODELS:
        path = scratch_path(spark, f"model-{kind}")
        train, _ = _model_sides(spark, d)
        TREES[kind](train, C.MODEL_FEATURES, impute=True).write().overwrite().save(path)
        _MODELS[key] = path
    return _MODELS[key]


def _holdout(spark, d, kind):
    """Sizes, label mean, baseline error and whether the model halves it."""
    model, train, test = _tree_model(spark, d, kind)
    r = ml.holdout_report(model.transform(test), test, train, model=kind)
    return r.select("model", "n_train", "n_test", "n_scored", "label_mean", "baseline_rmse",
                    (F.col("rmse") < F.col("baseline_rmse") / 2).alias("halves_baseline"),
                    (F.col("r2") > 0.75).alias("explains_label")).transform(checked)


def q_rf_metrics(spark, d):
    return _holdout(spark, d, "random_forest")


def q_gbt_metrics(spark, d):
    return _holdout(spark, d, "gbt")


def _features_of(model, rows):
    """``rows`` with the inputs of the pipeline's trees, and their names."""
    from pyspark.ml.feature import VectorAssembler
    for stage in model.stages[:-1]:
        if isinstance(stage, VectorAssembler):
            return rows, stage.getInputCols()
        rows = stage.transform(rows)
    raise ValueError("no assembler in the pipeline")


def _tree_scores(spark, model, path, rows, kind):
    """The library's prediction of each row beside that of the nodes read as data."""
    nodes = ensemble.node_table(spark, path, model)
    filled, inputs = _features_of(model, rows)
    depth = (C.RF_PARAMS if kind == "random_forest" else C.GBT_PARAMS)["maxDepth"]
    scored = ensemble.score(filled, ensemble.compiled(nodes, mean=kind == "random_forest"), inputs, depth)
    return model.stages[-1].transform(_assembled(model, scored))


def _assembled(model, rows):
    from pyspark.ml.feature import VectorAssembler
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).transform(rows)


def _tree_predictions(spark, d, kind):
    """Every test row with its label and both predictions."""
    model, _, test = _tree_model(spark, d, kind)
    path = _model_path(spark, d, kind)
    return _tree_scores(spark, model, path, test, kind).select("row_key", "score", "prediction", "tree_prediction")


def _compiled(spark, d, kind):
    """Test rows, and those whose two predictions are equal (to 1e-9)."""
    near = F.abs(F.col("prediction") - F.col("tree_prediction")) <= 1e-9
    return _tree_predictions(spark, d, kind).agg(
        F.count("*").alias("n_test"), F.count_if(near).alias("n_equal")).withColumn("model", F.lit(kind))


def q_rf_tree_predictions(spark, d):
    return _tree_predictions(spark, d, "random_forest")


def q_gbt_tree_predictions(spark, d):
    return _tree_predictions(spark, d, "gbt")


def q_rf_compiled(spark, d):
    return _compiled(spark, d, "random_forest")


def q_gbt_compiled(spark, d):
    return _compiled(spark, d, "gbt")


def _importance_values(spark, d, kind):
    """Each feature's importance as the library states it and from the nodes."""
    model, _, _ = _tree_model(spark, d, kind)
    nodes = ensemble.node_table(spark, _model_path(spark, d, kind), model)
    own = ensemble.importances(nodes, C.MODEL_FEATURES, kind == "random_forest")
    return ml.feature_importance(spark, model, C.MODEL_FEATURES, kind).join(
        own.withColumnRenamed("importance", "from_nodes"), "feature")


def q_rf_importance_values(spark, d):
    return _importance_values(spark, d, "random_forest")


def q_gbt_importance_values(spark, d):
    return _importance_values(spark, d, "gbt")


def _metric_values(spark, d, kind):
    """RMSE, MAE, R2 and MSE of the test rows."""
    model, _, test = _tree_model(spark, d, kind)
    return ml.regression_metrics(model.transform(test), model=kind)


def q_rf_metric_values(spark, d):
    return _metric_values(spark, d, "random_forest")


def q_gbt_metric_values(spark, d):
    return _metric_values(spark, d, "gbt")


def q_random_split(spark, d):
    """The source's split (ML-3): no row on both sides, none lost, the share of the
    test side within five standard deviations of its weight."""
    rows = materialize(fx.model_rows(spark, d).select("row_key", "score")
                       .withColumn("row", F.monotonically_increasing_id()), "split-rows")
    train, test = ml.random_split(rows)
    sides = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    one = rows.agg(F.count("*").alias("n_rows"))
    got = (sides.groupBy("row").agg(F.count("*").alias("n"), F.countDistinct("side").alias("sides"),
                                        F.sum("side").alias("test"))
           .agg(F.count_if(F.col("sides") > 1).alias("n_both"), F.sum("n").alias("n"), F.sum("test").alias("test")))
    w = C.SPLIT_WEIGHTS[1] / sum(C.SPLIT_WEIGHTS)
    near = F.abs(F.col("test") / F.col("n") - w) <= 5 * F.sqrt(F.lit(w * (1 - w)) / F.col("n"))
    return got.crossJoin(F.broadcast(one)).select(                       # one row
        "n_rows", (F.col("n_rows") - F.col("n")).alias("n_lost"), "n_both", near.alias("share_within_bounds"))


def _importances(spark, d, kind):
    """Per feature: whether it is the most important one; the sum is 1."""
    model, _, _ = _tree_model(spark, d, kind)
    imp = ml.feature_importance(spark, model, C.MODEL_FEATURES, kind)
    top = imp.agg(F.max("importance").alias("top"), F.sum("importance").alias("total"))
    return imp.crossJoin(F.broadcast(top)).select(               # one row
        "model", "feature", (F.col("importance") == F.col("top")).alias("is_top"),
        F.col("total")).transform(checked)


def q_rf_importance(spark, d):
    return _importances(spark, d, "random_forest")


def q_gbt_importance(spark, d):
    return _importances(spark, d, "gbt")


def q_rf_actual_vs_predicted(spark, d):
    """1 % sample of (actual, predicted) pairs of the test rows (ML-9, SMP-2)."""
    model, _, test = _tree_model(spark, d, "random_forest")
    pairs = model.transform(ml.key_sample(test, "row_key", SAMPLE_EVERY))
    return pairs.select("row_key", "score",
                        (F.abs(F.col("prediction") - F.col("score")) < 2.5).alias("is_near")
                        ).transform(checked)


def q_score_prediction_range(spark, d):
    """Common range of scores and predictions, as plotted (AGG-28), on the
    county-mean model."""
    p = _baseline_predictions(spark, d)
    return p.agg(F.least(F.min("score"), F.min("prediction")).alias("lowest"),
                 F.greatest(F.max("score"), F.max("prediction")).alias("highest")).transform(checked)


# --- From files ------------------------------------------------------------------

def q_county_risk_from_csv(spark, d):
    """County risk from staged CSV: observations (the dates of very wet, calm days
    are malformed: they are counted as rejected, not taken for missing) and the two
    dimensions, read with header checks, joined and aggregated (SRC-1..3)."""
    root = scratch_path(spark, "csv")
    obs = fx.obs_raw(spark, d).select(*schemas.OBS.names)
    bad_row = F.col("PRECTOT") == F.lit(BAD_RAIN)
    obs.withColumn("date", F.when(bad_row & (F.col("WS10M") == F.lit(BAD_WIND)), F.lit("no day"))
                   .otherwise(F.col("date").cast("string"))).write.option("header", True).csv(f"{root}/obs")
    soil = fx.soil(spark, d).select(*schemas.SOIL.names)
    soil.write.option("header", True).csv(f"{root}/soil")
    fx.geo_repaired(spark, d).select(*schemas.GEO.names).write.option("header", True).csv(f"{root}/geo")
    good, bad = split_rejects(read_observations(spark, f"{root}/obs", rejects=True))
    dims = [read_dimension(spark, f"{root}/{n}", s) for n, s in
            (("soil", schemas.SOIL), ("geo", schemas.GEO))]
    risk = severity.county_risk(build_features(good, *dims))
    return risk.crossJoin(F.broadcast(bad.agg(F.count("*").alias("rows_rejected")))).transform(checked)


QUERIES = {
    "county_risk": q_county_risk,
    "null_profile": q_null_profile,
    "duplicate_report": q_duplicate_report,
    "duplicate_report_keys": q_duplicate_report_keys,
    "dedup_rows": q_dedup_rows,
    "unmatched_keys": q_unmatched_keys,
    "unmatched_before_repair": q_unmatched_before_repair,
    "key_uniqueness": q_key_uniqueness,
    "duplicate_keys": q_duplicate_keys,
    "join_coverage": q_join_coverage,
    "override_repair": q_override_repair,
    "summary_stats": q_summary_stats,
    "mean_by_region": q_mean_by_region,
    "landuse_by_region": q_landuse_by_region,
    "severity_profile": q_severity_profile,
    "monthly_trend": q_monthly_trend,
    "monthly_trend_by_region": q_monthly_trend_by_region,
    "monthly_trend_region": q_monthly_trend_region,
    "rolling_trend": q_rolling_trend,
    "severe_share_by_region": q_severe_share_by_region,
    "worst_regions_top10": q_worst_regions_top10,
    "county_risk_by_year": q_county_risk_by_year,
    "region_summary": q_region_summary,
    "region_summary_pct": q_region_summary_pct,
    "top20_regions": q_top20_regions,
    "worst_region_drilldown": q_worst_region_drilldown,
    "overall_mean_line": q_overall_mean_line,
    "plot_ranges": q_plot_ranges,
    "captured_counts": q_captured_counts,
    "month_bucket_trend": q_month_bucket_trend,
    "last10_months": q_last10_months,
    "season_pivot": q_season_pivot,
    "label_distribution": q_label_distribution,
    "label_weather_summary": q_label_weather_summary,
    "alert_feed": q_alert_feed,
    "alert_summary": q_alert_summary,
    "alert_frequency": q_alert_frequency,
    "alert_year_pivot": q_alert_year_pivot,
    "box_stats": q_box_stats,
    "outlier_fraction": q_outlier_fraction,
    "outlier_fraction_events": q_outlier_fraction_events,
    "correlation_long": q_correlation_long,
    "stream_region_summary": q_stream_region_summary,
    "stream_month_trend": q_stream_month_trend,
    "stream_region_pct_sql": q_stream_region_pct_sql,
    "stream_trend_sql": q_stream_trend_sql,
    "stream_alert_summary_sql": q_stream_alert_summary_sql,
    "stream_alert_years_sql": q_stream_alert_years_sql,
    "stream_alerts": q_stream_alerts,
    "stream_parquet_readback": q_stream_parquet_readback,
    "stream_severe_memory": q_stream_severe_memory,
    "stream_published": q_stream_published,
    "regression_metrics": q_regression_metrics,
    "calibration_bins": q_calibration_bins,
    "rf_metrics": q_rf_metrics,
    "gbt_metrics": q_gbt_metrics,
    "rf_importance": q_rf_importance,
    "gbt_importance": q_gbt_importance,
    "rf_actual_vs_predicted": q_rf_actual_vs_predicted,
    "score_prediction_range": q_score_prediction_range,
    "county_risk_from_csv": q_county_risk_from_csv,
    "dedup_rows_digest": q_dedup_rows_digest,
    "salted_join": q_salted_join,
    "incremental_county_risk": q_incremental_county_risk,
    "correlation_nulls": q_correlation_nulls,
    "stream_labels_seen": q_stream_labels_seen,
    "stream_alerts_restarted": q_stream_alerts_restarted,
    "stream_summary_restarted": q_stream_summary_restarted,
    "stream_state": q_stream_state,
    "stream_rejects": q_stream_rejects,
    "stream_progress": q_stream_progress,
    "random_split": q_random_split,
    "rf_compiled": q_rf_compiled,
    "gbt_compiled": q_gbt_compiled,
}

# Results of learned models, which SQL cannot state; tested against the library on every row.
VALUES = {
    "rf_metric_values": q_rf_metric_values,
    "gbt_metric_values": q_gbt_metric_values,
    "rf_importance_values": q_rf_importance_values,
    "gbt_importance_values": q_gbt_importance_values,
    "rf_tree_predictions": q_rf_tree_predictions,
    "gbt_tree_predictions": q_gbt_tree_predictions,
}
QUERIES.update(VALUES)
