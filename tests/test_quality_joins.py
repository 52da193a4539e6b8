import pandas as pd
from pyspark.sql import functions as F

from envstats.operators import joins, quality


def test_duplicate_overrides_raise(spark, geo_rows):
    import pytest
    twice = spark.createDataFrame([(1001, "X"), (1001, "Y")], "fips long, State_or_Territory string")
    with pytest.raises(ValueError, match="1001"):
        joins.repair_dimension(geo_rows, twice)


def test_repair_does_not_shuffle_the_dimension(spark, geo_rows):
    from envstats.session import scratch_path
    path = scratch_path(spark, "dim")
    geo_rows.write.parquet(path)
    fix = spark.createDataFrame([(1001, "X"), (7, "Y")], "fips long, State_or_Territory string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = joins.repair_dimension(spark.read.parquet(path), fix)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
        got = {r.fips: r.State_or_Territory for r in out.collect()}
        assert got[1001] == "X" and got[7] == "Y" and len(got) == geo_rows.count() + 1
    finally:
        spark.conf.set(key, old)


def test_a_grown_dimension_is_measured_again(spark):
    from envstats.session import scratch_path
    path = scratch_path(spark, "grow")
    spark.range(10).write.parquet(path)
    assert joins.fits_broadcast(spark.read.parquet(path), 50, cache_key="grow")
    spark.range(100).write.mode("append").parquet(path)
    assert not joins.fits_broadcast(spark.read.parquet(path), 50, cache_key="grow")


def test_drop_null_matches_dropna_and_keep_not_null_keeps_nan(obs_rows):
    a = quality.drop_null(obs_rows, "score").count()
    b = obs_rows.dropna(subset=["score"]).count()
    assert a == b == obs_rows.count() - 2
    assert quality.keep_not_null(obs_rows, "score").count() == obs_rows.count() - 1


def test_drop_null_is_pushed_to_parquet(spark, tmp_path):
    p = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1.0,), (None,)], "score double").write.parquet(p)
    plan = quality.drop_null(spark.read.parquet(p), "score")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(score)" in plan


def test_null_profile(obs_rows):
    r = quality.null_profile(obs_rows).first()
    assert r["score"] == 1 and r["fips"] == 0
    lng = {x["column"]: x["n_null"] for x in quality.null_profile_long(obs_rows).collect()}
    assert lng["score"] == 1 and len(lng) == len(obs_rows.columns)


def test_duplicate_report_and_dedup(obs_rows):
    r = quality.duplicate_report(obs_rows).first()
    assert (r.rows_before, r.rows_after, r.duplicates) == (13, 12, 1)
    assert quality.dedup(obs_rows).count() == 12
    rk = quality.duplicate_report(obs_rows, ["fips", "date"]).first()
    assert rk.rows_after == 12


def test_summary_stats_vs_pandas(obs_rows):
    cols = ["PRECTOT", "T2M", "score"]
    got = {r["column"]: r for r in quality.summary_stats(obs_rows, cols).collect()}
    pdf = pd.DataFrame(obs_rows.select(*cols).collect(), columns=cols).astype(float)
    # Spark's avg etc. skip null; NaN makes mean/stddev NaN, like the source data before cleaning
    for c in ("PRECTOT", "T2M"):
        s = pdf[c]
        assert got[c]["count"] == s.count()
        assert abs(got[c]["mean"] - s.mean()) < 1e-12
        assert abs(got[c]["stddev"] - s.std(ddof=1)) < 1e-12
        assert got[c]["min"] == s.min() and got[c]["max"] == s.max()


def test_sized_broadcast_checks_size(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert joins.fits_broadcast(small, 100)
    assert not joins.fits_broadcast(big, 100)
    fact = spark.range(100000).withColumnRenamed("id", "k")
    plan_small = fact.join(joins.sized_broadcast(small.withColumnRenamed("id", "k"), 100), "k") \
                     ._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan_small or "BroadcastExchange" in plan_small


def test_repair_dimension_sets_override_keeps_others(spark, geo_rows):
    ov = spark.createDataFrame([(46102, "South Dakota", 46, "SD", 102), (1001, "Zed", 9, "ZZ", 7)],
                               "fips long, State_or_Territory string, State_Code int, "
                               "State_Abbreviation string, County int")
    rep = {r.fips: r for r in joins.repair_dimension(geo_rows, ov).collect()}
    assert rep[46102].State_or_Territory == "South Dakota" and rep[46102].County_Name is None
    assert rep[1001].State_or_Territory == "Zed" and rep[1001].County_Name == "One"  # set even if present
    assert rep[1002].State_or_Territory == "Alpha"
    assert joins.duplicate_keys(joins.repair_dimension(geo_rows, ov)).count() == 0


def test_unmatched_keys_equals_null_probe(obs_rows, geo_rows):
    clean = quality.drop_null(obs_rows, "score")
    anti = sorted(r.fips for r in joins.unmatched_keys(clean, geo_rows).collect())
    probe = sorted(r.fips for r in joins.unmatched_after_join(
        joins.join_dimension(clean, geo_rows, "fips"), "State_Code").collect())
    assert anti == probe == [1004, 46102]


def test_left_join_keeps_rows(obs_rows, geo_rows):
    cov = {r.stage: r.n_rows for r in joins.join_coverage(
        obs_rows, joins.join_dimension(obs_rows, geo_rows)).collect()}
    assert cov["before"] == cov["after"] == 13


def test_sample_is_seeded(spark):
    df = spark.range(10000)
    a = sorted(r.id for r in quality.sample_rows(df, 0.01, seed=7).collect())
    b = sorted(r.id for r in quality.sample_rows(df, 0.01, seed=7).collect())
    assert a == b and 20 < len(a) < 250
    assert quality.extrema(df, ["id"]).first()["max_id"] == 9999
    assert F is not None


def test_hot_key_shuffle_fallback_equals_broadcast(spark):
    """One key holds a third of the fact; a dimension over the broadcast bound
    is shuffle-joined (adaptive skew handling) with the same result."""
    from pyspark.sql import functions as F
    from envstats.operators import severity
    fact = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("fips"),
        (F.col("id") % 11 / 2.0).alias("score"))
    dim = spark.range(1000).select(F.col("id").alias("fips"),
                                   (F.col("id") % 17).cast("string").alias("State_or_Territory"))
    small = joins.join_dimension(fact, dim, "fips", max_rows=10_000)       # broadcast
    big = joins.join_dimension(fact, dim, "fips", max_rows=10)             # shuffle join
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan or "AdaptiveSparkPlan" in plan
    a = sorted(tuple(r) for r in severity.severe_share(small, "State_or_Territory").collect())
    b = sorted(tuple(r) for r in severity.severe_share(big, "State_or_Territory").collect())
    assert a == b and small.count() == big.count() == 30000


def test_broadcast_check_measures_text_bytes(spark):
    rows = [(i, "x" * 1000) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, note string")
    assert joins.fits_broadcast(df, budget_bytes=100_000)       # 50 kB of text
    assert not joins.fits_broadcast(df, budget_bytes=20_000)    # rows fit, bytes do not


def test_one_pass_coverage_counts_fan_out(spark, obs_rows, geo_rows):
    dup = geo_rows.unionByName(geo_rows.where("fips = 1002"))          # key 1002 twice
    want = {r.stage: r.n_rows for r in joins.join_coverage(
        obs_rows, joins.join_dimension(obs_rows, dup)).collect()}
    got = {r.stage: r.n_rows for r in joins.left_join_coverage(obs_rows, [dup]).collect()}
    assert got == want and got["after"] == got["before"] + 4       # four 1002 rows doubled
    two = {r.stage: r.n_rows for r in joins.left_join_coverage(obs_rows, [dup, dup]).collect()}
    assert two["after"] == 13 - 4 + 4 * 4
