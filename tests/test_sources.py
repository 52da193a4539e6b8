import pytest
from pyspark.sql import functions as F

from envstats import schemas
from envstats.session import scratch_path
from envstats.sources import files
from envstats.streaming import stream as S


def test_csv_round_trip_with_declared_schema(spark, obs_rows):
    path = scratch_path(spark, "csv")
    cols = [f.name for f in schemas.OBS.fields]
    wide = obs_rows.select(*[F.col(c) if c in obs_rows.columns else F.lit(None).cast("double").alias(c)
                             for c in cols])
    wide.write.option("header", True).csv(path)
    back = files.read_observations(spark, path)          # declared schema, NaN -> null
    assert back.schema == schemas.OBS
    assert back.count() == obs_rows.count()
    assert back.where(F.isnan("score")).count() == 0       # NaN normalised
    assert back.where(F.col("score").isNull()).count() == 2
    inferred = files.read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["date"] == "date"


def test_csv_header_is_compared_with_the_schema(spark):
    """Fields are matched by position, so a file with swapped columns fails."""
    path = scratch_path(spark, "pos")
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    df.write.option("header", True).csv(path)
    assert files.read_csv(spark, path, schema=df.schema).collect() == df.collect()
    swapped = spark.createDataFrame([], "b string, a int").schema
    with pytest.raises(Exception, match="header|Header"):
        files.read_csv(spark, path, schema=swapped).collect()
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, path, schema=swapped, rejects=True)


def test_malformed_rows_are_rejected_not_null(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([("1", "2000-01-01", "1.5"), ("2", "soon", "2.5"), ("3", "2000-01-03", "x"),
                           ("4", None, None)], "k string, d string, v string") \
        .write.option("header", True).csv(path)
    schema = spark.createDataFrame([], "k long, d date, v double").schema
    good, bad = files.split_rejects(files.read_csv(spark, path, schema, rejects=True))
    assert sorted(r.k for r in good.collect()) == [1, 4]
    assert sorted(r[0] for r in bad.collect()) == ["2,soon,2.5", "3,2000-01-03,x"]


def test_null_filter_reaches_the_scan(spark, obs_rows):
    from envstats import schemas
    path = scratch_path(spark, "obs")
    obs_rows.write.parquet(path)
    plan = files.read_observations(spark, path, "parquet", schema=obs_rows.schema,
                                   not_null=["score"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(score)" in plan
    assert files.read_observations(spark, path, "parquet", schema=obs_rows.schema,
                                   not_null=["score"]).count() == 11


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace as N

    from envstats.session import shared_dir
    session = N(sparkContext=N(getCheckpointDir=lambda: None, master="spark://host:7077"),
                conf=N(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_stage_csv_file_count(spark):
    path = scratch_path(spark, "stage")
    files.stage_csv(spark.range(2500).coalesce(1), path, rows_per_file=500)
    n = spark.read.option("header", True).csv(path).count()
    parts = spark.sparkContext.wholeTextFiles(path).count()
    assert n == 2500 and parts == 5


def test_publish_parquet_copies_data_only(spark, obs_rows):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    obs_rows.write.parquet(src)
    out = files.publish_parquet(spark, src, dst)
    assert out.count() == obs_rows.count()
    again = files.publish_parquet(spark, src, dst)          # the same version: nothing changes
    assert again.count() == obs_rows.count() and again.inputFiles() == out.inputFiles()


def test_publish_replaces_a_changed_version_only(spark, obs_rows):
    a, b, dst = (scratch_path(spark, n) for n in ("pub-a", "pub-b", "pub-dst"))
    obs_rows.write.parquet(a)
    obs_rows.limit(3).write.parquet(b)
    files.publish_parquet(spark, a, dst)
    first = files.publish_parquet(spark, b, dst)
    assert first.count() == obs_rows.count() + 3
    obs_rows.limit(5).write.mode("overwrite").parquet(a)
    second = files.publish_parquet(spark, a, dst)
    assert second.count() == 5 + 3 and first.count() == obs_rows.count() + 3   # open readers go on
    obs_rows.limit(2).write.mode("overwrite").parquet(a)
    assert files.publish_parquet(spark, a, dst).count() == 2 + 3
    with pytest.raises(Exception):
        first.count()                                       # two versions back: gone
    with pytest.raises(Exception):                          # a manifest is never overwritten
        files._commit(spark, dst, 1, {})


def test_header_of_every_file_is_compared(spark):
    path = scratch_path(spark, "headers")
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    df.coalesce(1).write.option("header", True).csv(path)
    assert files.read_csv(spark, path, df.schema, rejects=True).count() == 1
    df.select("b", "a").coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, path, df.schema, rejects=True)


def test_preview_schema_subset(spark, obs_rows):
    assert files.preview(obs_rows, 3).count() == 3
    sch = {r.column: r.type for r in files.schema_table(spark, obs_rows).collect()}
    assert sch["fips"] == "bigint" and sch["date"] == "date"
    assert files.existing(obs_rows, ["score", "nope", "fips"]) == ["score", "fips"]
    assert files.select_existing(obs_rows, ["score", "nope"]).columns == ["score"]


def test_console_sink_and_timeout(spark, obs_rows):
    path = scratch_path(spark, "console")
    S.stage_input(obs_rows, path + "/in", rows_per_file=5)
    enr = S.enrich_stream(S.read_stream(spark, path + "/in"))
    q = S.to_console(enr.where("high_risk = 1"), checkpoint=path + "/ck", rows=5)
    S.run_bounded([q], 120)
    assert not q.isActive
    # staging drops the null-score and the NaN-score row (dropna semantics)
    assert sum(p["numInputRows"] for p in q.recentProgress) == obs_rows.count() - 2
    slow = S.to_memory(enr, S.unique_name("slow"), "append", trigger="1 second",
                       checkpoint=path + "/ck2")
    with pytest.raises(TimeoutError):
        S.run_bounded([slow], 2)                              # processing-time trigger never ends
    assert not slow.isActive


def test_scale_conf_bounds():
    from envstats.session import scale_conf
    small = scale_conf(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_conf(100 * 1024 ** 4, 8000, large_state=True)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (256 * 1024 ** 2))
    assert scale_conf(100 * 1024 ** 4, 8000, max_partitions=50_000)[
        "spark.sql.shuffle.partitions"] == "50000"
    assert "RocksDB" in big["spark.sql.streaming.stateStore.providerClass"]


def test_materialize_writes_under_shared_folder(spark, obs_rows):
    from envstats.session import shared_dir
    from envstats.sources.files import materialize
    def local(u):   # file:/a, file:///a -> /a
        return "/" + u.split(":", 1)[1].lstrip("/")
    t = materialize(obs_rows, "mat-test")
    assert all(local(f).startswith(local(shared_dir(spark)) + "/") for f in t.inputFiles())
    assert sorted(map(repr, t.collect())) == sorted(map(repr, obs_rows.collect()))


def test_header_check_cleans_few_lines_only(spark):
    """Quoted headers with a byte-order mark and carriage returns still pass, others still fail, and the
    regular expressions are kept to lines with the first name."""
    good, bad = scratch_path(spark, "head-good"), scratch_path(spark, "head-bad")
    spark.createDataFrame([('\ufeff"fips","date"\r',), ("1,2000-01-01",)], "value string").coalesce(1).write.text(good)
    spark.createDataFrame([("date,fips",), ("1,2000-01-01",)], "value string").coalesce(1).write.text(bad)
    files._check_header(spark, good, ["fips", "date"])
    with pytest.raises(ValueError, match="header"):
        files._check_header(spark, bad, ["fips", "date"])
    line = files._is_header(["fips", "date"])
    plan = spark.range(1).selectExpr("'x' value").select(line)._jdf.queryExecution().analyzed().toString()
    assert plan.index("WHEN Contains(") < plan.index("regexp_replace(")
