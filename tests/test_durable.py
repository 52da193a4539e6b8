import os

import pytest
from pyspark.sql import functions as F

from envstats.operators import alerts
from envstats.plans import catalog
from envstats.sources import fixtures as fx
from envstats.streaming import durable as D
from envstats.streaming import stream as S

from .conftest import SF_SMALL
from .test_streaming import _rows

KEYS = ["State_or_Territory", "County_Name"]


@pytest.fixture(scope="module")
def feed_rows(spark):
    return fx.feat(spark, SF_SMALL)


def test_restart_in_mid_feed(spark, feed_rows):
    """Half of the files, stop, the rest on the same checkpoints: append sink and state."""
    feed = D.LiveFeed(spark, feed_rows, rows_per_file=700)
    total, out, agg = len(feed.waiting()), f"{feed.root}/out", f"{feed.root}/agg"
    counts = []
    for share in (0.5, 1.0):
        assert feed.release(share) > 0
        enr = S.enrich_stream(S.read_stream(spark, feed.path, max_files_per_trigger=2))
        S.run_bounded([S.to_parquet(alerts.alert_feed(enr), out, f"{out}-ck"),
                       S.to_snapshot(alerts.region_summary(enr), agg, f"{agg}-ck", keys=KEYS, compact_every=2)], 300)
        counts.append(spark.read.parquet(out).count())
    assert not feed.waiting() and total > 4 and 0 < counts[0] < counts[1]
    enr = fx.enr(spark, SF_SMALL)
    assert _rows(spark.read.parquet(out)) == _rows(alerts.alert_feed(enr))
    assert _rows(S.read_snapshot(spark, agg, KEYS)) == _rows(alerts.region_summary(enr))


def test_rocksdb_state_is_a_table(spark, feed_rows):
    feed = D.LiveFeed(spark, feed_rows, rows_per_file=1500)
    out, before = f"{feed.root}/agg", spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    by_key = lambda df: df.groupBy("fips").agg(F.count("*").alias("n"), F.max("score").alias("top"))
    for share in (0.5, 1.0):
        feed.release(share)
        enr = S.enrich_stream(S.read_stream(spark, feed.path, max_files_per_trigger=2))
        with D.rocksdb(spark):
            q = S.to_snapshot(by_key(enr), out, f"{out}-ck", keys=["fips"], state_partitions=3)
        S.run_bounded([q], 300)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    state = D.state_table(spark, f"{out}-ck", ["fips"], ["n", "top"])
    want = by_key(fx.enr(spark, SF_SMALL).withColumn("fips", F.col("fips").cast("string")))
    assert _rows(state) == _rows(want)
    kept = [f for _, _, names in os.walk(f"{out}-ck/state".replace("file:", "")) for f in names]
    assert any(f.endswith(".changelog") for f in kept)


def test_progress_of_more_batches_than_spark_keeps(spark):
    """120 batches; the listener's table has all of them, recentProgress the last 100."""
    path = S.scratch_path(spark, "many")
    spark.range(0, 240, 1, 120).selectExpr("cast(id as string) as fips", "cast(id as double) as score") \
        .write.option("header", True).csv(f"{path}/in")
    files = len([f for f in os.listdir(f"{path}/in".replace("file:", "")) if f.endswith(".csv")])
    log = D.ProgressLog(spark, every=20)
    df = S.read_stream(spark, f"{path}/in", spark.range(0).selectExpr("'a' as fips", "1.0D as score").schema)
    q = S.to_parquet(df.observe("seen", F.sum("score").cast("long").alias("total")), f"{path}/out", f"{path}/ck")
    S.run_bounded([q], 300)
    log.close()
    assert files > 100 and len(q.recentProgress) <= 100
    r = D.summarise(log.table()).first()
    assert (r.batches, r.rows_in, r.metrics) == (files, 240, {"seen.total": sum(range(240))})
    assert len([f for f in os.listdir(log.path.replace("file:", "")) if f.endswith(".json")]) >= files // 20


def test_malformed_rows_have_a_sink_of_their_own(spark):
    path = S.scratch_path(spark, "rejects")
    rows = fx.obs_raw(spark, SF_SMALL)
    D.stage_raw(rows, f"{path}/in", 900, spoil=F.col("PRECTOT") == 50.0)
    stream = D.read_stream_with_rejects(spark, f"{path}/in", max_files_per_trigger=2)
    log = D.ProgressLog(spark)
    for _ in range(2):                                       # the second run finds nothing new
        S.run_bounded([D.to_good_and_rejects(stream, f"{path}/out", f"{path}/ck")], 300)
    log.close()
    good, lost = D.read_good_and_rejects(spark, f"{path}/out")
    spoiled = rows.where("PRECTOT = 50").count()
    null = rows.where("PRECTOT <> 50 AND score IS NULL").count()
    assert lost.count() == spoiled > 0 and good.count() == rows.count() - spoiled - null
    assert lost.where("_rejected LIKE '%n/a%'").count() == spoiled
    assert D.summarise(log.table()).first().metrics == {
        "feed.rows_read": rows.count(), "feed.rejected": spoiled, "feed.null_score": null}


def test_staged_text_is_compressed_and_dealt_over_the_cores(spark):
    """Compressed files hold the same rows in a third of the bytes at most; a batch has
    as many files as keep all cores reading, and the rows that it had."""
    sizes, rows = {}, {}
    for codec in ("none", "gzip"):
        feed = D.LiveFeed(spark, fx.feat(spark, SF_SMALL), 500, compression=codec)
        names = feed.waiting()
        sizes[codec] = sum(os.path.getsize(f"{feed.staged}/{n}".replace("file:", "")) for n in names)
        assert feed.release() == len(names) > 5 and not feed.waiting()
        rows[codec] = spark.read.schema(S.schemas.STREAM).option("header", True).csv(feed.path)
    assert sizes["gzip"] * 3 < sizes["none"]
    assert rows["none"].exceptAll(rows["gzip"]).count() == 0 == rows["gzip"].exceptAll(rows["none"]).count()
    n, files = catalog._feed_files(spark, SF_SMALL)
    assert n == catalog.STREAM_ROWS_PER_FILE and files == catalog.STREAM_FILES      # small feeds stay as they were
    staged = os.listdir(catalog._stream(spark, SF_SMALL).input.replace("file:", ""))
    assert [f for f in staged if f.endswith(".csv.gz")] and not [f for f in staged if f.endswith(".csv")]


def test_files_of_a_large_feed(spark, monkeypatch):
    monkeypatch.setattr(catalog, "data_version", lambda df: (("f", 600 * 880_000, 0),))
    par = spark.sparkContext.defaultParallelism
    n, files = catalog._feed_files(spark, SF_SMALL)
    assert files >= par and files % catalog.STREAM_FILES == 0
    assert 4 * 880_000 - files < n * files <= 4 * 880_000
