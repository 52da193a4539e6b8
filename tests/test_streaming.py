import os

import pytest
from pyspark.sql import functions as F

from envstats.operators import alerts, trends
from envstats.sources import fixtures as fx
from envstats.streaming import stream as S

from .conftest import SF_SMALL


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def run(spark):
    return S.StreamRun(spark, fx.feat(spark, SF_SMALL), rows_per_file=600, max_files_per_trigger=1)


def test_staging_splits_files_and_progress_counts_rows(spark, run):
    files = [f for f in os.listdir(run.input.replace("file:", "")) if f.endswith(".csv")]
    staged = spark.read.schema(S.schemas.STREAM).option("header", True).csv(run.input).count()
    assert len(files) >= staged // 600
    name = S.unique_name("mem")
    q = S.to_memory(run.enriched(), name, "append", checkpoint=f"{run.root}/{name}-ck")
    S.run_bounded([q], 300)
    fed = sum(p["numInputRows"] for p in q.recentProgress)
    assert fed == staged == spark.table(name).count()
    # maxFilesPerTrigger=1 holds under availableNow: one non-empty batch per file
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == len(files)
    assert S.progress_table(spark, q).agg(F.sum("numInputRows")).first()[0] == staged


def test_stream_equals_batch(spark, run):
    enr = fx.enr(spark, SF_SMALL)
    s = run.aggregate(alerts.region_summary, ["State_or_Territory", "County_Name"])
    assert _rows(s) == _rows(alerts.region_summary(enr))
    m = run.aggregate_in_memory(trends.month_bucket_trend)
    assert _rows(m) == _rows(trends.month_bucket_trend(enr))
    a = run.append_parquet(alerts.alert_feed)
    assert _rows(a) == _rows(alerts.alert_feed(enr))


def test_parquet_sink_restart_adds_nothing(spark, run):
    out, ck = f"{run.root}/restart", f"{run.root}/restart-ck"
    S.run_bounded([S.to_parquet(run.enriched(), out, ck)], 300)
    n1 = spark.read.parquet(out).count()
    S.run_bounded([S.to_parquet(run.enriched(), out, ck)], 300)
    assert spark.read.parquet(out).count() == n1 > 0


def test_is_streaming(spark, run):
    assert run.enriched().isStreaming


def test_snapshot_compaction_equals_batch(spark, run):
    keys = ["State_or_Territory", "County_Name"]
    enr = fx.enr(spark, SF_SMALL)
    before = set(os.listdir(run.root.replace("file:", "")))
    s = run.aggregate(alerts.region_summary, keys, compact_every=1)   # a full table every batch
    assert _rows(s) == _rows(alerts.region_summary(enr))
    full = [d for d in set(os.listdir(run.root.replace("file:", ""))) - before if d.endswith("-full")]
    assert full, "a full table was written (the run has more than two batches)"
    # the last two full tables stay, older ones and the deltas they cover are gone
    root = run.root.replace("file:", "")
    batches = sorted(int(n.split("=")[1]) for n in os.listdir(f"{root}/{full[0]}")
                     if n.startswith("batch_id="))
    assert len(batches) == 2
    deltas = [int(n.split("=")[1]) for n in os.listdir(f"{root}/{full[0].removesuffix('-full')}")
              if n.startswith("batch_id=")]
    assert deltas and min(deltas) > batches[0]


def test_snapshot_folder_does_not_grow_with_batches(spark):
    """Files listed and read stay constant over 60 batches; replays change nothing."""
    path = S.scratch_path(spark, "snap")
    seen = []
    for n in range(1, 61):
        for _ in range(2 if n % 7 == 0 else 1):                     # some batches are replayed
            spark.createDataFrame([(n % 5, n), (99, 1)], "k int, v int").coalesce(1) \
                .write.mode("overwrite").parquet(f"{path}/batch_id={n}")
            if n % 4 == 0:
                S.read_snapshot(spark, path, ["k"], upto=n, base_before=True).coalesce(1) \
                    .write.mode("overwrite").parquet(f"{path}-full/batch_id={n}")
                S._point(spark, path, n)
                S._retain(spark, path, n - 4)
        seen.append(len(S._batches(spark, path)) + len(S._batches(spark, f"{path}-full")))
    assert max(seen[20:]) <= max(seen[:20]) <= 11
    got = {r.k: r.v for r in S.read_snapshot(spark, path, ["k"]).collect()}
    assert got == {0: 60, 1: 56, 2: 57, 3: 58, 4: 59, 99: 1}


def test_state_partitions_set_for_the_stream_only(spark, run):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    name = S.unique_name("mem")
    q = S.to_memory(alerts.region_summary(run.enriched()), name, "complete",
                    checkpoint=f"{run.root}/{name}-ck", state_partitions=3)
    S.run_bounded([q], 300)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ops = [p["stateOperators"] for p in q.recentProgress if p.get("stateOperators")]
    assert ops and all(o[0]["numShufflePartitions"] == 3 for o in ops)


def test_severe_alerts_reach_the_driver_as_counts(spark, monkeypatch):
    """No memory table holds more rows than there are regions."""
    from envstats.plans import catalog
    from envstats.streaming import stream
    names, start = [], stream.to_memory

    def to_memory(df, name, *args, **kwargs):
        names.append(name)
        return start(df, name, *args, **kwargs)

    monkeypatch.setattr(stream, "to_memory", to_memory)
    rows = catalog.q_stream_severe_memory(spark, SF_SMALL).collect()
    assert len(names) == 1 and spark.table(names[0]).count() == len(rows)
    assert sum(r.alert_count for r in rows) > len(rows) > 0


def test_append_memory_table_of_a_bounded_feed(spark):
    from envstats.plans import catalog
    run = catalog._stream(spark, SF_SMALL)
    t = run.append_in_memory(lambda s: s.where("score >= 5").select("State_or_Territory"))
    want = {r[0]: r.alert_count for r in catalog.q_stream_severe_memory(spark, SF_SMALL).collect()}
    assert {r[0]: r["count"] for r in t.groupBy("State_or_Territory").count().collect()} == want
