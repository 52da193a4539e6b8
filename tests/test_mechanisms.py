"""Salted joins, digests, co-moments, incremental summaries and trees as data."""

import statistics

import pytest
from pyspark.sql import functions as F

from envstats import constants as C
from envstats.operators import ensemble, incremental, joins, ml, quality, relate
from envstats.plans import catalog
from envstats.session import scratch_path
from envstats.sources import fixtures as fx

from .conftest import SF_SMALL


def _same(a, b):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(key, a.collect())) == sorted(map(key, b.select(a.columns).collect()))


def _exchanged(spark, df):
    """Bytes that the exchanges of a plan received (adaptive execution off)."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df()._jdf.queryExecution()
        plan.toRdd().count()

        def walk(node):
            kids = node.children()
            own = node.metrics().get("dataSize").get().value() if node.nodeName() == "Exchange" else 0
            return own + sum(walk(kids.apply(i)) for i in range(kids.size()))
        return walk(plan.executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_hot_keys_and_salted_join(spark):
    """A third of the rows on one key: no task above twice the median, the rows of the plain join."""
    fact = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 101 = 0 THEN NULL ELSE 100 + id % 4001 END AS fips", "id", "id % 5 AS v")
    dim = spark.range(0, 3000).selectExpr("id + 5 AS fips", "concat('n', id) AS name")
    assert set(joins.hot_keys(fact, "fips", 0.05)) == {7}
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        out = joins.salted_left_join(fact, dim)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = [r["count"] for r in fact.join(dim.hint("merge"), "fips", "left")
                 .groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) <= 2 * statistics.median(sizes) and max(plain) > 3 * statistics.median(plain)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert out.columns == ["fips", "id", "v", "name"] and _same(out, fact.join(dim, "fips", "left"))
    few = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "fips long, x string")
    assert _same(joins.salted_left_join(few, dim), few.join(dim, "fips", "left"))
    assert joins.salted_left_join(few.limit(0), dim).count() == 0


def test_dedup_by_digest_exchanges_digests(spark, monkeypatch):
    rows = fx.obs_raw(spark, SF_SMALL)
    df = rows.unionByName(rows.where("fips % 10 = 0")).withColumn("nan", F.when(F.col("fips") % 2 == 0, float("nan")))
    got = quality.dedup_by_digest(df)
    assert _same(got, quality.dedup(df)) and got.count() < df.count()
    assert _exchanged(spark, lambda: got) * 3 <= _exchanged(spark, lambda: quality.dedup(df))
    # one digest for all rows: every row is compared by value
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    same = quality.dedup_by_digest(df)
    monkeypatch.undo()
    assert _same(same, quality.dedup(df))
    assert quality.dedup_by_digest(df.limit(0)).count() == 0


def test_pairwise_correlation_skips_null_pairs(spark):
    df = fx.feat(spark, SF_SMALL, dims=()).selectExpr(
        "CASE WHEN fips % 3 = 0 THEN NULL ELSE T2M + 1e7 END AS a", "PRECTOT AS b",
        "CASE WHEN fips % 5 = 0 THEN NULL ELSE T2M_MAX END AS c", "5.0D AS same", "CAST(NULL AS DOUBLE) AS none")
    cols = ["a", "b", "c", "same", "none"]
    got = {(r[0], r[1]): r[2] for r in relate.correlation_pairs(df, cols).collect()}
    want = df.agg(*[F.corr(x, y).alias(f"{x}|{y}") for x in cols[:3] for y in cols[:3]]).first().asDict()
    assert len(got) == 25
    for k, v in got.items():
        w = want.get("|".join(k))                 # a constant or empty column has none
        assert (v is None) == (w is None or w != w) and (v is None or abs(v - w) < 1e-9), (k, v, w)
    plan = relate.correlation_pairs(df, cols)._jdf.queryExecution().optimizedPlan().toString()
    assert "corr(" not in plan.lower().replace("aggregatemetrics", "")


def test_incremental_summary_reads_new_files_only(spark):
    root, path = scratch_path(spark, "inc"), scratch_path(spark, "inc-in")
    rows = fx.feat(spark, SF_SMALL, dims=()).select("fips", "score", "year")
    s = incremental.Summary(spark, root, lambda p: spark.read.schema(rows.schema).parquet(*p),
                            {"fips": F.col("fips")}, {"n": F.lit(1), "total": F.col("score")})
    want = lambda df: df.groupBy("fips").agg(F.count("*").alias("n"), F.sum("score").alias("total"))
    near = lambda a, b: [(r.fips, r.n, round(r.total, 6)) for r in a.orderBy("fips").collect()] == [
        (r.fips, r.n, round(r.total, 6)) for r in b.orderBy("fips").collect()]
    rows.where("year < 1998").repartition(3).write.parquet(path)
    assert len(s.update(path)) == 3 and near(s.table(), want(rows.where("year < 1998")))
    assert s.update(path) == []
    rows.where("year >= 1998").repartition(2).write.mode("append").parquet(path)
    new = s.update(path)
    assert len(new) == 2 and near(s.table(), want(rows))
    assert {f.replace(":///", ":/") for f in spark.read.parquet(*new).inputFiles()} == set(new)
    rows.where("year >= 1998").write.mode("overwrite").parquet(path)       # all files replaced
    s.update(path)
    assert near(s.table(), want(rows.where("year >= 1998")))


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_trees_as_data(spark, kind):
    """Native scoring and importances from the saved nodes equal the library's on every row."""
    rows = fx.model_rows(spark, SF_SMALL).limit(1500)
    fit = {"random_forest": lambda: ml.fit_random_forest(rows, C.MODEL_FEATURES, impute=True, numTrees=5, maxDepth=4),
           "gbt": lambda: ml.fit_gbt(rows, C.MODEL_FEATURES, impute=True, maxIter=4, maxDepth=3)}[kind]()
    path = scratch_path(spark, "trees")
    fit.write().save(path)
    model = ml.PipelineModel.load(path)
    scored = catalog._tree_scores(spark, model, path, rows, kind)
    assert scored.where("abs(prediction - tree_prediction) > 1e-9").count() == 0 and scored.count() == 1500
    got = {r.feature: r.importance for r in
           ensemble.importances(ensemble.node_table(spark, path, model), C.MODEL_FEATURES, kind != "gbt").collect()}
    want = dict(zip(C.MODEL_FEATURES, model.stages[-1].featureImportances.toArray()))
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-9 for f in got)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_scored_rows_carry_no_tree_arrays(spark):
    """A row keeps its own columns: the trees are constants, and a leaf reached early stays."""
    nodes = spark.createDataFrame([(0, 0, 0, 1.5, 1, 2, 9.0, 1.0), (0, 1, -1, None, -1, -1, 3.0, 1.0),
                                   (0, 2, 1, 0.0, 3, 4, 9.0, 1.0), (0, 3, -1, None, -1, -1, 5.0, 1.0),
                                   (0, 4, -1, None, -1, -1, 7.0, 1.0), (1, 0, -1, None, -1, -1, 11.0, 0.5)],
                                  "tree int, node int, feature int, threshold double, low int, high int, "
                                  "value double, weight double")
    rows = spark.createDataFrame([(1.0, 0.0), (2.0, -0.0), (2.0, 0.1), (float("nan"), float("nan"))], "a double, b double")
    out = ensemble.score(rows, ensemble.compiled(nodes, mean=False), ["a", "b"], 2)
    assert [r.tree_prediction for r in out.collect()] == [8.5, 10.5, 12.5, 12.5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == ["a", "b", "tree_prediction"] and "Join" not in plan


def test_random_split_is_a_partition(spark):
    r = catalog.q_random_split(spark, SF_SMALL).first()
    assert r.n_both == r.n_lost == 0 and r.n_rows > 5000 and r.share_within_bounds
