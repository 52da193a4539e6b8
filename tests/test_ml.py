import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from envstats.operators import ml, relate


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(5)
    x1, x2 = rng.uniform(0, 1, 3000), rng.uniform(0, 1, 3000)
    y = 3 * x1 - 2 * x2 + rng.normal(0, 0.1, 3000)
    return spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)],
                                 "x1 double, x2 double, score double")


def test_metrics_equal_regression_evaluator(spark, linear):
    pred = linear.withColumn("prediction", linear.x1 * 2.5)
    got = {r.Metric: r.Value for r in ml.regression_metrics(pred).collect()}
    for m, k in (("rmse", "RMSE"), ("mae", "MAE"), ("r2", "R²"), ("mse", "MSE")):
        want = RegressionEvaluator(labelCol="score", predictionCol="prediction",
                                   metricName=m).evaluate(pred)
        assert got[k] == pytest.approx(want, abs=1e-9)


def test_hash_split_disjoint_and_complete(linear):
    a, b = ml.hash_split(linear, (0.8, 0.2), seed=42)
    na, nb = a.count(), b.count()
    assert na + nb == linear.count() and 0.7 < na / (na + nb) < 0.9
    assert a.intersect(b).count() == 0
    a2, _ = ml.hash_split(linear.repartition(7), (0.8, 0.2), seed=42)
    assert a2.exceptAll(a).count() == 0          # same rows whatever the partitioning


def test_missing_features_and_nulls_are_errors(spark, linear):
    with pytest.raises(ValueError, match="x9"):
        ml.fit_gbt(linear, ["x1", "x9"], maxIter=1)
    with pytest.raises(ValueError, match="x9"):
        relate.correlation_matrix(linear, ["x1", "x9"])
    holes = linear.selectExpr("if(x1 < 0.1, null, x1) as x1", "x2", "score")
    with pytest.raises(Exception):
        ml.fit_gbt(holes, ["x1", "x2"], maxIter=1)
    with pytest.raises(Exception):
        relate.correlation_matrix(holes, ["x1", "x2"])
    model = ml.fit_gbt(holes, ["x1", "x2"], maxIter=2, impute=True)
    r = ml.holdout_report(model.transform(holes), holes, holes).first()
    assert r.n_scored == r.n_test == r.n_train == 3000 and r.rmse < r.baseline_rmse


def test_key_split_is_disjoint_and_complete(spark):
    a, b = ml.key_split(spark.range(-50, 1000), "id")
    assert a.count() + b.count() == 1050 and a.intersect(b).count() == 0 and b.count() == 210


def test_building_a_fit_input_starts_no_job(spark):
    from envstats.operators import layout
    spark.sparkContext.setJobGroup("lazy", "lazy")
    df = spark.range(1000).repartition(13).groupBy("id").count()
    layout.spread(df)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_learner_rows_are_dealt_by_their_number(spark, linear, monkeypatch):
    """No partition of a learner's input grows with the table, however few files hold it."""
    from pyspark.ml.regression import RandomForestRegressor

    from envstats.operators import layout
    out = layout.dealt(spark.range(0, 100_000, 1, 1), 9_000)
    sizes = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 12 and max(sizes) <= 9_000 and sum(sizes) == 100_000
    few = spark.range(0, 1000, 1, 1)
    assert layout.dealt(few, 9_000) is few
    seen, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(ml, "FIT_ROWS", 500)
    monkeypatch.setattr(RandomForestRegressor, "fit",
                        lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    model = ml.fit_random_forest(linear.coalesce(1), ["x1", "x2"], numTrees=2, maxDepth=2)
    assert seen == [6] and model.transform(linear).count() == 3000


def test_random_forest_learns(spark, linear):
    train, test = ml.random_split(linear)
    model = ml.fit_random_forest(train, ["x1", "x2"], numTrees=10, maxDepth=5)
    m = {r.Metric: r.Value for r in ml.regression_metrics(model.transform(test)).collect()}
    base = {r.Metric: r.Value for r in ml.regression_metrics(
        test.withColumn("prediction", test.score * 0 + float(train.agg({"score": "avg"}).first()[0])))
        .collect()}
    assert m["RMSE"] < 0.5 * base["RMSE"] and m["R²"] > 0.8
    imp = ml.feature_importance(spark, model, ["x1", "x2"], "rf").collect()
    assert [r.feature for r in imp][-1] == "x1" and sum(r.importance for r in imp) == pytest.approx(1.0)


def test_gbt_fits(spark, linear):
    train, test = ml.random_split(linear)
    model = ml.fit_gbt(train, ["x1", "x2"], maxIter=5, maxDepth=3)
    assert ml.calibration_bins(model.transform(test)).count() > 0


def _tree_lines(model):
    import re
    return [re.sub(r"Predict: .*", "", x).strip() for t in model.stages[-1].trees for x in t.toDebugString.split("\n")[1:]]


@pytest.mark.parametrize("direct", [64, 1])
def test_boosting_over_blocks_makes_the_library_s_trees(spark, linear, monkeypatch, direct):
    """Blocks of a few rows, errors made anew every second step, tables summed in tasks:
    the same splits, predictions, importances and node statistics."""
    from pyspark.ml.regression import GBTRegressor

    from envstats.operators import boosting
    rows = linear.selectExpr("x1", "x2", "round(4 * x1) as x3", "0 * x1 as x4", "score").repartition(3).localCheckpoint()
    names, p = ["x1", "x2", "x3", "x4"], {"maxIter": 5, "maxDepth": 4, "stepSize": 0.3}
    want = ml.fit_gbt(rows, names, **p)
    monkeypatch.setattr(ml, "HELD_ROWS", 0)
    for name, value in (("BLOCK", 700), ("RENEWED", 2), ("DIRECT", direct)):
        monkeypatch.setattr(boosting, name, value)
    monkeypatch.setattr(GBTRegressor, "fit", lambda *a: pytest.fail("an object per row"))
    got = ml.fit_gbt(rows, names, **p)
    assert _tree_lines(got) == _tree_lines(want)
    a, b = got.stages[-1], want.stages[-1]
    assert a.treeWeights == b.treeWeights and a.totalNumNodes == b.totalNumNodes and a.numFeatures == 4
    assert a.featureImportances.toArray() == pytest.approx(b.featureImportances.toArray(), abs=1e-9)
    x, y = ([r.prediction for r in m.transform(rows).orderBy("x1", "x2").collect()] for m in (got, want))
    assert x == pytest.approx(y, abs=1e-9) and a.getMaxDepth() == 4 and a.getLabelCol() == "score"
    root, other = (m._java_obj.trees()[1].rootNode().impurityStats().stats() for m in (a, b))
    assert list(root) == pytest.approx(list(other), rel=1e-9)


def test_boosting_of_one_leaf_and_other_settings(spark, linear, monkeypatch):
    from envstats.operators import boosting
    monkeypatch.setattr(ml, "HELD_ROWS", 0)
    flat = linear.selectExpr("x1", "x2", "2D as score").limit(50)
    model = ml.fit_gbt(flat, ["x1", "x2"], maxIter=2, maxDepth=2)
    assert {r.prediction for r in model.transform(flat).collect()} == {2.0} and model.stages[-1].totalNumNodes == 2
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    assert boosting.supported(GBTRegressor()) and not boosting.supported(RandomForestRegressor())
    for other in ({"subsamplingRate": 0.5}, {"lossType": "absolute"}, {"weightCol": "w"},
                  {"featureSubsetStrategy": "sqrt"}, {"validationIndicatorCol": "v"}):
        assert not boosting.supported(GBTRegressor(**other))


def test_correlation_long_matches_sql_corr(spark, linear):
    c = {(r.feature_x, r.feature_y): r.corr for r in
         relate.correlation_matrix(linear, ["x1", "x2", "score"]).collect()}
    p = {(r.feature_x, r.feature_y): r.corr for r in
         relate.correlation_pairs(linear, ["x1", "x2", "score"]).collect()}
    assert len(c) == 9
    for k, v in c.items():
        assert v == pytest.approx(p[k], abs=1e-12)


def test_hash_sample_layout_independent(linear):
    a = ml.hash_sample(linear, 0.1, seed=7)
    b = ml.hash_sample(linear.repartition(5), 0.1, seed=7)
    n = a.count()
    assert 150 < n < 450 and b.count() == n and a.exceptAll(b).count() == 0
