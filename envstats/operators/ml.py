"""Tree-ensemble regression on Spark ML (ML-1..9).

* splits: Spark's ``randomSplit`` (the source's choice; it sorts every
  partition by all columns and its rows depend on the partition layout,
  T12), a seeded hash split (same rows on every run and cluster size, a
  filter in the scan stage: no sort, no shuffle; used by the named model
  queries), and a time split;
* fits: ``Pipeline(VectorAssembler, RandomForestRegressor | GBTRegressor)``
  with the source's settings; GBT checkpoints its lineage in the shared
  folder every ``checkpointInterval`` iterations;
* metrics: RMSE, MAE, R², MSE in **one** aggregate pass (the source runs
  four evaluator jobs), long form (model, Metric, Value);
* importances: (model, feature, importance), one row per feature.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats import constants as C
from envstats.operators import boosting
from envstats.operators.layout import dealt, spread
from envstats.session import shared_dir
from envstats.sources.files import materialize


def require(df: DataFrame, features) -> list[str]:
    """The features, all of which ``df`` must have: a model is never fitted on
    fewer features than asked for."""
    missing = [c for c in features if c not in set(df.columns)]
    if missing:
        raise ValueError(f"features not in the table: {missing}")
    return list(features)


def random_split(df: DataFrame, weights=C.SPLIT_WEIGHTS, seed: int = C.SPLIT_SEED):
    """Spark's random split (ML-3)."""
    return df.randomSplit(list(weights), seed=seed)


def hash_split(df: DataFrame, weights=C.SPLIT_WEIGHTS, seed: int = C.SPLIT_SEED, cols=None):
    """Split by a seeded hash of the row (or of ``cols``): independent of
    partitioning, so the same row always lands on the same side."""
    cols = list(cols or df.columns)
    # pmod, not abs(h) % m: abs of the smallest long overflows (an error under ANSI)
    u = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(1_000_000)) \
        / F.lit(1_000_000.0)
    total = float(sum(weights))
    out, lo = [], 0.0
    for w in weights:
        hi = lo + w / total
        cond = (u >= F.lit(lo)) & ((u < F.lit(hi)) if hi < 1.0 else F.lit(True))
        out.append(df.where(cond))
        lo = hi
    return out


def key_split(df: DataFrame, key: str, parts: int = 5):
    """(train, test) by arithmetic on an integer key: rows whose key is
    divisible by ``parts`` test.  The same rows everywhere, also in SQL."""
    held = F.pmod(F.col(key), F.lit(parts)) == 0
    return df.where(~held), df.where(held)


def time_split(df: DataFrame, date_col: str, cutoff: str):
    """Rows before ``cutoff`` train, the rest test (no look-ahead leak)."""
    c = F.col(date_col) < F.lit(cutoff).cast("date")
    return df.where(c), df.where(~c)


def _assembled_model(reg, features, handle_invalid: str, impute: bool) -> Pipeline:
    """[mean imputer,] assembler, learner.  A null feature is an error unless the
    caller imputes it (training mean) or says "skip" or "keep"."""
    names = [f"{c}__filled" for c in features] if impute else list(features)
    va = VectorAssembler(inputCols=names, outputCol="features", handleInvalid=handle_invalid)
    fill = [Imputer(inputCols=list(features), outputCols=names, strategy="mean")] if impute else []
    return Pipeline(stages=[*fill, va, reg])


HELD_ROWS = 250_000      # rows a core, from which boosting reads blocks: more than executors hold as objects
FIT_ROWS = 250_000       # most rows of a learner's partition: about 1 KB each in a forest's cache


def _fit(pipeline: Pipeline, train: DataFrame, columns) -> PipelineModel:
    """Fit on the needed columns of ``train``, written once to the shared folder.
    The learner reads its input several times before its own tree cache exists
    (row count, means, split candidates, binning); those passes scan the pruned
    rows instead of re-running the joins and the split, and a lost executor
    costs a re-read.  The learner's rows are dealt by their number: a task of a
    tree level reads the cached rows of one partition, so its bytes stay the same
    however large the table is, and all cores take part."""
    rows = materialize(spread(train.select(*columns)), "fit-input")
    *before, learner = pipeline.getStages()
    done = []
    for stage in before:
        done.append(stage.fit(rows) if isinstance(stage, Estimator) else stage)
        rows = done[-1].transform(rows)
    rows = rows.select(learner.getFeaturesCol(), learner.getLabelCol())
    if boosting.supported(learner) and rows.count() > HELD_ROWS * train.sparkSession.sparkContext.defaultParallelism:
        return PipelineModel([*done, boosting.fit(learner, rows)])
    return PipelineModel([*done, learner.fit(dealt(rows, FIT_ROWS))])


def fit_random_forest(train: DataFrame, features, label: str = "score",
                      handle_invalid: str = "error", impute: bool = False,
                      **params) -> PipelineModel:
    """Random forest regressor, 50 trees, depth 8, seed 42 by default (ML-4).

    Node ids of the rows are cached between levels (``cacheNodeIds``; the
    learned trees are the same) so deep levels do not walk every tree from
    its root for every row; the cache's lineage is checkpointed in the
    shared folder every ``checkpointInterval`` levels.  Measured at sf0.1:
    the fit takes about 30 % less time.  Boosting keeps the default: its
    trees are shallow and there it was slower.
    """
    shared_dir(train.sparkSession)
    p = {"cacheNodeIds": True, "checkpointInterval": 10}
    p.update(C.RF_PARAMS)
    p.update(params)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label,
                               predictionCol="prediction", **p)
    features = require(train, features)
    return _fit(_assembled_model(rf, features, handle_invalid, impute), train, [*features, label])


def fit_gbt(train: DataFrame, features, label: str = "score",
            handle_invalid: str = "error", impute: bool = False,
            checkpoint_interval: int = 10, **params) -> PipelineModel:
    """Gradient-boosted trees, 50 iterations, depth 5, step 0.1 (ML-5).

    Iterations are sequential; lineage is cut every ``checkpoint_interval``
    iterations in the shared checkpoint folder so a lost executor does not
    replay the whole chain.  From ``HELD_ROWS`` rows a core on the same trees are
    grown over binned blocks (``boosting``).
    """
    shared_dir(train.sparkSession)
    p = dict(C.GBT_PARAMS)
    p.update(params)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                       checkpointInterval=checkpoint_interval, **p)
    features = require(train, features)
    return _fit(_assembled_model(gbt, features, handle_invalid, impute), train, [*features, label])


def regression_metrics(pred: DataFrame, label: str = "score", prediction: str = "prediction",
                       model: str = "model") -> DataFrame:
    """RMSE, MAE, R², MSE in one pass; long form (model, Metric, Value) (ML-6, ML-7).

    R2 = 1 - SSE / SST with SST = sum((y - mean(y))^2) = sum(y^2) - n*mean^2,
    the same definition as ``RegressionEvaluator``.
    """
    y, yh = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - yh
    s = (pred.where(y.isNotNull() & yh.isNotNull())
             .agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"),
                  F.sum(F.abs(e)).alias("sae"), F.avg(y).alias("ybar"),
                  F.var_pop(y).alias("vy")))
    mse = F.try_divide(F.col("sse"), F.col("n").cast("double"))
    r2 = F.lit(1.0) - F.try_divide(F.col("sse"), F.col("vy") * F.col("n"))
    values = (F.sqrt(mse), F.try_divide(F.col("sae"), F.col("n").cast("double")), r2, mse)
    arr = F.array(*[F.struct(F.lit(k).alias("Metric"), v.alias("Value"))
                    for k, v in zip(C.METRIC_NAMES, values)])
    return s.select(F.lit(model).alias("model"), F.inline(arr))


def holdout_report(pred: DataFrame, test: DataFrame, train: DataFrame, label: str = "score",
                   prediction: str = "prediction", model: str = "model") -> DataFrame:
    """One row: sizes of both sides, rows scored (all of the test side, or rows
    were lost), the RMSE and R2 of the model and the RMSE of the training mean."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    fit = train.agg(F.count("*").alias("n_train"), F.avg(label).alias("__mean"))
    total = test.agg(F.count("*").alias("n_test"))
    got = pred.crossJoin(F.broadcast(fit)).agg(                  # one row
        F.max("n_train").alias("n_train"), F.count(prediction).alias("n_scored"),
        F.avg(y).alias("label_mean"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sqrt(F.avg((y - F.col("__mean")) * (y - F.col("__mean")))).alias("baseline_rmse"),
        (F.lit(1.0) - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"))
    return got.crossJoin(F.broadcast(total)).withColumn("model", F.lit(model))


def key_sample(df: DataFrame, key: str, every: int) -> DataFrame:
    """Rows whose integer key is divisible by ``every`` (about one in ``every``),
    the same everywhere."""
    return df.where(F.pmod(F.col(key), F.lit(every)) == 0)


def feature_importance(spark, model: PipelineModel, features, name: str = "model") -> DataFrame:
    """(model, feature, importance), ascending by importance (ML-8).
    One row per feature: a size fixed by the feature list."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(name, f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "model string, feature string, importance double") \
                .orderBy("importance", "feature")


def calibration_bins(pred: DataFrame, label: str = "score", prediction: str = "prediction") -> DataFrame:
    """Scalable actual-vs-predicted view (ML-9): per rounded actual score,
    count, mean actual, mean prediction."""
    return (pred.groupBy(F.round(F.col(label)).alias("score_bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("avg_actual"),
                     F.avg(prediction).alias("avg_prediction"))
                .orderBy("score_bin"))


def hash_sample(df: DataFrame, fraction: float, seed: int = C.SPLIT_SEED, cols=None) -> DataFrame:
    """Bernoulli-style sample by a seeded hash of the row (or of ``cols``):
    a filter in the scan stage that keeps the same rows on every run and
    cluster layout (``DataFrame.sample`` seeds each partition by its index,
    so its rows change with the partitioning)."""
    cols = list(cols or df.columns)
    u = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(1_000_000))
    return df.where(u < F.lit(int(round(fraction * 1_000_000))))


def actual_vs_predicted(pred: DataFrame, fraction: float = 0.01, seed: int = 42,
                        label: str = "score", prediction: str = "prediction") -> DataFrame:
    """Seeded sample of (actual, predicted) pairs (ML-9, SMP-2), the same rows
    on any partition layout.  The hash covers the whole scored row (its
    feature values), not only the pair: many rows share a (score,
    prediction) pair, and hashing the pair alone would keep or drop them
    together."""
    from pyspark.ml.linalg import VectorUDT
    vector_cols = {f.name for f in pred.schema.fields if isinstance(f.dataType, VectorUDT)}
    cols = [c for c in pred.columns if c not in vector_cols]
    return hash_sample(pred, fraction, seed, cols=cols).select(label, prediction)


def group_mean_model(train: DataFrame, test: DataFrame, key: str, label: str = "score",
                     prediction: str = "prediction") -> DataFrame:
    """Baseline: predict the training mean of the row's group, else the
    global training mean.

    The training rows are read once: per group, the sum and count of the
    label (one row per group) are written as a reliable checkpoint in the
    shared folder; the group means and the global mean (one scalar, total
    sum over total count) both come from that small table.  The group means
    are joined with a size-checked broadcast."""
    from envstats.operators.joins import sized_broadcast
    shared_dir(train.sparkSession)
    y = F.col(label).cast("double")
    stats = (train.groupBy(key).agg(F.sum(y).alias("__s"), F.count(y).alias("__n"))
                  .checkpoint(eager=True))
    g = stats.agg(F.try_divide(F.sum("__s"), F.sum("__n").cast("double"))).first()[0]
    means = stats.select(key, F.try_divide(F.col("__s"), F.col("__n").cast("double")).alias("__m"))
    return (test.join(sized_broadcast(means), on=key, how="left")
                .withColumn(prediction, F.coalesce(F.col("__m"), F.lit(g).cast("double")))
                .drop("__m"))
