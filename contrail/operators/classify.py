"""Flight-phase classifier with MLlib (random forest).

Stages: label index (invalid labels skipped) -> assemble the 7 features
(rows with invalid values skipped) -> scale by standard deviation (no
centring) -> random forest -> label decoding. The decoder is built from the
label indexer that was actually fitted (on the training split), so decoded
labels always match the indexes the forest learned.

Training and scoring are distributed MLlib jobs; only the fitted model and
the handful of metric values reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions import row_score
from contrail.session import materialize

FEATURES = list(K.FEATURE_COLUMNS)
LABEL = "flight_phase"
# Training rows up to which MLlib trains the forest on the rows themselves (it keeps about 1 kB a row for 100 trees, and
# reads all of it in every level). Beyond, equal rows are counted points (``forest_training``).
MLLIB_ROWS = 1_000_000


def ml_input(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> DataFrame:
    """Rows with a label; NULL features -> 0."""
    return df.filter(F.col(label).isNotNull()).fillna(0, subset=list(features))


def build_pipeline(features: Sequence[str] = FEATURES, label: str = LABEL, trees: int = K.RF_TREES,
                   depth: int = K.RF_DEPTH, seed: int = K.RF_SEED) -> Pipeline:
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip"),
        VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=False),
        # maxMemoryInMB / cacheNodeIds only change how many nodes are split per
        # pass over the data (fewer passes); the trees are the same.
        RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed,
                               maxMemoryInMB=1024, cacheNodeIds=True),
    ])


def in_training(df: DataFrame, train_fraction: float = K.TRAIN_FRACTION, seed: int = K.SPLIT_SEED) -> Column:
    """Whether a row is a training row, by a hash of (seed, aircraft, time, airport)."""
    return row_score(df, seed) < F.lit(f"{min(int(train_fraction * 2 ** 32), 2 ** 32 - 1):08x}")


def split(df: DataFrame, train_fraction: float = K.TRAIN_FRACTION, seed: int = K.SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(training rows, test rows) by :func:`in_training`.

    A row's side does not depend on layout or on how often the input is computed; the observations
    that share aircraft, time and airport go together.
    """
    training = in_training(df, train_fraction, seed)
    return df.where(training), df.where(~training)


def points(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL, **times: Column) -> DataFrame:
    """Equal rows (features and label) as one, with the number of those for which each condition in ``times`` holds."""
    return df.groupBy(*features, label).agg(*[F.count_if(of).alias(name) for name, of in times.items()])


def sides(df: DataFrame) -> DataFrame:
    """:func:`points` with ``train_rows`` and ``test_rows``."""
    return points(df, train_rows=in_training(df), test_rows=~in_training(df))


def label_index(train_df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label value, index) that a fit on ``train_df`` gives: by frequency, ties by name."""
    labels = build_pipeline(label=label).getStages()[0].fit(train_df).labels
    return train_df.sparkSession.createDataFrame(list(zip(labels, map(float, range(len(labels))))), f"{label} string, label double")


def scaled_features(train_df: DataFrame, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``df`` with each feature divided by its sample standard deviation over ``train_df`` (0 where that is 0)."""
    _, assemble, scale, _ = build_pipeline(features).getStages()
    fitted = PipelineModel(stages=[assemble, scale.fit(assemble.transform(train_df))])
    values = vector_to_array("features")
    return fitted.transform(df).withColumns({f: values[i] for i, f in enumerate(features)}).drop("features_raw", "features")


def written_out(counted: DataFrame, times: str) -> DataFrame:
    """Every row of ``counted`` as often as ``times`` says. (In two steps: an array of all its numbers could be of any size.)"""
    step, n = 1000, F.col(times)
    many = counted.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"), F.lit(step).cast("long"))))
    return many.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.least(n - F.col("_k"), F.lit(step).cast("long"))))).drop("_k", times)


def _decoded(stages: Sequence) -> PipelineModel:
    """The fitted stages with the label decoder of the fitted indexer."""
    return PipelineModel(stages=[*stages, IndexToString(inputCol="prediction", outputCol="predicted_label", labels=stages[0].labels)])


def train_counted(counted: DataFrame, times: str, **params) -> PipelineModel:
    """:func:`train` on the rows that ``counted`` (read several times) counts in ``times``: index and scale on every row, the
    forest on counted points."""
    from contrail.operators.forest_training import fit_counted

    index, assemble, scale, forest = build_pipeline(**params).getStages()
    counted = counted.where(F.col(times) > 0)
    rows = written_out(counted, times)
    indexed = index.fit(rows)
    scaled = scale.fit(assemble.transform(indexed.transform(rows)))
    ready = PipelineModel(stages=[indexed, assemble, scaled])
    return _decoded([*ready.stages, fit_counted(forest, ready.transform(counted), times, len(indexed.labels))])


def train(train_df: DataFrame, mllib_rows: int = MLLIB_ROWS, **params) -> PipelineModel:
    """Fit the pipeline, then append the label decoder of the fitted indexer. More than ``mllib_rows`` rows are counted
    first, by features and label."""
    if train_df.limit(mllib_rows + 1).count() <= mllib_rows:
        return _decoded(build_pipeline(**params).fit(train_df).stages)
    named = {k: params[k] for k in ("features", "label") if k in params}
    return train_counted(materialize(points(train_df, **named, train_rows=F.lit(True)), "points"), "train_rows", **params)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def score_once(model: PipelineModel, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """:func:`score`, but every distinct vector of ``df`` (read twice) goes through the forest once and meets its rows in a join."""
    scored = PipelineModel(stages=model.stages[1:]).transform(df.select(*features).distinct())
    return model.stages[0].transform(df).join(scored, list(features))


def _number(times: str | None) -> Column:
    return F.count(F.lit(1)) if times is None else F.sum(times)


def evaluate(predictions: DataFrame, times: str | None = None) -> DataFrame:
    """One row: accuracy and weighted F1 (of rows that stand for ``times`` rows each).

    The forest scores the test rows once: the metrics see only how often each (label, prediction) pair
    occurs, which is persisted in one partition for the two metric passes and released after."""
    pairs = predictions.groupBy("label", "prediction").agg(_number(times).cast("double").alias("times")).coalesce(1).persist()
    try:
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", weightCol="times")
        acc = ev.evaluate(pairs, {ev.metricName: "accuracy"})
        f1 = ev.evaluate(pairs, {ev.metricName: "f1"})
    finally:
        pairs.unpersist()
    return predictions.sparkSession.createDataFrame([(float(acc), float(f1))], "accuracy double, f1 double")


def confusion_matrix(predictions: DataFrame, times: str | None = None) -> DataFrame:
    return predictions.groupBy("flight_phase", "predicted_label").agg(_number(times).alias("count"))


def feature_importance(model: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    forest = next(s for s in model.stages if hasattr(s, "featureImportances"))
    values = forest.featureImportances.toArray().tolist()
    rows = sorted(zip(features, values), key=lambda r: -r[1])
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def predictions_table(predictions: DataFrame) -> DataFrame:
    """Columns kept for the predictions table; the probability vector as an
    array of doubles so any Parquet reader can use it."""
    return predictions.select("event_timestamp", "icao24", "callsign", "flight_phase", "predicted_label",
                              vector_to_array("probability").alias("probability"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
