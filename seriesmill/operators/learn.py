"""Fitted pipelines with pyspark.ml: encode, scale, estimate, score, explain."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.columns import share_of_total, without_step_prefix
from seriesmill.operators.splits import fold_bounds
from seriesmill.sources.publish import publish, recover

FEATURES = "features"
#: Rows of a task of a regressor that passes over its rows many times; each pass ends with its longest task.
ROWS_PER_TASK = 250_000


def linear(target: str) -> LinearRegression:
    """Ordinary least squares by the normal equations: one pass over the rows."""
    return LinearRegression(
        featuresCol=FEATURES, labelCol=target, regParam=0.0, solver="normal", standardization=False
    )


def boosted_trees(
    target: str,
    rounds: int = 100,
    validation: str | None = None,
    min_gain: float = 0.0,
    **settings,
) -> GBTRegressor:
    """Boosted trees of depth 3 that look at half of the features per split.

    ``min_gain`` is the variance a split has to remove from its node; it is the nearest setting to a
    minimum loss reduction, but in another unit.

    With ``validation``, a boolean column marks the rows that decide when to stop early.
    """
    chosen = {
        "maxDepth": 3,
        "stepSize": 0.3,
        "featureSubsetStrategy": "0.5",
        "seed": 42,
        "minInfoGain": min_gain,
        **settings,
    }
    trees = GBTRegressor(featuresCol=FEATURES, labelCol=target, maxIter=rounds, **chosen)
    return trees.setValidationIndicatorCol(validation) if validation else trees


def pipeline_for(
    regressor: Estimator,
    numeric: Sequence[str],
    category: str | None,
    rows: int,
    scale: str = "z",
) -> Pipeline:
    """Unfitted pipeline: dummies of ``category`` (first one dropped) and z-scores of ``numeric``.

    ``scale="minmax"`` maps the numeric columns to 0..1 by the extremes of the training rows instead.

    The scaler divides by the sample deviation; the factor after it turns that into the
    population deviation for ``rows`` training rows. An unknown category is an error.
    """
    stages, parts = [], []
    if category:
        code, dummies = f"{category}_code", f"{category}_dummies"
        stages += [
            StringIndexer(
                inputCol=category,
                outputCol=code,
                stringOrderType="alphabetDesc",
                handleInvalid="error",
            ),
            OneHotEncoder(inputCols=[code], outputCols=[dummies], dropLast=True),
        ]
        parts.append(dummies)
    factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    numbers = VectorAssembler(inputCols=list(numeric), outputCol="_numeric")
    if scale == "minmax":
        scaler = MinMaxScaler(inputCol="_numeric", outputCol="_scaled")
        assembled = VectorAssembler(inputCols=[*parts, "_scaled"], outputCol=FEATURES)
        return Pipeline(stages=[*stages, numbers, scaler, assembled, regressor])
    if scale != "z":
        raise ValueError("scale is 'z' or 'minmax'")
    stages += [
        numbers,
        StandardScaler(inputCol="_numeric", outputCol="_sample_z", withMean=True, withStd=True),
        ElementwiseProduct(
            scalingVec=Vectors.dense([factor] * len(numeric)),
            inputCol="_sample_z",
            outputCol="_scaled",
        ),
        VectorAssembler(inputCols=[*parts, "_scaled"], outputCol=FEATURES),
        regressor,
    ]
    return Pipeline(stages=stages)


def fit(
    df: DataFrame,
    regressor: Estimator,
    numeric: Sequence[str],
    category: str | None = None,
    fit_on: Column | None = None,
    scale: str = "z",
) -> PipelineModel:
    """Fit on the rows where ``fit_on`` holds (all rows by default)."""
    rows = df if fit_on is None else df.where(fit_on)
    size = rows.count()
    pipeline = pipeline_for(regressor, numeric, category, size, scale)
    if not isinstance(regressor, GBTRegressor) or size <= ROWS_PER_TASK:
        return pipeline.fit(rows)
    # Trees pass over the rows some times a round: these are dealt evenly once, a whole number of tasks to each core.
    encoders = Pipeline(stages=pipeline.getStages()[:-1]).fit(rows)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    late = [regressor.getValidationIndicatorCol()] if regressor.isSet("validationIndicatorCol") else []
    dealt = encoders.transform(rows).select(FEATURES, regressor.getLabelCol(), *late)
    dealt = dealt.repartition(cores * -(-size // (cores * ROWS_PER_TASK)))
    return PipelineModel([*encoders.stages, regressor.fit(dealt)])


def score(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    """Add the prediction to the rows; helper columns are dropped."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(out))


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the assembled features in slot order, with their step as prefix."""
    names: list[str] = []
    for stage in model.stages:
        if stage.__class__.__name__ == "StringIndexerModel":
            column = stage.getInputCol()
            names += [f"cat__{column}_{label}" for label in stage.labels[:-1]]
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return names + [f"scale__{name}" for name in inputs]


def importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance, pct), one row per feature, from the fitted trees or coefficients."""
    fitted = model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        values = fitted.featureImportances.toArray()
    else:
        values = abs(fitted.coefficients.toArray())
    rows = list(zip(feature_names(model), map(float, values)))
    frame = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    total = F.lit(float(values.sum()) or None).cast("double")
    return frame.select(
        without_step_prefix(F.col("feature")).alias("feature"),
        "importance",
        share_of_total(F.col("importance"), total).alias("pct"),
    )


def top_features(importances: DataFrame, k: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("pct"), F.asc("feature")).limit(k)


def cross_validate(
    df: DataFrame,
    regressor: Callable[[], Estimator],
    numeric: Sequence[str],
    category: str | None = None,
    folds: int = 5,
    idx: str = "idx",
) -> DataFrame:
    """Test predictions of expanding-window folds, with ``fold``.

    Every fold refits the whole pipeline on the rows before its test range. ``df``
    should be staged, since each fold reads it again.
    """
    tested = []
    for fold, start, end in fold_bounds(df.count(), folds):
        model = fit(df, regressor(), numeric, category, F.col(idx) < start)
        part = df.where((F.col(idx) >= start) & (F.col(idx) < end))
        tested.append(score(model, part).withColumn("fold", F.lit(fold)))
    return reduce(DataFrame.unionByName, tested)


#: A fitted linear model as a table: one row per feature, one for the intercept. A category's dummy has its ``level``.
PARAMETERS = "feature string, level string, coefficient double, mean double, deviation double"


def linear_parameters(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """What a linear model has learned: coefficients with the mean and deviation its numeric features are scaled by.

    The intercept has no feature. A constant feature has deviation 0 and counts as 0.
    """
    steps = {s.__class__.__name__: s for s in model.stages}
    fitted, indexer = model.stages[-1], steps.get("StringIndexerModel")
    scaler, factor = steps["StandardScalerModel"], steps["ElementwiseProduct"].getScalingVec()
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    slopes = [float(v) for v in fitted.coefficients.toArray()]
    rows = [(None, None, float(fitted.intercept), None, None)]
    if indexer:
        rows += [(indexer.getInputCol(), level, slopes[i], None, None) for i, level in enumerate(indexer.labels[:-1])]
        # The level left out is known as well, at 0: another level is an error, as in the pipeline.
        rows.append((indexer.getInputCol(), indexer.labels[-1], 0.0, None, None))
    first = len(slopes) - len(inputs)
    for i, name in enumerate(inputs):
        rows.append((name, None, slopes[first + i], float(scaler.mean[i]), float(scaler.std[i]) / float(factor[i])))
    return spark.createDataFrame(rows, PARAMETERS)


def score_by_parameters(df: DataFrame, parameters: DataFrame, out: str = "predicted") -> DataFrame:
    """Add the prediction of a linear model from its parameter table, by column expressions only.

    A null feature gives a null prediction; an unknown level is an error.
    """
    rows = parameters.collect()  # one row per feature
    total, categories = F.lit(0.0), {}
    for row in rows:
        if row["feature"] is None:
            total = total + F.lit(row["coefficient"])
        elif row["level"] is not None:
            categories.setdefault(row["feature"], {})[row["level"]] = row["coefficient"]
        elif row["deviation"]:
            scaled = (F.col(row["feature"]).cast("double") - F.lit(row["mean"])) / F.lit(row["deviation"])
            total = total + F.lit(row["coefficient"]) * scaled
    for name, levels in categories.items():
        unknown = F.raise_error(F.concat(F.lit(f"unknown level of {name}: "), F.col(name))).cast("double")
        part = F.when(F.col(name).isNull(), F.lit(None).cast("double"))
        for level, slope in levels.items():
            part = part.when(F.col(name) == level, F.lit(slope))
        total = total + part.otherwise(unknown)
    return df.withColumn(out, total)


def save(model: PipelineModel, path: str) -> None:
    """Publish the fitted pipeline, all or nothing; a linear one with its parameters as a table beside the stages."""
    spark = SparkSession.active()

    def write(folder: str) -> None:
        model.write().save(folder)
        if isinstance(model.stages[-1], LinearRegressionModel) and any(isinstance(s, StandardScalerModel) for s in model.stages):
            linear_parameters(spark, model).coalesce(1).write.parquet(f"{folder}/parameters")

    publish(spark, path, write)


def load(path: str) -> PipelineModel:
    recover(SparkSession.active(), path)
    return PipelineModel.load(path)


def load_parameters(spark: SparkSession, path: str) -> DataFrame:
    """The parameter table of a saved linear model."""
    recover(spark, path)
    return spark.read.schema(PARAMETERS).parquet(f"{path}/parameters")
