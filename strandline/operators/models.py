"""Feature preparation and Spark ML models."""

from __future__ import annotations

import random
from collections.abc import Callable
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dummies(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """A 0/1 column ``column_level`` for each declared level; the column itself goes."""
    made = {f"{c}_{v}": F.when(F.col(c) == v, 1).otherwise(0) for c, vs in levels.items() for v in vs}
    return df.withColumns(made).drop(*levels)


def log1p(df: DataFrame, columns: list[str]) -> DataFrame:
    """``log_column`` in place of each column."""
    return df.withColumns({f"log_{c}": F.log1p(c) for c in columns}).drop(*columns)


def split_xy(df: DataFrame, key: str, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """Features and labels, each with the key."""
    return df.drop(*labels), df.select(key, *labels)


def aligned(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns``, in order: those missing are 0, others go."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns])


def standardised(df: DataFrame, key: str, columns: list[str], centre: bool = True) -> DataFrame:
    """Columns less their mean (with ``centre``), in standard deviations."""
    made = VectorAssembler(inputCols=columns, outputCol="_raw").transform(df)
    made = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=centre, withStd=True).fit(made).transform(made)
    values = vector_to_array("_scaled")
    return made.select(key, *[values[i].alias(c) for i, c in enumerate(columns)])


def draws(grid: dict[str, list], many: int, seed: int = 0) -> list[dict]:
    """``many`` different random points of a grid."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    return random.Random(seed).sample(points, min(many, len(points)))


def saved_or_fitted(path: str, fit: Callable[[], PipelineModel] | None) -> PipelineModel:
    """The model saved at ``path``; where there is none, ``fit`` makes and saves it, and without ``fit`` that is an error."""
    if fit is not None:
        try:
            return PipelineModel.load(path)
        except Exception as e:  # noqa: BLE001  a missing path is reported in many ways
            if "exist" not in str(e):
                raise
        fit().write().save(path)
    return PipelineModel.load(path)


def balanced(df: DataFrame, label: str) -> DataFrame:
    """A weight that gives both classes the same total."""
    n = df.agg(F.count("*").alias("n"), F.sum(label).alias("pos"))
    w = F.when(F.col(label) == 1, F.col("n") / (2 * F.col("pos"))).otherwise(F.col("n") / (2 * (F.col("n") - F.col("pos"))))
    return df.crossJoin(F.broadcast(n)).withColumn("weight", w).drop("n", "pos")  # one row


def classifier(kind: str, label: str, features: list[str], seed: int = 0, **params) -> Pipeline:
    """Scaling and one of logreg, rf, gbt, with ``params`` in place of its own."""
    common = {"featuresCol": "scaled", "labelCol": label, "weightCol": "weight"}
    model = {
        "logreg": lambda: LogisticRegression(maxIter=20, regParam=0.01, **common),
        "rf": lambda: RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed, **common),
        "gbt": lambda: GBTClassifier(maxIter=5, maxDepth=3, seed=seed, **common),
    }[kind]()
    model.setParams(**params) if params else None
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="keep"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=kind != "rf"), model])


def by_fold(kind: str, label: str, features: list[str], df: DataFrame, fold: str, folds: int, **params) -> list[PipelineModel]:
    """The model of each fold 0..folds-1 of the column ``fold``, fitted on all other folds; the fits run side by side."""
    pipeline = classifier(kind, label, features, **params)
    metric = BinaryClassificationEvaluator(labelCol=label)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=[{}], evaluator=metric, numFolds=folds, foldCol=fold, parallelism=folds, collectSubModels=True)
    return [models[0] for models in cv.fit(df).subModels]


def scored(model: PipelineModel, df: DataFrame, key: str, name: str) -> DataFrame:
    """key, prob and model of each row."""
    return model.transform(df).select(key, vector_to_array("probability")[1].alias("prob"), F.lit(name).alias("model"))


def coefficients(model: PipelineModel, features: list[str]) -> list[tuple[str, float, float]]:
    """Feature, coefficient or importance, and its share of their absolute sum."""
    last = model.stages[-1]
    values = (last.coefficients if hasattr(last, "coefficients") else last.featureImportances).toArray().tolist()
    total = sum(map(abs, values)) or 1.0
    return [(f, v, v / total) for f, v in zip(features, values)]
