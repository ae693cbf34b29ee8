"""Linear and tree regression, scoring, saving and loading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from perennia.functions import field


def fit_linear(df: DataFrame, features: str = "features", label: str = "target", max_iter: int = 100):
    """Least squares; up to 4096 features it is solved exactly from one pass over the rows."""
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter).fit(df)


def fit_tree(
    df: DataFrame,
    features: str = "features",
    label: str = "target",
    max_depth: int = 12,
    max_bins: int = 32,
    seed: int = 42,
):
    """Regression tree; each level's split statistics are gathered in one job."""
    return DecisionTreeRegressor(
        featuresCol=features, labelCol=label, maxDepth=max_depth, maxBins=max_bins, seed=seed
    ).fit(df)


def score(model: Model, df: DataFrame, keep: Sequence[str] = (), label: str = "target") -> DataFrame:
    """(keys, label, prediction) of every row."""
    return model.transform(df).select(*[field(c) for c in keep], field(label), "prediction")


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """A saved model or pipeline, of whatever class it was saved as."""
    metadata = DefaultParamsReader.loadMetadata(path, spark)
    kind = metadata["class"].replace("org.apache.spark.ml", "pyspark.ml")
    module, name = kind.rsplit(".", 1)
    if kind == "pyspark.ml.PipelineModel":
        module = "pyspark.ml.pipeline"
    return getattr(__import__(module, fromlist=[name]), name).load(path)
