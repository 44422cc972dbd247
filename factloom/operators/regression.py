"""Linear regression over normalised features, by one pass of sufficient statistics."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame


def fit(df: DataFrame, features: list[str], label: str, reg: float = 0.0) -> PipelineModel:
    """Rows with a null are skipped. The normal-equation solver aggregates a matrix of the size of the features, not of the rows."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True),
        LinearRegression(featuresCol="_features", labelCol=label, predictionCol="prediction", solver="normal", regParam=reg),
    ]).fit(df.dropna(subset=[label]))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("_raw", "_features")
