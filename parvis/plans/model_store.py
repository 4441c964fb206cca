"""Fitted price models on disk: train once, value listings later."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.models import ForestModel, StatisticalModel, predict_by_market
from ..options import Options

FORMAT = 1


class ModelNotTrained(ValueError):
    """No complete model is stored under the path."""


@dataclass(frozen=True)
class StoredMarkets:
    """A statistical model read back: the quantiles and the training errors it was stored with."""

    quantiles: DataFrame
    errors: DataFrame

    def predict(self, requests: DataFrame) -> DataFrame:
        return predict_by_market(requests, self.quantiles)

    def metrics(self) -> DataFrame:
        return self.errors


@dataclass(frozen=True)
class StoredForest(ForestModel):
    """A forest read back, which needs no training rows."""

    def metrics(self) -> DataFrame:
        return self.training


def save_model(model: StatisticalModel | ForestModel, path: str) -> None:
    """Write ``model`` below ``path``, one folder per version of a model; an earlier model there is an error.

    The manifest is written last, so an interrupted write is never taken for a model.
    """
    errors = model.metrics()
    spark = errors.sparkSession
    errors.write.parquet(f"{path}/metrics")
    if isinstance(model, ForestModel):
        kind = "forest"
        model.trees.save(f"{path}/trees")
        model.leaves.write.parquet(f"{path}/leaves")
        spark.createDataFrame(list(enumerate(model.prices)), "bucket int, price double").write.parquet(f"{path}/prices")
    else:
        kind = "statistical"
        model.quantiles.write.parquet(f"{path}/quantiles")
    chosen = {k: v for k, v in asdict(model.options).items() if k == "scoring_date"}
    manifest = [(FORMAT, kind, chosen["scoring_date"])]
    spark.createDataFrame(manifest, "format int, kind string, scoring_date string").coalesce(1).write.parquet(f"{path}/manifest")


def load_model(spark: SparkSession, path: str) -> StoredMarkets | StoredForest:
    """The model stored under ``path``; ``ModelNotTrained`` if there is none, or one of another format."""
    try:
        manifest = spark.read.parquet(f"{path}/manifest").first()
    except AnalysisException as missing:
        raise ModelNotTrained(f"no model is stored under {path}; fit one and save it first") from missing
    if manifest is None or manifest["format"] != FORMAT:
        raise ModelNotTrained(f"the model under {path} has another format than {FORMAT}; save it anew")
    errors = spark.read.parquet(f"{path}/metrics")
    if manifest["kind"] == "statistical":
        return StoredMarkets(spark.read.parquet(f"{path}/quantiles"), errors)
    # As many rows as the model has price cuts.
    prices = [r["price"] for r in spark.read.parquet(f"{path}/prices").orderBy("bucket").collect()]
    trees = RandomForestRegressionModel.load(f"{path}/trees")
    options = Options(scoring_date=manifest["scoring_date"])
    return StoredForest(trees, prices, spark.read.parquet(f"{path}/leaves"), errors, options)
