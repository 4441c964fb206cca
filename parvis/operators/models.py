"""Price models: three ordered quantiles of the price per square metre.

``StatisticalModel`` uses the quantiles of a market. ``ForestModel`` weighs training sales by the
leaves they share with a listing: trees are grown for the mean, every tree spreads the weight 1
evenly over the sales of the leaf that the listing falls into, and the quantiles are those of
the sales so weighted, pooled over all trees (Meinshausen 2006). Leaves are kept as histograms
over at most ``Options.price_cuts`` prices, so the model's size follows from its parameters
alone and a prediction needs no join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scoring import features, scoring_rooms
from ..options import DEFAULTS, Options
from ..session import cut_lineage
from .market import MARKET, market_quantiles, sales_cells
from .spread import counted_keys, deal, look_up

QUANTILES = ["q10", "q50", "q90"]
PREDICTION = ["predicted_m2_exact", "low_m2", "high_m2"]


def training_features(sales: DataFrame) -> DataFrame:
    """The nine features of each sale, and its price per square metre as ``price``."""
    year = F.coalesce(F.year("date_mutation"), F.lit(2024))
    named = features(
        F.col("surface_reelle_bati"), F.col("code_postal"), F.col("type_local"), F.col("nombre_pieces_principales"), year
    )
    return sales.select(*[named[f].alias(f) for f in fixed.FEATURES], F.col("prix_m2").alias("price"))


def scoring_columns(o: Options = DEFAULTS) -> dict[str, Column]:
    """The features of a request (zipcode, property_type, surface_m2) at the scoring date."""
    surface = F.col("surface_m2")
    year = F.year(F.to_date(F.lit(o.scoring_date)))
    return features(surface, F.col("zipcode"), F.col("property_type"), scoring_rooms(surface), year)


def _errors(scored: DataFrame, model: str) -> DataFrame:
    """One row: mean absolute error, mean relative error in percent and number of sales."""
    error = F.abs(F.col("price") - F.col("q50"))
    n = F.sum("n")
    return scored.agg(
        F.lit(model).alias("model"),
        F.try_divide(F.sum(F.col("n") * error), n).alias("mae_m2"),
        F.try_divide(F.sum(F.col("n") * F.try_divide(error, F.col("price"))) * 100, n).alias("mape_pct"),
        n.alias("n_train"),
    )


def predict_by_market(requests: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Requests with comparable figures, plus the prediction from the ``quantiles`` of their market.

    A market without training sales falls back on the comparables of the request.
    """
    quantiles = quantiles.withColumnsRenamed({"code_postal": "zipcode", "type_local": "property_type"})
    median, std = F.col("market_median_m2"), F.col("market_std_m2")
    spread = fixed.NORMAL_80 * F.coalesce(F.nullif(std, F.lit(0.0)), median * fixed.ASSUMED_SPREAD)
    known = F.col("q50").isNotNull()
    return requests.join(quantiles, ["zipcode", "property_type"], "left").select(
        *requests.columns,
        F.when(known, F.col("q50")).otherwise(median).alias(PREDICTION[0]),
        F.when(known, F.col("q10")).otherwise(median - spread).alias(PREDICTION[1]),
        F.when(known, F.col("q90")).otherwise(median + spread).alias(PREDICTION[2]),
    )


@dataclass(frozen=True)
class StatisticalModel:
    cells: DataFrame
    options: Options = DEFAULTS

    @property
    def quantiles(self) -> DataFrame:
        return market_quantiles(self.cells, self.options)

    def predict(self, requests: DataFrame) -> DataFrame:
        return predict_by_market(requests, self.quantiles)

    def metrics(self) -> DataFrame:
        priced = self.cells.filter(F.col("price").isNotNull())
        markets = counted_keys(priced, MARKET)
        known = markets.join(self.quantiles, MARKET)
        dealt = deal(priced, markets, MARKET, "price", self.options)
        return _errors(look_up(dealt, known, MARKET, self.options), "statistical")


@dataclass(frozen=True)
class ForestModel:
    trees: RandomForestRegressionModel
    prices: list[float]
    """Mean price of the sales in each bucket between two cuts, rising."""
    leaves: DataFrame
    """(tree, leaf, bucket, n): sales of a leaf by price."""
    training: DataFrame
    options: Options = DEFAULTS

    def _shares(self) -> tuple[np.ndarray, np.ndarray]:
        """First row of each tree, and per leaf the share of its sales in every bucket."""
        # At most trees x leaves x cuts rows, all of them parameters.
        rows = self.leaves.toPandas()
        sizes = rows.groupby("tree")["leaf"].max().reindex(range(self.trees.getNumTrees), fill_value=-1) + 1
        first = np.concatenate(([0], np.cumsum(sizes.to_numpy())))
        shares = np.zeros((first[-1], len(self.prices)), np.float32)
        shares[first[rows["tree"].to_numpy()] + rows["leaf"].to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
        return first[:-1], shares / np.maximum(shares.sum(axis=1, keepdims=True), 1)

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows``, which hold the features, with q10, q50 and q90."""
        first, shares = self._shares()
        held = rows.sparkSession.sparkContext.broadcast((first, shares, np.array(self.prices)))
        vectors = VectorAssembler(inputCols=fixed.FEATURES, outputCol="features").transform(rows)
        in_trees = self.trees.transform(vectors).withColumn("quantiles", _weighted_quantiles(held)(vector_to_array("leaves")))
        return in_trees.select(*rows.columns, *[F.col("quantiles")[i].alias(q) for i, q in enumerate(QUANTILES)])

    def predict(self, requests: DataFrame) -> DataFrame:
        """Requests with comparable figures, plus the prediction."""
        keys = ["zipcode", "property_type", "surface_m2"]
        scoring = scoring_columns(self.options)
        named = [f for f in fixed.FEATURES if f not in keys]
        scored = self.scored(requests.select(*keys, *[scoring[f].alias(f) for f in named]))
        scored = scored.select(*keys, *[F.col(q).alias(p) for q, p in zip(["q50", "q10", "q90"], PREDICTION)])
        return requests.join(scored, keys)

    def metrics(self) -> DataFrame:
        return _errors(self.scored(self.training), "forest")


def _weighted_quantiles(held):
    """UDF from the leaves of a row, one per tree, to its three quantiles."""
    levels = np.array(fixed.QUANTILES)

    @F.pandas_udf("array<double>")
    def quantiles(leaves: pd.Series) -> pd.Series:
        first, shares, prices = held.value
        found = []
        for low in range(0, len(leaves), 2048):
            at = np.stack(leaves.iloc[low : low + 2048].to_list()).astype(np.int64) + first
            upto = np.cumsum(sum(shares[at[:, tree]].astype(np.float64) for tree in range(at.shape[1])), axis=1)
            # The first price up to which the share of the weight lies; a share is met but for rounding.
            wanted = levels[None, :] * upto[:, -1:] * (1 - 1e-6)
            found += list(prices[(upto[:, None, :] < wanted[:, :, None]).sum(axis=2)])
        return pd.Series(found)

    return quantiles


def fit_forest(
    sales: DataFrame, o: Options = DEFAULTS, seed: int = 17
) -> ForestModel:
    """Grow the trees, then count the sales of every leaf by price in one pass.

    Sales that lack a feature or the price take no part; ``n_train`` of the metrics counts the others.
    """
    # Written before they become vectors: in one expression both take several times as long.
    rows = cut_lineage(training_features(sales).na.drop())
    counted = cut_lineage(rows.groupBy(*fixed.FEATURES, "price").agg(F.count(F.lit(1)).alias("n")))
    assembler = VectorAssembler(inputCols=fixed.FEATURES, outputCol="features")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="price",
        leafCol="leaves",
        numTrees=o.n_trees,
        maxDepth=o.tree_depth,
        maxBins=o.tree_bins,
        minInstancesPerNode=o.leaf_rows,
        featureSubsetStrategy="all",
        seed=seed,
    )
    # The trees read their rows several times, and each time check every vector more than once.
    trees = forest.fit(cut_lineage(assembler.transform(rows).select("features", "price")))
    shares = [i / o.price_cuts for i in range(1, o.price_cuts)]
    cuts = sorted(set(counted.approxQuantile("price", shares, 0.1 / o.price_cuts)))
    buckets = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="price", outputCol="bucket")
    per_tree = buckets.transform(trees.transform(assembler.transform(counted))).select(
        "price", "n", F.col("bucket").cast("int").alias("bucket"), F.posexplode(vector_to_array("leaves")).alias("tree", "leaf")
    )
    counts = per_tree.groupBy("tree", F.col("leaf").cast("int").alias("leaf"), "bucket").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("price")).alias("total")
    )
    counts = cut_lineage(counts)
    means = counts.filter("tree = 0").groupBy("bucket").agg(F.sum("total") / F.sum("n")).collect()
    means = dict(tuple(r) for r in means)
    # Buckets without a sale get no weight; their price only keeps the order.
    prices, last = [], min(means.values())
    for bucket in range(len(cuts) + 1):
        last = means.get(bucket, last)
        prices.append(last)
    return ForestModel(trees, prices, counts.drop("total"), counted, o)


def fit_quantiles(
    sales: DataFrame, method: str = "statistical", o: Options = DEFAULTS, cells: DataFrame | None = None
) -> StatisticalModel | ForestModel:
    """The model asked for, but the statistical one for a forest of ``smallest_forest`` sales or fewer.

    The ``model`` column of ``metrics`` names the one that was fitted.

    ``cells`` are the counted cells of ``sales`` where they exist already.
    """
    if method not in ("statistical", "forest"):
        raise ValueError(f"unknown method {method!r}")
    if method == "forest" and sales.limit(o.smallest_forest + 1).count() > o.smallest_forest:
        return fit_forest(sales, o)
    return StatisticalModel(sales_cells(sales, o) if cells is None else cells, o)
