"""Approximate quantiles per market that are stored and merged, so that new sales need no rescan.

An opt-in beside the exact quantiles. A market's prices are summarised by a KLL sketch of a few
kilobytes, built and merged before the shuffle. Sketches of separate deliveries of sales merge
into the sketch of all of them. A quantile of a sketch is one of the prices seen; its rank is
off by at most about ``2.3 / sketch_k ** 0.97`` of the prices, with 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..options import DEFAULTS, Options
from .market import MARKET

NAMES = ["q10", "q50", "q90"]


def market_sketches(sales: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """(zip, type, sketch) of the price per square metre, for markets with a priced sale.

    Sales without a zip, a type or a price, or with NaN for one, are left out.
    """
    price = F.col("prix_m2")
    priced = sales.filter(price.isNotNull() & ~F.isnan(price) & F.col("code_postal").isNotNull() & F.col("type_local").isNotNull())
    return priced.groupBy(*MARKET).agg(F.kll_sketch_agg_double(price, F.lit(o.sketch_k)).alias("sketch"))


def merge_sketches(stored: Sequence[DataFrame], o: Options = DEFAULTS) -> DataFrame:
    """One sketch per market out of one or several tables of sketches."""
    rows = reduce(DataFrame.unionByName, [s.select(*MARKET, "sketch") for s in stored])
    return rows.groupBy(*MARKET).agg(F.kll_merge_agg_double("sketch", F.lit(o.sketch_k)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame) -> DataFrame:
    """(zip, type, n, q10, q50, q90); ``n``, the number of prices, is exact."""
    ranks = F.array(*[F.lit(p) for p in fixed.QUANTILES])
    found = sketches.select(
        *MARKET,
        F.kll_sketch_get_n_double("sketch").alias("n"),
        F.kll_sketch_get_quantile_double("sketch", ranks).alias("found"),
    )
    return found.select(*MARKET, "n", *[F.col("found")[i].alias(name) for i, name in enumerate(NAMES)])


def rank_errors(quantiles: DataFrame, cells: DataFrame) -> DataFrame:
    """``quantiles`` with the error of each one's rank (``error_q10`` ...) among the counted sales.

    A value that holds several ranks is off by its distance to the nearest of them.
    """
    sold = cells.filter(F.col("price").isNotNull()).select(*MARKET, "price", F.col("n").alias("n_sales"))
    priced = sold.join(quantiles.select(*MARKET, *NAMES), MARKET)
    counts = [
        F.sum(F.when(test, F.col("n_sales")).otherwise(0)).alias(f"{label}_{name}")
        for name in NAMES
        for label, test in (("below", F.col("price") < F.col(name)), ("upto", F.col("price") <= F.col(name)))
    ]
    ranked = priced.groupBy(*MARKET, *NAMES).agg(F.sum("n_sales").alias("n"), *counts)
    errors = [
        F.greatest(F.col(f"below_{name}") / F.col("n") - p, p - F.col(f"upto_{name}") / F.col("n"), F.lit(0.0)).alias(f"error_{name}")
        for p, name in zip(fixed.QUANTILES, NAMES)
    ]
    return ranked.select(*MARKET, "n", *NAMES, *errors)
