"""Sale records: price per square metre, counted cells, and figures per market.

A market is a zip and a property type. Sales are read once, into cells counted by market,
surface, price, year and recency; everything else is computed from the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scoring import price_per_m2
from ..options import DEFAULTS, Options
from .quantiles import grouped_quantiles, grouped_summary

MARKET = ["code_postal", "type_local"]


def derive_price_m2(sales: DataFrame) -> DataFrame:
    """Add ``prix_m2``; a given ``prix_m2`` is kept."""
    derived = price_per_m2(F.col("valeur_fonciere"), F.col("surface_reelle_bati"))
    if "prix_m2" in sales.columns:
        derived = F.coalesce(F.col("prix_m2"), derived)
    return sales.withColumn("prix_m2", derived)


def is_recent(o: Options) -> Column:
    """Sold within the recency window; its first day counts."""
    first_day = F.add_months(F.to_date(F.lit(o.as_of)), -o.max_age_months)
    return F.coalesce(F.col("date_mutation") >= first_day, F.lit(False))


def sales_cells(sales: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Counted cells of the priced sales table; ties collapse before the shuffle.

    Sales without a zip or type belong to no market and are left out.
    """
    age = F.datediff(F.to_date(F.lit(o.as_of)), F.col("date_mutation"))
    return (
        sales.filter(F.col("code_postal").isNotNull() & F.col("type_local").isNotNull())
        .groupBy(
            *MARKET,
            F.col("surface_reelle_bati").alias("surface"),
            F.col("prix_m2").alias("price"),
            F.year("date_mutation").alias("year"),
            is_recent(o).alias("recent"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("date_mutation").alias("dated"),
            F.sum(age.cast("bigint")).alias("age"),
        )
    )


def market_quantiles(cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """10, 50 and 90 % price per square metre of each market; the statistical model."""
    names = ["q10", "q50", "q90"]
    return grouped_quantiles(cells, MARKET, fixed.QUANTILES, names, o.bucket_width).select(*MARKET, *names)


def market_stats(cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Median, mean, sample deviation and count of the price per square metre."""
    summary = grouped_summary(cells, MARKET, o.bucket_width)
    return summary.select(*MARKET, "median", "mean", "std", F.col("n_values").alias("count"))


def trend_pct(before: Column, after: Column) -> Column:
    change = F.try_divide(after - before, before) * 100
    return F.coalesce(F.bround(change, 2), F.lit(0.0))


def yearly_medians(cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Medians of the two trend years side by side, for markets that sold in either."""
    y0, y1 = o.trend_years
    dated = cells.filter(F.col("year").isin(y0, y1))
    medians = grouped_quantiles(dated, [*MARKET, "year"], [0.5], ["median"], o.bucket_width)
    return medians.groupBy(*MARKET).agg(
        F.max(F.when(F.col("year") == y0, F.col("median"))).alias("median_before"),
        F.max(F.when(F.col("year") == y1, F.col("median"))).alias("median_after"),
    )


def market_trend(cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Change of the yearly median, in percent; 0 where a year is missing."""
    markets = cells.select(*MARKET).distinct()
    return markets.join(yearly_medians(cells, o), MARKET, "left").withColumn(
        "trend_pct", trend_pct(F.col("median_before"), F.col("median_after"))
    )
