"""Comparable sales: which sales stand behind a listing and what they say.

Listings ask only about (zip, type, surface), so those are made distinct first, and sales
arrive as counted cells. Counts, ages, means and deviations of a band of surfaces are
differences of running totals over the ordered surfaces of its market; they choose the
evidence of each request. Requests that fall back to a whole market share one evidence set,
and medians are looked up once per set. Nothing grows with requests times sales.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..options import DEFAULTS, Options
from ..session import cut_lineage
from .market import MARKET, is_recent, trend_pct, yearly_medians
from .range_quantiles import band_ranks
from .running import band_sums

PROBE = ["zipcode", "property_type", "surface_m2"]
EVIDENCE = [*MARKET, "scope", "recent_only"]
# Scope of an evidence set that is not limited to a band of surfaces.
ANY_SURFACE = -1.0
SUMS = ["n", "dated", "age", "priced", "s1", "s2"]
SUMS = [*SUMS, *[f"{c}_recent" for c in SUMS]]
AS_PROBE = {"code_postal": "zipcode", "type_local": "property_type"}


def _exact(amount: Column) -> Column:
    """Decimals, whose running totals have exact differences; amounts of 10^19 and more are left out."""
    return amount.try_cast("decimal(35,16)")


def with_moments(cells: DataFrame) -> DataFrame:
    """Market, surface, and what adds up: counts, ages and price moments, of all sales and of recent ones."""
    price, n = F.nanvl("price", F.lit(None)), F.col("n")
    own = {
        "n": n,
        "dated": F.col("dated"),
        "age": F.col("age"),
        "priced": F.when(price.isNotNull(), n),
        "s1": _exact(n * price),
        "s2": _exact(n * price * price),
    }
    recent = {f"{c}_recent": F.when(F.col("recent"), x) for c, x in own.items()}
    surface = F.nanvl("surface", F.lit(None)).alias("surface")
    return cells.select(*MARKET, surface, *[x.alias(c) for c, x in (own | recent).items()])


def _ends(surface: Column, o: Options) -> tuple[Column, Column]:
    return surface * (1 - o.surface_tolerance), surface * (1 + o.surface_tolerance)


def _bin_step(o: Options) -> float:
    """Logarithmic bin width such that a band touches four or five bins."""
    return math.log((1 + o.surface_tolerance) / (1 - o.surface_tolerance)) / 3


def _bin(surface: Column, o: Options) -> Column:
    """Logarithmic surface bin: the equality key that stands in for the band's range test."""
    return F.when(surface > 0, F.floor(F.ln(surface) / _bin_step(o))).otherwise(F.lit(-1000)).cast("bigint")


def _band_bins(surface: Column, o: Options) -> Column:
    """All bins that the band around ``surface`` touches."""
    first = _bin(surface * (1 - o.surface_tolerance), o)
    return F.sequence(first, F.greatest(first, _bin(surface * (1 + o.surface_tolerance), o)))


def _in_band(around: str, o: Options) -> Column:
    middle = F.col(around)
    return F.col("surface").between(middle * (1 - o.surface_tolerance), middle * (1 + o.surface_tolerance))


def choose_tier(probes: DataFrame, cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Probes with the row counts of the four tiers, the tier that applies, its mean age and its moments.

    A band with too few sales widens to its market; then recent sales are preferred if
    there are enough of them.
    """
    # One row per surface of a market, so that prices and years take no part in the order of the bands.
    counted = with_moments(cells).groupBy(*MARKET, "surface").agg(*[F.sum(c).alias(c) for c in SUMS])
    counted = cut_lineage(counted)
    pool = counted.groupBy(*MARKET).agg(*[F.sum(c).alias(f"{c}_pool") for c in SUMS]).withColumnsRenamed(AS_PROBE)
    low, high = _ends(F.col("surface_m2"), o)
    asked = probes.select(*PROBE, low.alias("low"), high.alias("high")).withColumnsRenamed({v: k for k, v in AS_PROBE.items()})
    band = band_sums(counted, asked, MARKET, "surface", SUMS, ["surface_m2"]).withColumnsRenamed(AS_PROBE)
    joined = probes.join(band.withColumnsRenamed({c: f"{c}_band" for c in SUMS}), PROBE, "left").join(pool, PROBE[:2], "left")
    joined = joined.withColumns({f"{c}_{x}": F.coalesce(f"{c}_{x}", F.lit(0)) for c in SUMS for x in ("band", "pool")})
    in_band = F.col("n_band") >= o.min_band_rows

    def scoped(c: str) -> Column:
        return F.when(in_band, F.col(f"{c}_band")).otherwise(F.col(f"{c}_pool"))

    recent_only = scoped("n_recent") >= o.min_recent_rows

    def chosen(c: str) -> Column:
        return F.when(recent_only, scoped(f"{c}_recent")).otherwise(scoped(c))

    age = F.when(recent_only, F.try_divide(scoped("age_recent"), scoped("n_recent")))
    age = age.otherwise(F.try_divide(scoped("age"), scoped("dated")))
    return joined.select(
        *probes.columns,
        F.concat(F.when(in_band, "band").otherwise("pool"), F.when(recent_only, "+recent").otherwise("")).alias("tier"),
        F.col("n_recent_band").alias("n_band_recent"),
        "n_band",
        F.col("n_recent_pool").alias("n_pool_recent"),
        "n_pool",
        chosen("n").alias("n_comparables"),
        F.when(chosen("n") == 0, fixed.NO_SALES_AGE_DAYS).otherwise(age).alias("freshness_days"),
        F.when(in_band, F.col("surface_m2")).otherwise(F.lit(ANY_SURFACE)).alias("scope"),
        recent_only.alias("recent_only"),
        chosen("priced").alias("n_priced"),
        *[chosen(c).cast("double").alias(c) for c in ("s1", "s2")],
    )


def evidence_ranks(evidence: DataFrame, cells: DataFrame, o: Options) -> DataFrame:
    """(EVIDENCE, median, least, most): order statistics of the price per square metre of each evidence set.

    ``evidence`` holds EVIDENCE and ``n_priced``.
    """
    keys = [*MARKET, "recent_only"]
    recency = F.explode(F.when(F.col("recent"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    # Sales without a surface belong to whole markets only, which begin at minus infinity.
    surface = F.coalesce(F.nanvl("surface", F.lit(None)), F.lit(-math.inf)).alias("surface")
    priced = cells.filter(F.col("price").isNotNull() & ~F.isnan("price"))
    priced = priced.select(*MARKET, recency.alias("recent_only"), surface, "price", "n")
    priced = cut_lineage(priced.groupBy(*keys, "surface", "price").agg(F.sum("n").alias("n")))
    asked = cut_lineage(evidence.filter("n_priced > 0").withColumn("ask_id", F.monotonically_increasing_id()))
    anywhere, last = F.col("scope") == ANY_SURFACE, F.col("n_priced") - 1
    low, high = _ends(F.col("scope"), o)
    ranks = [F.lit(0).cast("bigint"), F.floor(last / 2), F.ceil(last / 2), last]
    asks = asked.select(
        *keys,
        "ask_id",
        F.when(anywhere, -math.inf).otherwise(low).alias("low"),
        F.when(anywhere, math.inf).otherwise(high).alias("high"),
        F.posexplode(F.array(*ranks)).alias("slot", "rank"),
        (F.col("n_priced") % 2 == 1).alias("odd"),
    )
    asks = asks.filter("slot <> 2 or not odd").drop("odd")
    found = band_ranks(priced, asks, keys, o).groupBy("ask_id").pivot("slot", [0, 1, 2, 3]).agg(F.max("price"))
    median = F.col("`1`") + (F.coalesce("`2`", "`1`") - F.col("`1`")) * 0.5
    return asked.join(found, "ask_id").select(*EVIDENCE, median.alias("median"), F.col("`0`").alias("least"), F.col("`3`").alias("most"))


def comparables(probes: DataFrame, cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Comparable-sale figures of each distinct (zipcode, property_type, surface_m2).

    Further columns of ``probes`` are kept. Both inputs are read several times, so cut the
    lineage of costly ones first; the chosen tiers are written out here.
    """
    tiers = cut_lineage(choose_tier(probes, cells, o))
    evidence = tiers.filter(F.col("n_priced") > 0).select(
        F.col("zipcode").alias("code_postal"), F.col("property_type").alias("type_local"), "scope", "recent_only", "n_priced"
    )
    figures = evidence_ranks(evidence.distinct(), cells, o).withColumnsRenamed(AS_PROBE)
    yearly = yearly_medians(cells, o).withColumnsRenamed(AS_PROBE)
    none = F.col("n_comparables") == 0
    mean = F.try_divide("s1", "n_priced")
    variance = F.try_divide(F.greatest(F.col("s2") - F.col("s1") * mean, F.lit(0.0)), F.col("n_priced") - 1)
    std = F.when(F.col("least") == F.col("most"), 0.0).otherwise(F.sqrt(variance))
    std = F.when(F.col("n_priced") > 1, std)
    return (
        tiers.join(figures, [*PROBE[:2], "scope", "recent_only"], "left")
        .join(yearly, PROBE[:2], "left")
        .select(
            *probes.columns,
            "tier",
            "n_band_recent",
            "n_band",
            "n_pool_recent",
            "n_pool",
            "n_comparables",
            F.when(none, 0.0).otherwise(F.col("median")).alias("market_median_m2"),
            F.when(none, 0.0).otherwise(mean).alias("market_mean_m2"),
            F.when(F.col("n_comparables") <= 1, 0.0).otherwise(std).alias("market_std_m2"),
            "freshness_days",
            trend_pct(F.col("median_before"), F.col("median_after")).alias("trend_pct"),
        )
    )


def comparable_sales(probes: DataFrame, sales: DataFrame, cells: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """The sale rows behind each request, next to its key and tier.

    The output has one row per request and sale: meant for the requests one wants to look
    at, not for all of them.
    """
    tiers = choose_tier(probes, cells, o).filter(F.col("n_comparables") > 0)
    anywhere = F.col("scope") == ANY_SURFACE
    rows = sales.withColumns(
        {"surface": F.col("surface_reelle_bati"), "recent": is_recent(o), "bin": _bin(F.col("surface_reelle_bati"), o)}
    ).withColumnsRenamed(AS_PROBE)
    wanted = tiers.select(*PROBE, "tier", "scope", "recent_only")
    banded = wanted.filter(~anywhere).withColumn("bin", F.explode(_band_bins(F.col("scope"), o)))
    found = banded.join(rows, [*PROBE[:2], "bin"]).unionByName(
        wanted.filter(anywhere).join(rows, PROBE[:2])
    )
    fresh_enough = F.col("recent") | ~F.col("recent_only")
    kept = [c for c in sales.columns if c not in AS_PROBE]
    return found.filter((anywhere | _in_band("scope", o)) & fresh_enough).select(*PROBE, "tier", *kept)
