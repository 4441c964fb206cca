"""Price arithmetic, labels, confidence and features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from ..options import Options


def price_per_m2(price: Column, surface: Column) -> Column:
    return F.when(surface > 0, F.try_divide(price, surface))


def whole_thousands(price_m2: Column, surface: Column) -> Column:
    """Price cut to thousands of euros, towards zero on both sides of it."""
    return (price_m2 * surface / 1000).cast("bigint") * 1000


def price_gap(asking: Column, fair: Column) -> Column:
    return (asking - fair) / F.greatest(fair, F.lit(1)) * 100


def signal(gap: Column, o: Options) -> Column:
    return (
        F.when(gap < o.undervalued_below, "undervalued")
        .when(gap > o.overvalued_above, "overvalued")
        .when(gap.isNotNull(), "fair")
    )


def signal_strength(gap: Column, o: Options) -> Column:
    strong = (gap < o.strongly_undervalued_below) | (gap > o.strongly_overvalued_above)
    biased = (gap < o.undervalued_below) | (gap > o.overvalued_above)
    return F.when(strong, "strong").when(biased, "moderate").when(gap.isNotNull(), "weak")


def _share(x: Column) -> Column:
    """The positive part of ``x``; 0 for null and NaN."""
    return F.greatest(F.lit(0.0), F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0)))


def raw_confidence(n: Column, age_days: Column, std: Column, mean: Column) -> Column:
    """Evidence quality before rounding: sample size, age and relative spread of the sales."""
    size = F.least(F.lit(1.0), n / fixed.COUNT_FULL)
    spread = std / F.greatest(mean, F.lit(1.0))
    return (
        fixed.COUNT_WEIGHT * size
        + fixed.AGE_WEIGHT * _share(1 - age_days / fixed.AGE_EMPTY_DAYS)
        + fixed.SPREAD_WEIGHT * _share(1 - spread / fixed.SPREAD_EMPTY)
    )


def confidence_score(n: Column, age_days: Column, std: Column, mean: Column) -> Column:
    return F.bround(raw_confidence(n, age_days, std, mean), 2)


def signal_of_bias(bias: Column) -> Column:
    truth = F.lit(None).cast("string")
    for name, label in fixed.SIGNAL_OF_BIAS:
        truth = F.when(bias == name, label).otherwise(truth)
    return truth


def features(surface: Column, zipcode: Column, kind: Column, rooms: Column, year: Column) -> dict[str, Column]:
    """The model's inputs by name; missing rooms are estimated from the surface."""
    return {
        "log_surface": F.log1p(surface),
        "surface_m2": surface,
        "zipcode": zipcode.cast("int"),
        "arrond": zipcode.cast("int") - 75000,
        "is_maison": F.coalesce(kind == "Maison", F.lit(False)).cast("int"),
        "rooms": F.coalesce(rooms.cast("double"), F.rint(surface / fixed.SQUARE_METRES_PER_ROOM)),
        "year": year.cast("int"),
        "is_small": (surface < fixed.SMALL_BELOW).cast("int"),
        "is_large": (surface > fixed.LARGE_ABOVE).cast("int"),
    }


def scoring_rooms(surface: Column) -> Column:
    return F.floor(surface / fixed.SQUARE_METRES_PER_ROOM).cast("double")
