"""Running totals over ordered rows of any number per key, and sums over bands by two look-ups.

Rows are cut into ranges of (key, order), so a key that holds a third of all rows spreads over
tasks. A range's own totals are one row per key; their running sum gives each range its start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _ranged(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with the number of their range; written, so that a lost executor cannot cut ranges elsewhere later."""
    return cut_lineage(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))


def _upto(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``rows`` (with ``_range``) with each of ``sums`` replaced by its total over the key's rows up to here."""
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_range").agg(*[F.sum(c).alias(c) for c in sums])
    starts = totals.select(*keys, "_range", *[F.sum(c).over(earlier).alias(f"_start_{c}") for c in sums])
    # Of all keys only those that go on from an earlier range have a start.
    starts = starts.filter(" or ".join(f"_start_{c} is not null" for c in sums))
    zero = F.lit(0)
    joined = rows.withColumns({c: F.coalesce(F.sum(c).over(inside), zero) for c in sums}).join(starts, [*keys, "_range"], "left")
    return joined.withColumns({c: F.col(c) + F.coalesce(F.col(f"_start_{c}"), zero) for c in sums})


def running_totals(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``rows`` with each of ``sums`` replaced by its total over the key's rows up to here, this one included.

    Null sums count as 0.
    """
    return _upto(_ranged(rows, keys, order), keys, order, sums).select(*rows.columns)


def band_sums(
    table: DataFrame, asks: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str], ids: Sequence[str]
) -> DataFrame:
    """(keys, ids, sums): totals of the ``table`` rows with ``low <= value <= high`` for every row of ``asks``.

    ``asks`` holds keys, ids (distinct per key), low and high. Each of its rows becomes two
    ends among the ordered table rows, which are added up between neighbouring ends; a band is
    the difference of the running totals at its ends, so nothing grows with the rows in a band.
    Bands without a row sum to 0; those with low above high are left out.
    """
    nothing = [F.lit(None).cast(asks.schema[c].dataType).alias(c) for c in ids]
    counted = table.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"), F.lit(1).alias("_end"), *nothing, *sums)
    low, high = [F.struct(F.col(c).alias("value"), F.lit(end).alias("end")) for c, end in (("low", 0), ("high", 2))]
    ends = (
        asks.filter("low <= high")
        .select(*keys, *ids, F.explode(F.array(low, high)).alias("_e"))
        .select(
            *keys, F.col("_e.value").alias("_value"), F.col("_e.end").alias("_end"), *ids,
            *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in sums],
        )
    )
    ranged = _ranged(counted.unionByName(ends), keys, ["_value", "_end"])
    # A stretch is an end with the table rows since the end before it in its range.
    is_end = F.col("_end") != 1
    before = Window.partitionBy(*keys, "_range").orderBy("_value", "_end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretch = F.sum(F.when(is_end, 1).otherwise(0)).over(before) - F.when(is_end, 1).otherwise(0)
    stretches = (
        ranged.withColumn("_stretch", stretch)
        .groupBy(*keys, "_range", "_stretch")
        .agg(F.max(F.when(is_end, F.col("_end"))).alias("_end"), *[F.max(F.when(is_end, F.col(c))).alias(c) for c in ids], *[F.sum(c).alias(c) for c in sums])
    )
    found = _upto(cut_lineage(stretches), keys, ["_stretch"], sums).filter("_end is not null")
    signed = [F.sum(F.when(F.col("_end") == 2, F.col(c)).otherwise(-F.col(c))).alias(c) for c in sums]
    return found.groupBy(*keys, *ids).agg(*signed)
