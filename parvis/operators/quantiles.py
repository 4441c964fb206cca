"""Exact quantiles of large groups.

The built-in ``percentile`` keeps all distinct values of a group in the memory of one
task. Here the group is first reduced, before any shuffle, to a histogram of fixed width.
The histogram tells in which bucket each wanted rank lies, and only the values of those
buckets are then ordered. Ranks interpolate linearly between neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_of(value: Column, width: float) -> Column:
    return F.floor(value / width)


def _slots(probs: Sequence[float]) -> list[tuple[int, int]]:
    """(probability index, 0 for the lower and 1 for the upper neighbour)."""
    return [(i, side) for i in range(len(probs)) for side in (0, 1)]


def _position(prob: float, count: Column) -> Column:
    return (count - 1) * F.lit(float(prob))


def _rank(prob: float, side: int, count: Column) -> Column:
    position = _position(prob, count)
    return (F.ceil(position) if side else F.floor(position)).cast("bigint")


def locate(hist: DataFrame, keys: Sequence[str], probs: Sequence[float], totals: Sequence[Column] = ()) -> DataFrame:
    """One row per key: number of values, and bucket and rank inside it of each neighbour.

    ``hist`` holds (keys, bucket, weight) with one row per bucket; rows with a null bucket
    count towards ``totals`` only. The ordered window sees one row per bucket, not per value.
    """
    group = Window.partitionBy(*keys)
    upto = group.orderBy(F.asc_nulls_last("bucket")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valued = F.when(F.col("bucket").isNotNull(), F.col("weight")).otherwise(0)
    ranked = hist.withColumns({"_valued": valued}).withColumns(
        {"_count": F.sum("_valued").over(group), "_upto": F.sum("_valued").over(upto)}
    )
    before = F.col("_upto") - F.col("_valued")
    found = []
    for i, side in _slots(probs):
        rank = _rank(probs[i], side, F.col("_count"))
        here = F.col("bucket").isNotNull() & (rank >= before) & (rank < F.col("_upto"))
        found.append(F.max(F.when(here, F.col("bucket"))).alias(f"_bucket{i}{side}"))
        found.append(F.max(F.when(here, rank - before)).alias(f"_rank{i}{side}"))
    return ranked.groupBy(*keys).agg(F.max("_count").alias("n_values"), *found, *totals)


def wanted_buckets(located: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``located`` once per distinct bucket that holds a wanted value; a null bucket if none does."""
    buckets = F.array_compact(F.array_distinct(F.array(*[F.col(f"_bucket{i}{side}") for i, side in _slots(probs)])))
    return located.withColumn("bucket", F.explode_outer(buckets))


def select_values(values: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row per key with its located columns and one column per probability.

    ``values`` is the result of ``wanted_buckets`` with each row repeated for the distinct
    values of its bucket, as the columns (value, weight); both are null in an empty group.
    """
    inside = Window.partitionBy(*keys, "bucket").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = F.col("_upto")
    before = upto - F.col("weight")
    picks = []
    for i, side in _slots(probs):
        rank = F.col(f"_rank{i}{side}")
        here = (F.col("bucket") == F.col(f"_bucket{i}{side}")) & (rank >= before) & (rank < upto)
        picks.append(F.max(F.when(here, F.col("value"))).alias(f"_value{i}{side}"))
    working = {"bucket", "value", "weight", *keys}
    carried = [c for c in values.columns if c not in working and not c.startswith(("_bucket", "_rank"))]
    picked = (
        values.withColumn("_upto", F.sum("weight").over(inside))
        .groupBy(*keys)
        .agg(*[F.any_value(c).alias(c) for c in carried], *picks)
    )

    def interpolated(i: int) -> Column:
        low, high = F.col(f"_value{i}0"), F.col(f"_value{i}1")
        position = _position(probs[i], F.col("n_values"))
        return low + (high - low) * (position - F.floor(position))

    return picked.select(*keys, *carried, *[interpolated(i).alias(name) for i, name in enumerate(names)])


def grouped_quantiles(
    cells: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str], width: float
) -> DataFrame:
    """(keys, n_values, one column per probability) of ``price``, each cell counting ``n`` times.

    Equal values of a key collapse before the shuffle, and the shuffle key holds the value
    itself, so one dominant key spreads over all tasks. Null prices are ignored.
    """
    values = _values(cells, keys, width)
    hist = values.groupBy(*keys, "bucket").agg(F.sum("weight").alias("weight"))
    wanted = wanted_buckets(locate(hist, keys, probs), probs)
    return select_values(wanted.join(values, [*keys, "bucket"]), keys, probs, names)


def _values(cells: DataFrame, keys: Sequence[str], width: float) -> DataFrame:
    priced = cells.filter(F.col("price").isNotNull())
    values = priced.groupBy(*keys, F.col("price").alias("value")).agg(F.sum("n").alias("weight"))
    return values.withColumn("bucket", bucket_of(F.col("value"), width))


# Sums of a bucket. Moments are kept around the bucket's centre, where they lose few digits.
MERGED = {"weight": F.sum, "total": F.sum, "s1": F.sum, "s2": F.sum, "least": F.min, "most": F.max}


def histogram(cells: DataFrame, keys: Sequence[str], width: float) -> DataFrame:
    """(keys, bucket) with count, centred moments and extremes of the prices."""
    offset = F.col("price") - (F.col("bucket") + 0.5) * width
    return (
        cells.withColumn("bucket", bucket_of(F.col("price"), width))
        .groupBy(*keys, "bucket")
        .agg(
            F.sum("n").alias("weight"),
            F.sum(F.col("n") * F.col("price")).alias("total"),
            F.sum(F.col("n") * offset).alias("s1"),
            F.sum(F.col("n") * offset * offset).alias("s2"),
            F.min("price").alias("least"),
            F.max("price").alias("most"),
        )
    )


def merge_histograms(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    return hist.groupBy(*keys, "bucket").agg(*[merge(c).alias(c) for c, merge in MERGED.items()])


def locate_summary(hist: DataFrame, keys: Sequence[str], width: float) -> DataFrame:
    """``locate`` for the median, with the mean and the sum of squared deviations."""
    group = Window.partitionBy(*keys)
    centre = (F.col("bucket") + 0.5) * width
    priced = F.when(F.col("bucket").isNotNull(), F.col("weight"))
    mean = F.try_divide(F.sum("total").over(group), F.sum(priced).over(group))
    shift = F.col("mean") - centre
    totals = [
        F.max("mean").alias("mean"),
        F.sum(F.col("s2") - 2 * shift * F.col("s1") + priced * shift * shift).alias("squares"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    ]
    return locate(hist.withColumn("mean", mean), keys, [0.5], totals)


def select_summary(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_values, mean, median, std); the deviation is null below two values."""
    variance = F.try_divide(F.greatest(F.col("squares"), F.lit(0.0)), F.col("n_values") - 1)
    std = F.when(F.col("least") == F.col("most"), 0.0).otherwise(F.sqrt(variance))
    return select_values(values, keys, [0.5], ["median"]).select(
        *keys, "n_values", "mean", "median", F.when(F.col("n_values") > 1, std).alias("std")
    )


def grouped_summary(cells: DataFrame, keys: Sequence[str], width: float) -> DataFrame:
    """Count, mean, exact median and sample deviation of ``price`` per key."""
    wanted = wanted_buckets(locate_summary(histogram(cells, keys, width), keys, width), [0.5])
    values = _values(cells, keys, width)
    return select_summary(wanted.join(values, [*keys, "bucket"], "left"), keys)
