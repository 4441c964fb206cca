"""Counts, accuracy against known truth, and sample memos."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scoring import signal_of_bias


def source_counts(listings: DataFrame) -> DataFrame:
    return listings.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def signal_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("signal").agg(F.count(F.lit(1)).alias("n"))


def first_n_listings(listings: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` listings in row order; all of them for 0 or None."""
    # A limit leaves one partition; later steps deserve more.
    return listings.orderBy("row_idx").limit(n).repartition("row_idx") if n else listings


def with_truth(results: DataFrame) -> DataFrame:
    """Results whose true label is known, with that label as ``signal_gt``."""
    return results.withColumn("signal_gt", signal_of_bias(F.col("pricing_bias_gt"))).na.drop(subset=["signal_gt"])


def signal_accuracy(results: DataFrame) -> DataFrame:
    """One row: correct labels, labelled listings and their ratio in percent."""
    correct = F.count_if(F.col("signal") == F.col("signal_gt"))
    total = F.count(F.lit(1))
    return with_truth(results).agg(
        correct.alias("correct"), total.alias("total"), F.try_divide(correct * 100.0, total).alias("accuracy_pct")
    )


def confusion_matrix(results: DataFrame) -> DataFrame:
    """True label by predicted label."""
    counts = with_truth(results).groupBy("signal_gt").pivot("signal", fixed.SIGNALS).count()
    return counts.na.fill(0, fixed.SIGNALS)


def signal_precision(results: DataFrame) -> DataFrame:
    """Precision and recall of each label, null where undefined."""
    per_cell = with_truth(results).groupBy("signal_gt", "signal").agg(F.count(F.lit(1)).alias("n"))
    per_label = per_cell.select(
        F.explode(F.array(*[F.lit(s) for s in fixed.SIGNALS])).alias("label"), "signal_gt", "signal", "n"
    ).groupBy("label")
    is_truth, is_said = F.col("signal_gt") == F.col("label"), F.coalesce(F.col("signal") == F.col("label"), F.lit(False))

    def counted(test):
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    counts = per_label.agg(
        counted(is_truth & is_said).alias("hits"), counted(is_said).alias("predicted"), counted(is_truth).alias("actual")
    )
    return counts.withColumns(
        {"precision": F.try_divide("hits", "predicted"), "recall": F.try_divide("hits", "actual")}
    )


def top_memo_per_signal(valued: DataFrame, n: int = 3) -> DataFrame:
    """The most confident row of each label, undervalued first, for at most ``n`` labels.

    Ties go to the lower ``row_idx``. A maximum per label, merged before the shuffle.
    """
    shown = [c for c in ("listing_id", "confidence_score", "report_full") if c in valued.columns]
    best = F.max_by(F.struct(*shown), F.struct(F.col("confidence_score"), -F.col("row_idx"))).alias("best")
    order = F.array_position(F.array(*[F.lit(s) for s in fixed.SIGNALS]), F.col("signal"))
    picked = valued.filter(F.col("signal").isNotNull()).groupBy("signal").agg(best)
    return picked.withColumn("rank", order).orderBy("rank").limit(n).select("signal", "best.*")
