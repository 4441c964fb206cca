"""Exact duplicates: equal normalised address, surface and zip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_address
from ..options import DEFAULTS, Options
from ..session import cut_lineage
from .spread import KEY_ROWS, copies, deal

EXACT_KEY = ["address_norm", "surface_m2", "code_postal"]
NARROW = ["row_idx", "listing_id", *EXACT_KEY, "asking_price"]


def with_normal_address(listings: DataFrame) -> DataFrame:
    return listings.withColumn("address_norm", normalize_address(F.col("raw_address")))


def key_columns(listings: DataFrame) -> DataFrame:
    """The columns that duplicate removal reads. It reads them often: cut their lineage first."""
    # One file may hold most rows; addresses are normalised by all tasks.
    return with_normal_address(listings.repartition("row_idx")).select(*NARROW)


def mark_exact_duplicates(keyed: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Key columns of every listing, with the cheapest listing of its key where that is another one.

    ``kept`` is a struct (price, row_idx, listing_id), null for rows that stay. The first
    row wins ties and unpriced rows come last. The cheapest row of a key is an aggregate,
    merged before the shuffle and written; it is then looked up by slices of the key, as many
    as its copies call for, so that a key with very many copies is never handled by one task.
    Rows without an address have a slice of their own each and find nothing.
    """
    named = F.col("address_norm") != ""
    rank = F.struct(
        F.col("asking_price").isNull().alias("unpriced"),
        F.col("asking_price").alias("price"),
        F.col("row_idx").alias("row_idx"),
        F.col("listing_id").alias("listing_id"),
    )
    counted = keyed.filter(named).groupBy(*EXACT_KEY).agg(F.count(F.lit(1)).alias(KEY_ROWS), F.min(rank).alias("kept"))
    counted = cut_lineage(counted.filter(F.col(KEY_ROWS) > 1))
    dealt = deal(keyed, counted, EXACT_KEY, "row_idx", o)
    rows = dealt.withColumn("slice", F.when(named, F.col("slice")).otherwise(F.xxhash64("row_idx")))
    cheapest = copies(counted, o).select(
        *[F.col(k).alias(f"kept_{k}") for k in EXACT_KEY], "kept", F.col("slice").alias("kept_slice")
    )
    same_key = (F.col("slice") == F.col("kept_slice")) & (F.col("address_norm") == F.col("kept_address_norm"))
    for key in EXACT_KEY[1:]:
        same_key = same_key & F.col(key).eqNullSafe(F.col(f"kept_{key}"))
    marked = rows.join(cheapest, same_key, "left")
    other = F.col("kept.row_idx") != F.col("row_idx")
    return marked.select(*NARROW, F.when(other, F.col("kept")).alias("kept"))


def exact_log(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("kept").isNotNull()).select(
        F.col("row_idx").alias("removed_idx"),
        F.col("listing_id").alias("removed_id"),
        F.col("kept.listing_id").alias("kept_id"),
        F.lit("exact_key_match").alias("reason"),
        F.col("asking_price").alias("price_removed"),
        F.col("kept.price").alias("price_kept"),
    )


def exact_survivors(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("kept").isNull()).drop("kept")
