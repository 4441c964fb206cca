"""Ingest: raw listings in, clean listings and a log of removals out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import exact_log, exact_survivors, key_columns, mark_exact_duplicates, with_normal_address
from ..operators.resolve import near_log
from ..options import DEFAULTS, Options
from ..session import cut_lineage
from ..sources.schemas import DEDUP_LOG
from ..sources.tables import read_listings, write_table


def removals(listings: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """The full log with ``removed_idx``, the row number of the removed listing."""
    marked = cut_lineage(mark_exact_duplicates(cut_lineage(key_columns(listings)), o))
    return cut_lineage(exact_log(marked).unionByName(near_log(exact_survivors(marked), o)))


def without_removed(listings: DataFrame, removed: DataFrame) -> DataFrame:
    """``listings`` with ``address_norm``, but for the rows of the log ``removed``."""
    flagged = removed.select(F.col("removed_idx").alias("row_idx"))
    return with_normal_address(listings).join(flagged, "row_idx", "left_anti").select(*listings.columns, "address_norm")


def deduplicate(listings: DataFrame, o: Options = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(clean listings with ``address_norm``, removal log)."""
    removed = removals(listings, o)
    return without_removed(listings, removed), removed.select(*DEDUP_LOG.fieldNames())


def dedup_summary(listings: DataFrame, log: DataFrame) -> DataFrame:
    """One row: raw, clean and removed counts, the latter also by kind of match."""
    rows = listings.select(F.lit("listing").alias("kind")).unionAll(
        log.select(F.when(F.col("reason") == "exact_key_match", "exact").otherwise("fuzzy"))
    )
    raw, removed = F.count_if(F.col("kind") == "listing"), F.count_if(F.col("kind") != "listing")
    return rows.agg(
        raw.alias("raw"),
        (raw - removed).alias("clean"),
        removed.alias("removed"),
        F.count_if(F.col("kind") == "exact").alias("removed_exact"),
        F.count_if(F.col("kind") == "fuzzy").alias("removed_fuzzy"),
    )


def ingest(spark: SparkSession, raw_path: str, clean_path: str, log_path: str, o: Options = DEFAULTS) -> DataFrame:
    """Deduplicate the listings at ``raw_path`` and write both outputs; returns the clean ones."""
    clean, log = deduplicate(read_listings(spark, raw_path), o)
    write_table(log, log_path)
    write_table(clean, clean_path)
    return clean
