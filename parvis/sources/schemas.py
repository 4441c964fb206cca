"""Schemas of the input and output tables."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _table(*columns):
    return StructType([StructField(name, kind, True) for name, kind in columns])


LISTINGS = _table(
    ("row_idx", LongType()),
    ("listing_id", StringType()),
    ("raw_address", StringType()),
    ("description", StringType()),
    ("code_postal", IntegerType()),
    ("surface_m2", DoubleType()),
    ("asking_price", LongType()),
    ("source", StringType()),
    ("pricing_bias", StringType()),
    ("property_type", StringType()),
)

SALES = _table(
    ("id_mutation", StringType()),
    ("date_mutation", DateType()),
    ("code_postal", IntegerType()),
    ("type_local", StringType()),
    ("surface_reelle_bati", DoubleType()),
    ("valeur_fonciere", DoubleType()),
    ("nombre_pieces_principales", IntegerType()),
    ("prix_m2", DoubleType()),
)

DEDUP_LOG = _table(
    ("removed_id", StringType()),
    ("kept_id", StringType()),
    ("reason", StringType()),
    ("price_removed", LongType()),
    ("price_kept", LongType()),
)

ANSWERS = _table(("listing_id", StringType()), ("response_text", StringType()))

REMOVALS = StructType([StructField("removed_idx", LongType(), True), *DEDUP_LOG.fields])

RESULTS = _table(
    ("listing_id", StringType()),
    ("address", StringType()),
    ("zipcode", IntegerType()),
    ("surface_m2", DoubleType()),
    ("asking_price", LongType()),
    ("fair_value", LongType()),
    ("ci_low", LongType()),
    ("ci_high", LongType()),
    ("predicted_m2", DoubleType()),
    ("market_m2", DoubleType()),
    ("price_gap_pct", DoubleType()),
    ("signal", StringType()),
    ("signal_strength", StringType()),
    ("confidence_score", DoubleType()),
    ("n_comparables", LongType()),
    ("freshness_days", DoubleType()),
    ("trend_pct", DoubleType()),
    ("executive_summary", StringType()),
    ("recommendation", StringType()),
    ("report_full", StringType()),
    ("generated_by", StringType()),
    ("pricing_bias_gt", StringType()),
)
