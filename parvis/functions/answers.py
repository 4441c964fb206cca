"""Prompts for a hosted model and the parsing of its answers.

The engine calls no model: prompts are a column to be answered elsewhere, answers come
back as a table (listing_id, response_text).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import fixed
from .memo import ANSWERED_SECTIONS, euros, join_text, number, place, surface_text
from .text import strip

ANALYST_ROLE = (
    "You write short investment memos on Paris property for an institutional reader, in English. "
    "Use the given figures only, say so when the evidence is thin, and keep a sober tone."
)


def _json_body(response: Column) -> Column:
    return strip(F.regexp_replace(strip(response), fixed.ANSWER_FENCES, ""))


def address_prompt(description: Column, chars: int | None = None) -> Column:
    """Prompt over the whole description, or over its first ``chars`` characters."""
    start = F.coalesce(description, F.lit(""))
    start = start if chars is None else F.substring(start, 1, chars)
    return join_text(
        'Find the street address in this French property advertisement. Answer with one JSON object only: '
        '{"address": "...", "zipcode": 75XXX}, or {"address": null} if the text has none.\n\nAdvertisement: ',
        start,
    )


def parse_address_answer(response: Column, listing_zip: Column) -> Column:
    """struct(address, zipcode, confidence, method), or null when the answer holds no address."""
    fields = F.from_json(_json_body(response), "map<string,string>")
    address = F.nullif(fields["address"], F.lit(""))
    zipcode = F.when(F.map_contains_key(fields, "zipcode"), fields["zipcode"].try_cast("int")).otherwise(listing_zip)
    method, confidence = fixed.FROM_ANSWER
    return F.when(
        address.isNotNull(),
        F.struct(
            address.alias("address"),
            zipcode.cast("int").alias("zipcode"),
            F.lit(confidence).alias("confidence"),
            F.lit(method).alias("method"),
        ),
    )


def memo_prompt() -> Column:
    """Prompt over the valued table; every figure is already computed."""
    c = F.col
    asking_m2 = c("asking_price") / F.greatest(c("surface_m2"), F.lit(1.0))
    return join_text(
        "Write an investment memo from these figures and no others.\n\nPROPERTY\n- Listing: ", c("listing_id"),
        "\n- Address: ", F.coalesce(c("address"), F.lit("Paris")),
        "\n- Kind: ", c("property_type"), ", ", surface_text(), " m², zip ", place(),
        "\n\nVALUATION\n- Asked: ", euros(c("asking_price")), " (", number(asking_m2, 0), " €/m²)",
        "\n- Estimated: ", euros(c("fair_value")), " (", number(c("predicted_m2_exact"), 0), " €/m²)",
        "\n- 80% interval: ", euros(c("ci_low")), " to ", euros(c("ci_high")),
        "\n- Gap: ", number(c("price_gap_pct"), 1, signed=True), "% of the estimate",
        "\n- Signal: ", c("signal"), " (", c("signal_strength"), ")",
        "\n\nMARKET\n- Comparable sales: ", c("n_comparables").cast("string"),
        "\n- Median: ", number(c("market_median_m2"), 0), " €/m²",
        "\n- Average age: ", number(c("freshness_days_exact"), 0), " days",
        "\n- One-year trend: ", number(c("trend_pct"), 1, signed=True), "%",
        "\n- Evidence score: ", number(c("confidence_score"), 2), "/1.00",
        "\n\nSections: summary (two sentences at most); valuation (gap and interval); market (trend and volume); "
        "risks (data, market, property); recommendation (buy, monitor or pass, and on what condition).\n"
        "Answer with one JSON object of strings with the keys " + ", ".join(ANSWERED_SECTIONS) + ".",
    )


def parse_memo_answer(response: Column) -> Column:
    """struct of the five prose sections, or null unless the answer has all of them."""
    schema = StructType([StructField(name, StringType()) for name in ANSWERED_SECTIONS])
    memo = F.from_json(_json_body(response), schema)
    complete = F.lit(True)
    for name in ANSWERED_SECTIONS:
        complete = complete & memo[name].isNotNull()
    return F.when(complete, memo)
