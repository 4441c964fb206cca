"""The written memo of a valued listing, as column expressions over the valued table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECTIONS = ["executive_summary", "valuation_section", "market_context", "risk_factors", "recommendation", "data_note"]
ANSWERED_SECTIONS = SECTIONS[:5]


def number(x: Column, decimals: int, grouped: bool = False, signed: bool = False) -> Column:
    """Half-even decimal text, with optional thousands separators and leading sign."""
    text = F.format_number(x, decimals)
    if not grouped:
        text = F.replace(text, F.lit(","), F.lit(""))
    return F.concat(F.when(x >= 0, "+").otherwise(""), text) if signed else text


def euros(x: Column) -> Column:
    return F.concat(number(x, 0, grouped=True), F.lit("€"))


def join_text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def place() -> Column:
    return F.coalesce(F.col("zipcode").cast("string"), F.lit("75XXX"))


def surface_text() -> Column:
    return F.coalesce(F.col("surface_m2").cast("string"), F.lit("N/A"))


def template_sections() -> dict[str, Column]:
    """The six sections written from the figures of the row alone."""
    c = F.col
    gap, signal, score = c("price_gap_pct"), c("signal"), c("confidence_score")
    under, over = signal == "undervalued", signal == "overvalued"
    discount = number(F.abs(gap), 1)
    score_text = join_text(number(score, 2), "/1.00")
    count, age = c("n_comparables").cast("string"), number(c("freshness_days_exact"), 0)

    position = (
        F.when(under, join_text("priced ", discount, "% below its estimate (undervalued)"))
        .when(over, join_text("priced ", number(gap, 1), "% above its estimate (overvalued)"))
        .otherwise("fairly priced")
    )
    return {
        "executive_summary": join_text(
            "The listing, ", surface_text(), "m² in Paris ", place(), ", is ", position,
            " against recent recorded sales. ",
            F.when(over, "Handle with caution.").otherwise("Worth a closer look."),
        ),
        "valuation_section": join_text(
            "Asked: ", euros(c("asking_price")), ". Estimated: ", euros(c("fair_value")),
            " (80% interval ", euros(c("ci_low")), " – ", euros(c("ci_high")),
            "). Asking price against estimate: ", number(gap, 1, signed=True), "%.",
        ),
        "market_context": join_text(
            count, " comparable sales in Paris ", place(), ", median ",
            number(c("market_median_m2"), 0, grouped=True), " €/m², one-year trend ",
            number(c("trend_pct"), 1, signed=True), "%.",
        ),
        "risk_factors": join_text(
            "Evidence score ", score_text, " (",
            F.when(score > 0.6, "adequate").otherwise("limited, check by other means"),
            "). Sales are ", age, " days old on average. Exposed to interest rates and to Paris rental rules.",
        ),
        "recommendation": F.when(
            under & (score > 0.5),
            join_text("MONITOR — possible discount of ", discount, "%. Confirm address and surface, ask for the surveys."),
        )
        .when(over, join_text("PASS — asking price is ", number(gap, 1), "% over the estimate. Negotiate or drop."))
        .otherwise("NEUTRAL — no clear mispricing. Decide on yield and strategy."),
        "data_note": join_text(
            "Written from a template. ", count, " comparable sales, ", age, "d old on average. Score ", score_text, ".",
        ),
    }


def answered_data_note() -> Column:
    """Data note of a memo whose prose came from a model answer."""
    score = F.col("confidence_score")
    return join_text(
        F.col("n_comparables").cast("string"), " comparable sales, ",
        number(F.col("freshness_days_exact"), 0), " days old on average. Score ", number(score, 2), "/1.00. ",
        F.when(score > 0.7, "High confidence.").otherwise("Limited data, use with caution."),
    )


def memo_text() -> Column:
    """The whole memo as plain text."""
    c = F.col
    return F.concat_ws(
        "\n",
        join_text("INVESTMENT MEMO — ", c("listing_id")), F.lit("=" * 50), F.lit(""),
        F.lit("EXECUTIVE SUMMARY"), c("executive_summary"), F.lit(""),
        F.lit("VALUATION ANALYSIS"), c("valuation_section"), F.lit(""),
        F.lit("MARKET CONTEXT"), c("market_context"), F.lit(""),
        F.lit("RISK FACTORS"), c("risk_factors"), F.lit(""),
        F.lit("RECOMMENDATION"), c("recommendation"), F.lit(""),
        F.lit("DATA NOTE"), c("data_note"), F.lit(""),
        join_text("[Generated by: ", c("generated_by"), "]"),
    )


def memo_json() -> Column:
    """The memo as a JSON object of eight strings."""
    return F.to_json(
        F.struct(
            F.col("listing_id"),
            F.col("executive_summary"),
            F.col("valuation_section").alias("valuation"),
            F.col("market_context"),
            F.col("risk_factors"),
            F.col("recommendation"),
            F.col("data_note"),
            F.col("generated_by"),
        )
    )
