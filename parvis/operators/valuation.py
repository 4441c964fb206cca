"""Fair value, interval, label and memo of each listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import memo, scoring
from ..functions.answers import memo_prompt, parse_memo_answer
from ..options import DEFAULTS, Options
from ..session import cut_lineage
from .addresses import attach_answers
from .comparables import PROBE, comparables
from .models import ForestModel, StatisticalModel
from .spread import counted_keys, deal, look_up


def with_confidence(figures: DataFrame) -> DataFrame:
    return figures.withColumn(
        "confidence_score",
        scoring.confidence_score(
            F.col("n_comparables"), F.col("freshness_days"), F.col("market_std_m2"), F.col("market_mean_m2")
        ),
    )


def value_requests(figures: DataFrame, model: StatisticalModel | ForestModel, o: Options = DEFAULTS) -> DataFrame:
    """Value, interval and confidence of each request that has enough sales behind it."""
    enough = figures.filter(F.col("n_comparables") >= o.min_evidence)
    priced = model.predict(enough).filter(F.col("predicted_m2_exact").isNotNull())
    surface = F.col("surface_m2")
    return with_confidence(priced).withColumns(
        {
            "fair_value": scoring.whole_thousands(F.col("predicted_m2_exact"), surface),
            "ci_low": scoring.whole_thousands(F.col("low_m2"), surface),
            "ci_high": scoring.whole_thousands(F.col("high_m2"), surface),
        }
    )


def label(valued: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Add price_gap_pct, signal and signal_strength; labels use the gap before rounding."""
    gap = scoring.price_gap(F.col("asking_price"), F.col("fair_value"))
    return valued.withColumns(
        {
            "price_gap_pct": F.bround(gap, 1),
            "signal": scoring.signal(gap, o),
            "signal_strength": scoring.signal_strength(gap, o),
        }
    )


def value(
    listings: DataFrame, cells: DataFrame, model: StatisticalModel | ForestModel, o: Options = DEFAULTS
) -> DataFrame:
    """Valued listings; those without a surface or with too few sales are left out.

    ``listings`` have zipcode, property_type, surface_m2, asking_price and row_idx. Value
    and interval depend on the first three only and are computed once per combination.
    """
    rows = listings.filter(F.col("surface_m2").isNotNull())
    rows = rows.withColumn("asking_price", F.col("asking_price").cast("bigint"))
    probes = counted_keys(rows, PROBE)
    figures = comparables(probes, cells, o)
    requests = value_requests(figures, model, o).withColumnsRenamed({"freshness_days": "freshness_days_exact"})
    rows = deal(rows, probes, PROBE, "row_idx", o)
    return label(look_up(rows, requests, PROBE, o), o).drop("slice", "low_m2", "high_m2")


def write_memos(valued: DataFrame, answers: DataFrame | None = None, o: Options = DEFAULTS) -> DataFrame:
    """Add the memo sections and ``generated_by``; a complete model answer replaces the template."""
    sections = memo.template_sections()
    if answers is None:
        return valued.withColumns({**sections, "generated_by": F.lit("template")})
    rows = attach_answers(valued, answers).withColumn("_answer", parse_memo_answer(F.col("response_text")))
    answered = F.col("_answer").isNotNull()
    merged = {s: F.coalesce(F.col("_answer")[s], sections[s]) for s in memo.ANSWERED_SECTIONS}
    merged["data_note"] = F.when(answered, memo.answered_data_note()).otherwise(sections["data_note"])
    merged["generated_by"] = F.when(
        answered, F.concat(F.lit("llm:"), F.coalesce("answered_by", F.lit(o.answering_model)))
    ).otherwise("template")
    return rows.withColumns(merged).drop("_answer", "response_text", "answered_by")


def memo_prompts(valued: DataFrame) -> DataFrame:
    return valued.select("listing_id", memo_prompt().alias("prompt"))


def results(valued_with_memo: DataFrame) -> DataFrame:
    """The 22 columns of the results table."""
    known = set(valued_with_memo.columns)
    made = {
        "predicted_m2": F.bround("predicted_m2_exact", 0),
        "market_m2": F.bround("market_median_m2", 0),
        "freshness_days": F.bround("freshness_days_exact", 0),
        "report_full": memo.memo_text(),
        "pricing_bias_gt": F.col("pricing_bias") if "pricing_bias" in known else F.lit("unknown"),
    }
    return valued_with_memo.select(*[made[c].alias(c) if c in made else F.col(c) for c in fixed.RESULT_COLUMNS])
