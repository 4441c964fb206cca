"""Valuation of real-estate listings on Spark."""

from .functions.memo import memo_json, memo_text
from .functions.scoring import confidence_score
from .functions.text import (
    address_similarity,
    address_usable,
    arrond_to_zip,
    effective_zip,
    extract_address,
    normalize_address,
)
from .operators.addresses import address_prompts, enrich_addresses
from .operators.comparables import comparable_sales, comparables
from .operators.evaluation import confusion_matrix, signal_accuracy, signal_precision, top_memo_per_signal
from .operators.market import derive_price_m2, market_quantiles, market_stats, market_trend, sales_cells
from .operators.models import fit_quantiles
from .operators.valuation import memo_prompts, results, value, write_memos
from .options import Options
from .plans.appraisal import appraise, run, run_files
from .plans.ingest import deduplicate, ingest
from .session import with_defaults
from .sources.tables import number_rows, read_answers, read_listings, read_sales, write_table

__all__ = [
    "Options",
    "address_prompts",
    "address_similarity",
    "address_usable",
    "appraise",
    "arrond_to_zip",
    "comparable_sales",
    "comparables",
    "confidence_score",
    "confusion_matrix",
    "deduplicate",
    "derive_price_m2",
    "effective_zip",
    "enrich_addresses",
    "extract_address",
    "fit_quantiles",
    "ingest",
    "market_quantiles",
    "market_stats",
    "market_trend",
    "memo_json",
    "memo_prompts",
    "memo_text",
    "normalize_address",
    "number_rows",
    "read_answers",
    "read_listings",
    "read_sales",
    "results",
    "run",
    "run_files",
    "sales_cells",
    "signal_accuracy",
    "signal_precision",
    "top_memo_per_signal",
    "value",
    "with_defaults",
    "write_memos",
    "write_table",
]
