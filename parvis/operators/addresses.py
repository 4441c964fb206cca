"""Addresses recovered for every listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.answers import address_prompt, parse_address_answer
from ..functions.text import address_clues, address_usable, choose_address, effective_zip
from ..options import DEFAULTS, Options


def attach_answers(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """``rows`` with ``response_text`` and ``answered_by``, null without an answer.

    The latest by ``answered_at`` counts. Without that column a second answer to one listing is
    an error. ``model``, if the answers have it, becomes ``answered_by``. Answers that carry
    ``row_idx`` go to that row only, so several listings may share an id.
    """
    keys = ["listing_id", "row_idx"] if "row_idx" in answers.columns else ["listing_id"]
    model = F.col("model") if "model" in answers.columns else F.lit(None).cast("string")
    answer = F.struct("response_text", model.alias("model"))
    if "answered_at" in answers.columns:
        one = F.max_by(answer, "answered_at")
    else:
        repeated = F.raise_error(F.concat(F.lit("several answers without answered_at for "), F.first("listing_id")))
        one = F.when(F.count(F.lit(1)) > 1, repeated.cast("struct<response_text:string,model:string>")).otherwise(F.first(answer))
    one_each = answers.groupBy(*keys).agg(one.alias("_one"))
    one_each = one_each.select(*keys, F.col("_one.response_text").alias("response_text"), F.col("_one.model").alias("answered_by"))
    return rows.join(one_each, keys, "left").select(*rows.columns, "response_text", "answered_by")


def _columns_of(rows: DataFrame, struct: Column, names: list[str]) -> DataFrame:
    """``rows`` with the fields of ``struct`` as columns.

    A generator of one row: unlike a projection it is never merged into the expressions and
    filters above it, so every pattern is matched once per listing.
    """
    return rows.select(*rows.columns, F.inline(F.array(struct)).alias(*names))


def enrich_addresses(listings: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Listings with address_clean, address_zipcode, address_confidence and address_method."""
    rows = listings if answers is None else attach_answers(listings, answers)
    clues = address_clues(F.col("raw_address"), F.col("description"))
    rows = _columns_of(rows, F.struct(*[c.alias(f"_{name}") for name, c in clues.items()]), [f"_{c}" for c in clues])
    answer = None if answers is None else parse_address_answer(F.col("response_text"), F.col("code_postal"))
    best = choose_address({name: F.col(f"_{name}") for name in clues}, F.col("code_postal"), answer)
    found = ["address_clean", "address_zipcode", "address_confidence", "address_method"]
    return _columns_of(rows, best, found).select(*listings.columns, *found)


def address_prompts(addressed: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Prompts for the listings whose address the rules could not find."""
    missing = addressed.filter(F.col("address_method") == fixed.NOT_FOUND[0])
    return missing.select("listing_id", address_prompt(F.col("description"), o.prompt_chars).alias("prompt"))


def method_counts(addressed: DataFrame) -> DataFrame:
    """Listings per extraction method, and how many of them are usable."""
    usable = address_usable(F.col("address_zipcode"), F.col("address_confidence"))
    confident = F.col("address_confidence") >= fixed.USABLE_CONFIDENCE
    return addressed.groupBy("address_method").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(usable).alias("n_usable"), F.count_if(confident).alias("n_confident")
    )


def missing_addresses(listings: DataFrame) -> DataFrame:
    blank = F.coalesce(F.trim("raw_address"), F.lit("")) == ""
    return listings.agg(F.count_if(blank).alias("missing"))


def _property_type(listings: DataFrame, o: Options) -> Column:
    if "property_type" not in listings.columns:
        return F.lit(o.default_type)
    known = F.initcap(F.trim("property_type"))
    return F.when(known.isin(*fixed.PROPERTY_TYPES), known).otherwise(F.lit(o.default_type))


def with_market(addressed: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Add ``zipcode`` and ``property_type``, the market in which a listing is valued, and ``address``."""
    return addressed.withColumns(
        {
            "address": F.col("address_clean"),
            "zipcode": effective_zip(F.col("address_zipcode"), F.col("code_postal"), o.default_zip).cast("int"),
            "property_type": _property_type(addressed, o),
        }
    )
