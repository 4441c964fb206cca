"""The registered queries: each runs one operator over the whole derived tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parvis import fixed
from parvis.functions import memo, scoring
from parvis.functions.answers import parse_address_answer
from parvis.functions.text import address_usable
from parvis.operators import addresses, comparables, dedup, evaluation, market, models, near, sketches, valuation
from parvis.options import Options
from parvis.plans import appraisal, ingest, model_store
from parvis.session import cut_lineage, shared_folder
from parvis.sources import derived, schemas, tables

from .oracle import ADDRESS_ANSWERS_SQL, DIRTY_SALES_SQL, MEMO_ANSWERS_SQL, UNPLACED_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CROWDED = Options(hot_cell_rows=4, first_round_rows=64)
LOG = ["removed_id", "kept_id", "reason", "price_removed", "price_kept"]


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Figures to six decimals, so that the order of a sum does not show."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def sales(spark, sf):
    return market.derive_price_m2(derived.sales(spark, sf))


def cells(spark, sf):
    return cut_lineage(market.sales_cells(sales(spark, sf)))


def keyed(spark, sf):
    return cut_lineage(dedup.key_columns(derived.listings(spark, sf)))


def marked(spark, sf):
    return dedup.mark_exact_duplicates(keyed(spark, sf))


def placed(spark, sf):
    return addresses.with_market(addresses.enrich_addresses(derived.listings(spark, sf)))


def probes(spark, sf):
    return placed(spark, sf).select(*comparables.PROBE).distinct()


def figures(spark, sf):
    return comparables.comparables(cut_lineage(probes(spark, sf)), cells(spark, sf))


def full_run(spark, sf, method="statistical", **more):
    return appraisal.run(derived.listings(spark, sf), derived.sales(spark, sf), method=method, **more)


def unplaced(spark, sf):
    return spark.sql(UNPLACED_SQL, listings=derived.listings(spark, sf))


def own_answers(spark, answers_sql, listings):
    """The answers of ``answers_sql`` with the ``row_idx`` of their listing, which an id of several listings does not tell."""
    mark = F.lit("\x1f")
    told = F.concat("listing_id", mark, F.col("row_idx").cast("string"))
    found = spark.sql(answers_sql, listings=listings.withColumn("listing_id", told))
    row = F.substring_index("listing_id", "\x1f", -1)
    return found.select(
        F.substring_index("listing_id", "\x1f", 1).alias("listing_id"),
        F.replace("response_text", F.concat(mark, row), F.lit("")).alias("response_text"),
        row.cast("bigint").alias("row_idx"),
    )


def address_answers(spark, sf):
    return own_answers(spark, ADDRESS_ANSWERS_SQL, unplaced(spark, sf))


@query
def derive_price_m2(spark, sf):
    return rounded(sales(spark, sf), "prix_m2").select("id_mutation", "code_postal", "type_local", "prix_m2")


@query
def normalize_address(spark, sf):
    return dedup.key_columns(derived.listings(spark, sf)).select("row_idx", "listing_id", "address_norm")


@query
def source_counts(spark, sf):
    return evaluation.source_counts(derived.listings(spark, sf))


@query
def missing_addresses(spark, sf):
    return addresses.missing_addresses(derived.listings(spark, sf))


@query
def first_n_listings(spark, sf):
    return evaluation.first_n_listings(derived.listings(spark, sf), 60)


@query
def exact_dedup_log(spark, sf):
    return dedup.exact_log(marked(spark, sf)).select(*LOG)


@query
def exact_dedup_survivors(spark, sf):
    return dedup.exact_survivors(marked(spark, sf))


@query
def fuzzy_pairs(spark, sf):
    rows = cut_lineage(dedup.exact_survivors(marked(spark, sf)))
    return rounded(near.near_pairs(rows, rows, narrow=True), "similarity").select("i", "j", "similarity")


@query
def dedup_log(spark, sf):
    return ingest.deduplicate(derived.listings(spark, sf))[1]


@query
def dedup_log_crowded(spark, sf):
    """The same log with every block treated as a crowd and resolved in small rounds."""
    return ingest.deduplicate(derived.listings(spark, sf), CROWDED)[1]


@query
def dedup_clean(spark, sf):
    return ingest.deduplicate(derived.listings(spark, sf))[0]


@query
def dedup_summary(spark, sf):
    listings = derived.listings(spark, sf)
    return ingest.dedup_summary(listings, ingest.deduplicate(listings)[1])


@query
def extract_address(spark, sf):
    found = addresses.enrich_addresses(derived.listings(spark, sf))
    return found.select(
        "row_idx", "listing_id", "address_clean", "address_zipcode", "address_confidence", "address_method"
    )


@query
def address_usable_flag(spark, sf):
    found = addresses.enrich_addresses(derived.listings(spark, sf))
    usable = address_usable(F.col("address_zipcode"), F.col("address_confidence"))
    return found.select("listing_id", usable.alias("usable"))


@query
def address_method_counts(spark, sf):
    return addresses.method_counts(addresses.enrich_addresses(derived.listings(spark, sf)))


@query
def effective_zip(spark, sf):
    return placed(spark, sf).select("row_idx", "listing_id", "zipcode", "property_type")


@query
def address_prompts(spark, sf):
    return addresses.address_prompts(addresses.enrich_addresses(unplaced(spark, sf)))


@query
def llm_address_parse(spark, sf):
    rows = addresses.attach_answers(unplaced(spark, sf), address_answers(spark, sf))
    parsed = parse_address_answer(F.col("response_text"), F.col("code_postal"))
    return rows.select("listing_id", parsed.alias("parsed")).select("listing_id", "parsed.*")


@query
def llm_merge(spark, sf):
    found = addresses.enrich_addresses(unplaced(spark, sf), address_answers(spark, sf))
    return found.select("listing_id", "address_clean", "address_zipcode", "address_confidence", "address_method")


@query
def market_stats(spark, sf):
    return rounded(market.market_stats(cells(spark, sf)), "median", "mean", "std")


@query
def market_quantiles(spark, sf):
    return rounded(market.market_quantiles(cells(spark, sf)), "q10", "q50", "q90")


@query
def market_sketch(spark, sf):
    """Sketches of two deliveries of sales, stored apart and merged: exact counts, and ranks within 1 %."""
    sold = sales(spark, sf)
    late = F.coalesce(F.year("date_mutation") >= 2024, F.lit(False))
    stored = [cut_lineage(sketches.market_sketches(part)) for part in (sold.filter(~late), sold.filter(late))]
    quantiles = cut_lineage(sketches.sketched_quantiles(sketches.merge_sketches(stored)))
    checked = sketches.rank_errors(quantiles, cells(spark, sf))
    near = [(F.col(f"error_{name}") <= 0.01).alias(f"{name}_within") for name in sketches.NAMES]
    counts = quantiles.select(*market.MARKET, F.col("n").alias("n_sketched"))
    return checked.join(counts, market.MARKET).select(*market.MARKET, "n", "n_sketched", *near)


@query
def market_trend(spark, sf):
    return rounded(market.market_trend(cells(spark, sf)), "median_before", "median_after")


@query
def comparables_tier(spark, sf):
    return comparables.choose_tier(probes(spark, sf), cells(spark, sf)).select(
        *comparables.PROBE, "tier", "n_band_recent", "n_band", "n_pool_recent", "n_pool"
    )


@query
def comparables_figures(spark, sf):
    shown = ["market_median_m2", "market_mean_m2", "market_std_m2", "freshness_days"]
    return rounded(figures(spark, sf), *shown).select(*comparables.PROBE, "n_comparables", *shown, "trend_pct")


@query
def confidence_score(spark, sf):
    raw = scoring.raw_confidence(
        F.col("n_comparables"), F.col("freshness_days"), F.col("market_std_m2"), F.col("market_mean_m2")
    )
    scored = valuation.with_confidence(figures(spark, sf)).withColumn("raw_confidence", raw)
    return rounded(scored, "raw_confidence").select(*comparables.PROBE, "raw_confidence", "confidence_score")


def predictions(spark, sf, method):
    sold = cells(spark, sf)
    model = models.fit_quantiles(sales(spark, sf), method, cells=sold)
    asked = comparables.comparables(cut_lineage(probes(spark, sf)), sold).filter("n_comparables >= 3")
    return rounded(model.predict(asked), *models.PREDICTION).select(
        *comparables.PROBE, F.col("predicted_m2_exact").alias("predicted_m2"), "low_m2", "high_m2"
    )


@query
def statistical_value(spark, sf):
    return predictions(spark, sf, "statistical")


def market_range(spark, sf):
    """Least and greatest price of each market, by the names of a request."""
    priced = sales(spark, sf).groupBy(F.col("code_postal").alias("zipcode"), F.col("type_local").alias("property_type"))
    return priced.agg(F.min("prix_m2").alias("least"), F.max("prix_m2").alias("most"))


@query
def quantile_model(spark, sf):
    """What is determined about a forest: its requests, the order of its quantiles and the range of their market."""
    low, mid, high = F.col("low_m2"), F.col("predicted_m2"), F.col("high_m2")
    made = predictions(spark, sf, "forest").join(market_range(spark, sf), ["zipcode", "property_type"])
    return rounded(made, "least", "most").select(
        *comparables.PROBE,
        "least",
        "most",
        ((low <= mid) & (mid <= high)).alias("ordered"),
        ((low >= F.col("least") - 1e-6) & (high <= F.col("most") + 1e-6)).alias("inside"),
    )


def model_path(spark):
    return f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"


@query
def stored_model_value(spark, sf):
    """The statistical model stored, read back and asked."""
    sold, path = cells(spark, sf), model_path(spark)
    model_store.save_model(models.fit_quantiles(sales(spark, sf), cells=sold), path)
    asked = comparables.comparables(cut_lineage(probes(spark, sf)), sold).filter("n_comparables >= 3")
    return rounded(model_store.load_model(spark, path).predict(asked), *models.PREDICTION).select(
        *comparables.PROBE, F.col("predicted_m2_exact").alias("predicted_m2"), "low_m2", "high_m2"
    )


@query
def stored_forest(spark, sf):
    """Requests for which the forest, stored and read back, says what it said before."""
    path, asked = model_path(spark), cut_lineage(probes(spark, sf))
    model = models.fit_quantiles(sales(spark, sf), "forest")
    model_store.save_model(model, path)
    both = model.predict(asked).unionAll(model_store.load_model(spark, path).predict(asked))
    said = F.count_distinct(F.struct(*models.PREDICTION))
    return both.groupBy(*comparables.PROBE).agg((said == 1).alias("same"))


@query
def valuation_features(spark, sf):
    year = F.coalesce(F.year("date_mutation"), F.lit(2024))
    named = scoring.features(
        F.col("surface_reelle_bati"), F.col("code_postal"), F.col("type_local"), F.col("nombre_pieces_principales"), year
    )
    built = sales(spark, sf).select("id_mutation", *[named[f].alias(f) for f in fixed.FEATURES])
    return rounded(built, "log_surface")


@query
def scoring_features(spark, sf):
    named = models.scoring_columns()
    built = [named[f].alias(f) for f in fixed.FEATURES if f not in comparables.PROBE]
    return rounded(probes(spark, sf).select(*comparables.PROBE, *built), "log_surface")


@query
def statistical_model_metrics(spark, sf):
    model = models.fit_quantiles(sales(spark, sf), cells=cells(spark, sf))
    return rounded(model.metrics(), "mae_m2", "mape_pct")


def pinball(rows):
    """Mean pinball loss of the three quantiles, and the share of sales between the outer two."""
    n, price = F.col("n"), F.col("price")
    losses = [F.greatest(p * (price - F.col(q)), (p - 1) * (price - F.col(q))) for p, q in zip(fixed.QUANTILES, models.QUANTILES)]
    inside = F.when(price.between(F.col("q10"), F.col("q90")), n).otherwise(0)
    return rows.agg((F.sum(n * sum(losses)) / F.sum(n)).alias("loss"), (F.sum(inside) / F.sum(n)).alias("covered")).first()


@query
def quantile_model_metrics(spark, sf):
    """The forest learns from all sales; it errs less than one price for all, no more than market quantiles, and its interval covers 80 % and a little more."""
    sold, known = sales(spark, sf), cells(spark, sf).filter("price is not null")
    model = models.fit_quantiles(sold, "forest")
    got = model.metrics()
    spread = sold.agg(F.median("prix_m2").alias("mid"), F.count("prix_m2").alias("n")).first()
    plain = sold.agg(F.avg(F.abs(F.col("prix_m2") - spread["mid"])).alias("mad")).first()["mad"]
    forest = pinball(model.scored(model.training))
    markets = pinball(known.join(market.market_quantiles(known), market.MARKET))
    return got.select(
        "model",
        "n_train",
        (F.col("mae_m2") < plain).alias("better_than_one_price"),
        F.lit(forest["loss"] <= markets["loss"] * 1.001).alias("no_worse_than_markets"),
        F.lit(0.78 <= forest["covered"] <= 0.92).alias("covers"),
    )


# The flagship query and the reports on its result.


@query
def valuation_results(spark, sf):
    return full_run(spark, sf).results


@query
def valuation_forest(spark, sf):
    """Listings valued by the forest, with what is determined of their figures."""
    got = full_run(spark, sf, "forest").results
    ordered = (F.col("ci_low") <= F.col("fair_value")) & (F.col("fair_value") <= F.col("ci_high"))
    # Money is cut to whole thousands.
    by_zip = market_range(spark, sf).groupBy("zipcode").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    inside = (F.col("ci_low") > F.col("least") * F.col("surface_m2") - 1000) & (F.col("ci_high") <= F.col("most") * F.col("surface_m2"))
    return got.join(by_zip, "zipcode").select(
        "listing_id", "zipcode", "n_comparables", ordered.alias("ordered"), inside.alias("inside"), F.col("signal").isin(*fixed.SIGNALS).alias("labelled")
    )


@query
def run_metrics(spark, sf):
    return rounded(full_run(spark, sf).metrics, "mae_m2", "mape_pct")


@query
def sales_of_listings(spark, sf):
    """The sales behind every fiftieth listing."""
    asked = placed(spark, sf).filter("row_idx % 50 = 0").select(*comparables.PROBE).distinct()
    found = comparables.comparable_sales(cut_lineage(asked), sales(spark, sf), cells(spark, sf))
    return rounded(found, "prix_m2").select(*comparables.PROBE, "id_mutation", "date_mutation", "prix_m2")


@query
def signal_counts(spark, sf):
    return evaluation.signal_counts(full_run(spark, sf).results)


@query
def signal_accuracy(spark, sf):
    return rounded(evaluation.signal_accuracy(full_run(spark, sf).results), "accuracy_pct")


@query
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(full_run(spark, sf).results)


@query
def signal_precision(spark, sf):
    return rounded(evaluation.signal_precision(full_run(spark, sf).results), "precision", "recall")


@query
def top_memo_per_signal(spark, sf):
    return evaluation.top_memo_per_signal(full_run(spark, sf).valued)


@query
def memo_sections(spark, sf):
    return full_run(spark, sf).valued.select("listing_id", *memo.SECTIONS)


@query
def memo_text(spark, sf):
    return full_run(spark, sf).valued.select("listing_id", "report_full")


@query
def memo_json(spark, sf):
    return full_run(spark, sf).valued.select("listing_id", memo.memo_json().alias("memo"))


@query
def memo_prompts(spark, sf):
    return valuation.memo_prompts(full_run(spark, sf).valued)


@query
def llm_memo_merge(spark, sf):
    answers = own_answers(spark, MEMO_ANSWERS_SQL, derived.listings(spark, sf))
    return full_run(spark, sf, memo_answers=answers).valued.select("listing_id", *memo.SECTIONS, "generated_by")


# Tables written, read and run on as files.


def stored_inputs(spark, sf, ending=""):
    """A new folder with the listings and sales as files."""
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    tables.write_table(derived.listings(spark, sf), f"{folder}/listings{ending}")
    tables.write_table(derived.sales(spark, sf), f"{folder}/sales{ending}")
    return folder


def file_run(spark, sf, stage):
    """A stage that a run over CSV files has written, read back."""
    folder = stored_inputs(spark, sf, ".csv")
    appraisal.run_files(spark, f"{folder}/listings.csv", f"{folder}/sales.csv", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out/{stage}")


@query
def listings_scan(spark, sf):
    """Listings written as CSV without their order, numbered from the files and read again; the numbers count up from 0."""
    folder = stored_inputs(spark, sf, ".csv")
    plain = f"{folder}/plain.csv"
    tables.write_table(derived.listings(spark, sf).drop("row_idx"), plain)
    numbered = tables.number_rows(spark, plain, f"{folder}/numbered")
    rows = numbered.agg(F.count_distinct("row_idx").alias("n"), F.min("row_idx").alias("low"), F.max("row_idx").alias("high")).first()
    whole = rows["low"] == 0 and rows["high"] == rows["n"] - 1
    return numbered.drop("row_idx").withColumn("whole", F.lit(whole))


@query
def sales_scan(spark, sf):
    """Sales read from CSV."""
    return rounded(tables.read_sales(spark, f"{stored_inputs(spark, sf, '.csv')}/sales.csv"), "valeur_fonciere")


@query
def sales_rejects(spark, sf):
    """Fields of a dirty sales file that could not be read, with the reason."""
    path = f"{shared_folder(spark)}/dirty-{uuid.uuid4().hex}.csv"
    tables.write_table(spark.sql(DIRTY_SALES_SQL, sales=derived.sales(spark, sf)), path)
    found = tables.rejects(spark, path, schemas.SALES)
    return found.select(F.get_json_object("record", "$.id_mutation").alias("id_mutation"), "reasons")


@query
def clean_file(spark, sf):
    return file_run(spark, sf, "listings_clean")


@query
def log_file(spark, sf):
    return file_run(spark, sf, "dedup_log")


@query
def addressed_file(spark, sf):
    wanted = ["row_idx", "listing_id", "address_clean", "address_zipcode", "address_confidence", "address_method"]
    return file_run(spark, sf, "listings_addressed").select(*wanted)


@query
def results_file(spark, sf):
    return file_run(spark, sf, "valuation_results")


# Keys under which functions that share a name with an imported module or function are known.
for old, new in [
    ("address_usable_flag", "address_usable"),
    ("comparables_figures", "comparables"),
    ("valuation_results", "valuation"),
]:
    QUERIES[new] = QUERIES.pop(old)
