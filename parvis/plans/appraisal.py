"""The whole work: raw listings and sales in, valued and described listings out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.memo import memo_text
from ..operators.addresses import enrich_addresses, with_market
from ..operators.evaluation import first_n_listings
from ..operators.market import derive_price_m2, sales_cells
from ..operators.models import ForestModel, StatisticalModel, fit_quantiles
from ..operators.valuation import results, value, write_memos
from ..options import DEFAULTS, Options
from ..session import cut_lineage
from ..sources import schemas
from ..sources.tables import (
    fingerprint,
    read_answers,
    read_listings,
    read_removals,
    read_sales,
    read_table,
    rejects,
    write_table,
)
from .ingest import deduplicate, removals, without_removed


def fit_market(
    sales: DataFrame, o: Options = DEFAULTS, method: str = "statistical", training: DataFrame | None = None
) -> tuple[DataFrame, StatisticalModel | ForestModel]:
    """The counted cells of ``sales``, which serve as comparables, and the price model.

    ``training`` are the sales the model learns from, by default ``sales``.
    """
    sales = derive_price_m2(sales)
    cells = cut_lineage(sales_cells(sales, o))
    if training is None:
        return cells, fit_quantiles(sales, method, o, cells)
    return cells, fit_quantiles(derive_price_m2(training), method, o)


def appraise(
    addressed: DataFrame,
    cells: DataFrame,
    model: StatisticalModel | ForestModel,
    o: Options = DEFAULTS,
    answers: DataFrame | None = None,
) -> DataFrame:
    """Valued listings with memo sections, from listings with recovered addresses."""
    return write_memos(value(with_market(addressed, o), cells, model, o), answers, o)


@dataclass(frozen=True)
class Run:
    """The tables of one run. Removals and request figures exist already, the rest is lazy."""

    clean: DataFrame
    log: DataFrame
    addressed: DataFrame
    valued: DataFrame
    results: DataFrame
    metrics: DataFrame
    """Training errors, the number of training sales and the name of the model that was fitted."""


def run(
    listings: DataFrame,
    sales: DataFrame,
    o: Options = DEFAULTS,
    method: str = "statistical",
    max_listings: int | None = None,
    address_answers: DataFrame | None = None,
    memo_answers: DataFrame | None = None,
    training: DataFrame | None = None,
) -> Run:
    """Deduplicate, recover addresses, match sales, value and describe."""
    clean, log = deduplicate(listings, o)
    addressed = enrich_addresses(first_n_listings(clean, max_listings), address_answers)
    cells, model = fit_market(sales, o, method, training)
    valued = appraise(addressed, cells, model, o, memo_answers)
    return Run(clean, log, addressed, valued.withColumn("report_full", memo_text()), results(valued), model.metrics())


class Stages:
    """The stages of a run below one folder. A stage counts as done once its mark is written.

    The mark holds the key of the run: options, arguments and the fingerprint of the inputs. A
    run with the same key goes on at the first stage without a mark; with another key all
    stages are made anew.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.folder, self.key = spark, folder, key

    def _is_done(self, stage: str) -> bool:
        try:
            mark = self.spark.read.schema("key string").parquet(f"{self.folder}/stages/{stage}").first()
        except AnalysisException:
            return False
        return mark is not None and mark["key"] == self.key

    def make(self, stage: str, path: str, table: Callable[[], DataFrame]) -> None:
        """Write ``table()`` to ``path`` and mark the stage, unless it is done."""
        if self._is_done(stage):
            return
        write_table(table(), path)
        mark = self.spark.createDataFrame([(self.key,)], "key string").coalesce(1)
        mark.write.mode("overwrite").parquet(f"{self.folder}/stages/{stage}")


def run_files(
    spark: SparkSession,
    listings_path: str,
    sales_path: str,
    output_dir: str,
    o: Options = DEFAULTS,
    method: str = "statistical",
    max_listings: int | None = None,
    file_format: str = "parquet",
    address_answers_path: str | None = None,
    memo_answers_path: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Run on stored tables and write every stage below ``output_dir``; returns the results.

    Each stage is read back from its file, so a lost executor never repeats an earlier one, and
    a run that failed goes on at its first missing stage (``Stages``). Fields that cannot be read
    are listed in the stage ``rejects``. ``multi_line`` concerns CSV whose texts hold line breaks.
    """
    ending = ".csv" if file_format == "csv" else ""
    inputs = [p for p in (listings_path, sales_path, address_answers_path, memo_answers_path) if p]
    stages = Stages(
        spark, output_dir, repr((o, method, max_listings, file_format, multi_line, inputs, fingerprint(spark, *inputs)))
    )

    def path(stage: str) -> str:
        return f"{output_dir}/{stage}{ending}"

    def answers(stored: str | None) -> DataFrame | None:
        return read_answers(spark, stored, multi_line) if stored else None

    def unread() -> DataFrame:
        found = rejects(spark, listings_path, schemas.LISTINGS, multi_line)
        return found.unionByName(rejects(spark, sales_path, schemas.SALES))

    def clean() -> DataFrame:
        removed = read_removals(spark, path("removals"))
        return without_removed(read_listings(spark, listings_path, multi_line), removed)

    def addressed() -> DataFrame:
        rows = first_n_listings(read_listings(spark, path("listings_clean"), multi_line), max_listings)
        return enrich_addresses(rows, answers(address_answers_path))

    fitted = []

    def market() -> tuple[DataFrame, StatisticalModel | ForestModel]:
        if not fitted:
            fitted.extend(fit_market(read_sales(spark, sales_path), o, method))
        return tuple(fitted)

    def valued() -> DataFrame:
        rows = read_listings(spark, path("listings_addressed"), multi_line).withColumns(
            {
                "address_zipcode": F.col("address_zipcode").try_cast("int"),
                "address_confidence": F.col("address_confidence").try_cast("double"),
            }
        )
        return results(appraise(rows, *market(), o, answers(memo_answers_path)))

    stages.make("rejects", path("rejects"), unread)
    stages.make("removals", path("removals"), lambda: removals(read_listings(spark, listings_path, multi_line), o))
    stages.make("dedup_log", path("dedup_log"), lambda: read_removals(spark, path("removals")).select(*schemas.DEDUP_LOG.fieldNames()))
    stages.make("listings_clean", path("listings_clean"), clean)
    stages.make("listings_addressed", path("listings_addressed"), addressed)
    stages.make("training_metrics", path("training_metrics"), lambda: market()[1].metrics())
    stages.make("valuation_results", path("valuation_results"), valued)
    return read_table(spark, path("valuation_results"), schemas.RESULTS)
