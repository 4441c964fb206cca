import datetime
import random

import pytest

from parvis.operators import market, sketches
from parvis.options import Options


@pytest.fixture(scope="module")
def sold(spark, make_sales):
    """One market with most of the sales, one with few, and rows that belong to none."""
    rng, day = random.Random(5), datetime.date(2024, 1, 1)
    sale = lambda i, zip_code, kind, price: {
        "id_mutation": str(i), "date_mutation": day, "code_postal": zip_code, "type_local": kind,
        "surface_reelle_bati": 50.0, "valeur_fonciere": price,
    }
    rows = [sale(i, 75001, "Appartement", rng.lognormvariate(13, 0.4)) for i in range(20_000)]
    rows += [sale(i, 75002, "Maison", 100_000.0 * (1 + i % 3)) for i in range(9)]
    rows += [sale(1, 75003, "Maison", None), sale(2, None, "Maison", 1.0), sale(3, 75003, None, 1.0)]
    rows += [sale(4, 75001, "Appartement", float("nan")), sale(5, 75004, "Maison", 400_000.0)]
    return market.derive_price_m2(make_sales(rows)).cache()


@pytest.mark.parametrize("parts", [1, 5])
def test_merged_deliveries_stay_within_the_bound(spark, sold, tmp_path, parts):
    stored = []
    for i, part in enumerate(sold.randomSplit([1.0] * parts, seed=3)):
        sketches.market_sketches(part).write.parquet(f"{tmp_path}/{i}")
        stored.append(spark.read.parquet(f"{tmp_path}/{i}"))
    quantiles = sketches.sketched_quantiles(sketches.merge_sketches(stored))
    assert {(r.code_postal, r.type_local): r.n for r in quantiles.collect()} == {
        (75001, "Appartement"): 20_000, (75002, "Maison"): 9, (75004, "Maison"): 1,
    }
    cells = market.sales_cells(sold.filter("not isnan(prix_m2)"))
    checked = {r.code_postal: r for r in sketches.rank_errors(quantiles, cells).collect()}
    assert set(checked) == {75001, 75002, 75004}
    for r in checked.values():
        assert max(r.error_q10, r.error_q50, r.error_q90) <= (0.01 if r.n > 100 else 0.0)
        assert r.q10 <= r.q50 <= r.q90
    assert checked[75002].q50 == 4_000.0
    assert checked[75004].q10 == checked[75004].q90 == 8_000.0


def test_rank_errors_see_a_wrong_quantile(spark, sold):
    wrong = spark.createDataFrame([(75002, "Maison", 1_000.0, 4_000.0, 9_000.0)], "code_postal int, type_local string, q10 double, q50 double, q90 double")
    row = sketches.rank_errors(wrong, market.sales_cells(sold)).first()
    assert (row.error_q10, row.error_q50) == (pytest.approx(0.1), 0.0) and row.error_q90 == pytest.approx(0.1)


def test_larger_sketches_are_closer(sold):
    errors = []
    for k in (16, 4000):
        quantiles = sketches.sketched_quantiles(sketches.market_sketches(sold, Options(sketch_k=k)))
        cells = market.sales_cells(sold.filter("not isnan(prix_m2) and code_postal = 75001"))
        row = sketches.rank_errors(quantiles, cells).first()
        errors.append(row.error_q10 + row.error_q50 + row.error_q90)
    assert errors[1] <= errors[0] and errors[1] < 0.006


def test_no_sales(sold):
    assert sketches.sketched_quantiles(sketches.merge_sketches([sketches.market_sketches(sold.limit(0))])).count() == 0
