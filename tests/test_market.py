import datetime
import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parvis.operators.comparables import PROBE, comparable_sales, comparables
from parvis.operators.market import derive_price_m2, market_quantiles, market_stats, market_trend, sales_cells
from parvis.operators.models import fit_forest, fit_quantiles, training_features
from parvis.operators.quantiles import grouped_quantiles, grouped_summary
from parvis.options import Options


@pytest.mark.parametrize("width", [0.01, 16.0, 1e6])
def test_quantiles_are_exact(spark, width):
    rng = random.Random(3)
    groups = {
        "one": [7.5],
        "two": [1.0, 2.0],
        "ties": [5.0] * 40 + [6.0] * 3,
        "spread": [rng.gauss(9000, 800) for _ in range(501)],
        "negative": [rng.uniform(-50, 50) for _ in range(100)],
    }
    rows = [(g, v, 1 + (i % 3)) for g, values in groups.items() for i, v in enumerate(values)] + [("spread", None, 4)]
    cells = spark.createDataFrame(rows, "g string, price double, n long")
    got = {r.g: r for r in grouped_quantiles(cells, ["g"], [0.1, 0.5, 0.9], ["a", "b", "c"], width).collect()}
    summary = {r.g: r for r in grouped_summary(cells, ["g"], width).collect()}
    assert set(got) == set(groups) == set(summary)
    for g in groups:
        full = [v for h, v, n in rows if h == g and v is not None for _ in range(n)]
        assert [got[g].a, got[g].b, got[g].c] == pytest.approx(list(np.quantile(full, [0.1, 0.5, 0.9])), rel=1e-12)
        assert got[g].n_values == len(full)
        assert summary[g].mean == pytest.approx(statistics.fmean(full), rel=1e-12)
        assert summary[g].median == pytest.approx(statistics.median(full), rel=1e-12)
        if len(full) > 1:
            # A bucket far wider than the spread of its values costs digits of the deviation.
            assert summary[g].std == pytest.approx(statistics.stdev(full), rel=1e-9 if width < 1000 else 1e-3)
        else:
            assert summary[g].std is None


def sale(zipcode, surface, m2, date="2024-06-01", kind="Appartement"):
    return {
        "code_postal": zipcode,
        "type_local": kind,
        "surface_reelle_bati": surface,
        "valeur_fonciere": None if m2 is None or surface is None else m2 * surface,
        "date_mutation": datetime.date.fromisoformat(date) if date else None,
    }


def ask(spark, make_sales, sales, probes, o=Options()):
    cells = sales_cells(derive_price_m2(make_sales(sales)), o)
    asked = spark.createDataFrame(probes, "zipcode int, property_type string, surface_m2 double")
    return {tuple(r[c] for c in PROBE): r for r in comparables(asked, cells, o).collect()}


def test_price_per_m2(make_sales):
    rows = [sale(1, 10.0, 5.0), sale(1, 0.0, 5.0), sale(1, None, 5.0), {**sale(1, 10.0, 5.0), "prix_m2": 9.0}]
    got = [r.prix_m2 for r in derive_price_m2(make_sales(rows)).collect()]
    assert got == [5.0, None, None, 9.0]


def test_tiers(spark, make_sales):
    old, new, first_day, day_before = "2022-03-01", "2024-03-01", "2023-06-30", "2023-06-29"
    sales = (
        [sale(1, 50.0, 100.0 + k, new) for k in range(5)]
        + [sale(1, 90.0, 500.0, old) for _ in range(3)]
        + [sale(2, 50.0, 100.0 + k, old) for k in range(5)] + [sale(2, 50.0, 900.0, new) for _ in range(4)]
        + [sale(3, 50.0, 10.0, new) for _ in range(4)] + [sale(3, 200.0, 30.0, new) for _ in range(2)]
        + [sale(4, 200.0, 7.0, old) for _ in range(4)]
        + [sale(5, 50.0, 1.0, first_day) for _ in range(4)] + [sale(5, 50.0, 2.0, day_before)]
        + [sale(6, 50.0, 1.0, first_day) for _ in range(5)] + [sale(6, 50.0, 2.0, day_before)]
        + [sale(7, 35.0, 1.0, new), sale(7, 65.0, 2.0, new), sale(7, 34.9, 3.0, new), sale(7, 65.1, 4.0, new)]
        + [sale(7, 50.0, 5.0, new) for _ in range(3)]
        + [sale(8, 50.0, 5.0, new, "Maison") for _ in range(9)]
        + [sale(9, None, 5.0, new) for _ in range(9)]
    )
    probes = [(z, "Appartement", 50.0) for z in range(1, 11)]
    got = {k[0]: r for k, r in ask(spark, make_sales, sales, probes).items()}
    assert {z: (r.tier, r.n_comparables) for z, r in got.items()} == {
        1: ("band+recent", 5), 2: ("band", 9), 3: ("pool+recent", 6), 4: ("pool", 4), 5: ("band", 5),
        6: ("band+recent", 5), 7: ("band+recent", 5), 8: ("pool", 0), 9: ("pool+recent", 9), 10: ("pool", 0),
    }
    assert got[1].market_median_m2 == 102.0 and got[2].market_median_m2 == 104.0
    assert got[3].market_median_m2 == 10.0 and got[3].market_mean_m2 == pytest.approx(100 / 6)
    assert (got[8].market_median_m2, got[8].market_mean_m2, got[8].market_std_m2, got[8].freshness_days) == (0, 0, 0, 999)
    assert got[9].n_comparables == 9 and got[9].market_median_m2 is None
    assert got[5].freshness_days == pytest.approx((4 * 550 + 551) / 5)


def test_single_sale_has_no_spread(spark, make_sales):
    got = ask(spark, make_sales, [sale(1, 50.0, 100.0)], [(1, "Appartement", 50.0)])
    row = got[(1, "Appartement", 50.0)]
    assert (row.n_comparables, row.market_std_m2, row.market_mean_m2) == (1, 0.0, 100.0)


def test_comparables_equal_brute_force(spark, make_sales):
    rng = random.Random(8)
    sales = [
        sale(
            rng.choice([1, 1, 1, 2, 3]),
            rng.choice([None, 0.0, 12.5, 20.0, 33.3, 40.0, 70.0, 150.0]),
            rng.choice([None, 100.0, rng.uniform(50, 150)]),
            rng.choice([None, "2022-01-05", "2023-02-01", "2023-06-30", "2024-05-01", "2024-12-31"]),
            rng.choice(["Appartement", "Appartement", "Maison"]),
        )
        for _ in range(600)
    ]
    probes = [(z, k, s) for z in (1, 2, 3, 4) for k in ("Appartement", "Maison") for s in (0.0, 15.0, 28.57, 50.0, 900.0)]
    got = ask(spark, make_sales, sales, probes, Options(bucket_width=7.0))
    o = Options()
    table = derive_price_m2(make_sales(sales))
    asked = spark.createDataFrame(probes, "zipcode int, property_type string, surface_m2 double")
    behind = Counter(tuple(r[c] for c in PROBE) for r in comparable_sales(asked, table, sales_cells(table, o), o).collect())
    assert behind == {key: row.n_comparables for key, row in got.items() if row.n_comparables}
    for z, k, s in probes:
        pool = [x for x in sales if x["code_postal"] == z and x["type_local"] == k]
        band = [x for x in pool if x["surface_reelle_bati"] is not None and s * 0.7 <= x["surface_reelle_bati"] <= s * 1.3]
        chosen = band if len(band) >= 5 else pool
        recent = [x for x in chosen if x["date_mutation"] and x["date_mutation"] >= datetime.date(2023, 6, 30)]
        chosen = recent if len(recent) >= 5 else chosen
        row = got[(z, k, s)]
        assert row.n_comparables == len(chosen)
        prices = [
            x["valeur_fonciere"] / x["surface_reelle_bati"]
            for x in chosen if x["valeur_fonciere"] is not None and x["surface_reelle_bati"]
        ]
        ages = [(datetime.date(2024, 12, 31) - x["date_mutation"]).days for x in chosen if x["date_mutation"]]
        if prices:
            assert row.market_median_m2 == pytest.approx(statistics.median(prices))
            assert row.market_mean_m2 == pytest.approx(statistics.fmean(prices))
        if len(prices) > 1:
            assert row.market_std_m2 == pytest.approx(statistics.stdev(prices), abs=1e-9)
        if ages:
            assert row.freshness_days == pytest.approx(statistics.fmean(ages))


def test_market_tables(make_sales):
    sales = (
        [sale(1, 10.0, m, "2023-05-01") for m in (100.0, 200.0, 300.0)]
        + [sale(1, 10.0, m, "2024-05-01") for m in (210.0, 231.0)]
        + [sale(2, 10.0, 50.0, "2024-05-01")]
        + [sale(None, 10.0, 1.0), {**sale(1, 10.0, 1.0), "type_local": None}]
    )
    cells = sales_cells(derive_price_m2(make_sales(sales)))
    stats = {r.code_postal: r for r in market_stats(cells).collect()}
    assert set(stats) == {1, 2}
    assert (stats[1].median, stats[1]["count"]) == (210.0, 5) and stats[2].std is None
    trend = {r.code_postal: r.trend_pct for r in market_trend(cells).collect()}
    assert trend == {1: 10.25, 2: 0.0}
    quantiles = {r.code_postal: (r.q10, r.q50, r.q90) for r in market_quantiles(cells).collect()}
    assert quantiles[1] == pytest.approx(tuple(np.quantile([100, 200, 210, 231, 300], [0.1, 0.5, 0.9])))


@pytest.fixture(scope="module")
def learned(make_sales):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        zipcode, surface = 75001 + rng.randrange(20), float(rng.randint(12, 120))
        m2 = 8000 + 300 * (zipcode - 75001) - 10 * surface + rng.gauss(0, 400)
        rows.append({**sale(zipcode, surface, m2, f"202{rng.randint(2, 4)}-05-01"), "nombre_pieces_principales": None})
    sales = derive_price_m2(make_sales(rows))
    return sales.filter("surface_reelle_bati % 5 <> 0"), sales.filter("surface_reelle_bati % 5 = 0")


def test_forest(spark, learned):
    train, held_out = learned
    model = fit_forest(train)
    asked = held_out.select(
        F.col("code_postal").alias("zipcode"), F.col("type_local").alias("property_type"),
        F.col("surface_reelle_bati").alias("surface_m2"),
    ).distinct()
    said = model.predict(asked)
    assert said.count() == asked.count()
    assert said.filter("low_m2 > predicted_m2_exact or predicted_m2_exact > high_m2").count() == 0
    joined = held_out.join(
        said.withColumnsRenamed(
            {"zipcode": "code_postal", "property_type": "type_local", "surface_m2": "surface_reelle_bati"}
        ),
        ["code_postal", "type_local", "surface_reelle_bati"],
    )
    middle = train.agg(F.median("prix_m2").alias("m")).first().m
    check = joined.agg(
        F.avg((F.col("prix_m2").between(F.col("low_m2"), F.col("high_m2"))).cast("int")).alias("inside"),
        F.avg(F.abs(F.col("prix_m2") - F.col("predicted_m2_exact"))).alias("mae"),
        F.avg(F.abs(F.col("prix_m2") - middle)).alias("naive"),
    ).first()
    assert 0.7 < check.inside < 0.93 and check.mae < 0.5 * check.naive
    row = model.metrics().first()
    assert row.model == "forest" and row.n_train == train.count() and 200 < row.mae_m2 < 450


def test_strategy(learned):
    train, _ = learned
    assert type(fit_quantiles(train.limit(200), "forest")).__name__ == "StatisticalModel"
    with pytest.raises(ValueError):
        fit_quantiles(train, "other")


def test_statistical_metrics(make_sales):
    rows = [sale(1, 10.0, m) for m in (100.0, 200.0, 400.0)]
    row = fit_quantiles(derive_price_m2(make_sales(rows))).metrics().first()
    assert row.mae_m2 == pytest.approx(100.0) and row.mape_pct == pytest.approx((1 + 0 + 0.5) / 3 * 100)


def test_features(make_sales):
    rows = [
        {**sale(75003, 42.0, 1.0), "nombre_pieces_principales": None},
        {**sale(75020, 34.9, 1.0, None, "Maison"), "nombre_pieces_principales": 7},
        {**sale(75020, 100.1, 1.0), "nombre_pieces_principales": None},
    ]
    got = training_features(derive_price_m2(make_sales(rows))).collect()
    assert [r.rooms for r in got] == [2.0, 7.0, 4.0]
    assert [r.year for r in got] == [2024, 2024, 2024]
    assert [(r.is_small, r.is_large, r.is_maison, r.arrond) for r in got] == [(0, 0, 0, 3), (1, 0, 1, 20), (0, 1, 0, 20)]
    assert got[0].log_surface == pytest.approx(math.log1p(42))
