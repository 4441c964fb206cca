import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parvis.operators.comparables import comparables
from parvis.operators.market import derive_price_m2, sales_cells
from parvis.operators.range_quantiles import WaveletMatrix, band_ranks
from parvis.operators.running import band_sums, running_totals
from parvis.options import Options


@pytest.fixture(scope="module")
def sold():
    """One market with two thirds of all cells, ties of price and surface, and small markets."""
    rng = random.Random(6)
    rows = []
    for market, size in ((1, 1500), (2, 300), (3, 5), (4, 1)):
        for _ in range(size):
            surface = rng.choice([rng.uniform(10, 110), float(rng.randint(10, 20)), float("-inf")])
            rows.append((market, surface, rng.choice([rng.uniform(50, 90), float(rng.randint(60, 70))]), rng.randint(1, 3)))
    return rows


@pytest.fixture(scope="module")
def cells(spark, sold):
    return spark.createDataFrame(sold, "market int, surface double, price double, n long")


def bands(rng, count):
    """(market, ask, low, high): narrow, wide, empty and unbounded bands."""
    rows = []
    for i in range(count):
        low = rng.choice([rng.uniform(0, 110), float(rng.randint(10, 20)), float("-inf")])
        rows.append((rng.choice([1, 1, 1, 2, 3, 4, 9]), i, low, rng.choice([low, low + 3.0, low + 40.0, float("inf")])))
    return rows


def test_running_totals(spark, sold, cells):
    got = running_totals(cells, ["market"], ["price", "surface", "n"], ["n"]).collect()
    for market in (1, 2, 3, 4):
        own = sorted((p, s, n) for m, s, p, n in sold if m == market)
        want = np.cumsum([n for *_, n in own]).tolist()
        assert sorted(r.n for r in got if r.market == market) == want


def test_band_sums(spark, sold, cells):
    rows = bands(random.Random(1), 400)
    asks = spark.createDataFrame([*rows, (1, 1000, 5.0, 4.0), (2, 1001, None, 4.0)], "market int, ask int, low double, high double")
    got = {r.ask: (r.n, r.twice) for r in band_sums(cells.withColumn("twice", F.col("n") * 2), asks, ["market"], "surface", ["n", "twice"], ["ask"]).collect()}
    assert set(got) == {r[1] for r in rows}
    for market, ask, low, high in rows:
        n = sum(n for m, s, _, n in sold if m == market and low <= s <= high)
        assert got[ask] == (n, 2 * n)


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 64, 777):
        surface, price = rng.integers(0, 40, size).astype(float), rng.integers(0, 30, size).astype(float)
        weight = rng.integers(1, 4, size)
        matrix = WaveletMatrix(surface, price, weight)
        for low, high in ((0.0, 40.0), (5.0, 9.0), (float("-inf"), float("inf"))):
            inside = (surface >= low) & (surface <= high)
            full = np.sort(np.repeat(price[inside], weight[inside]))
            k = len(full)
            got = matrix.select(np.full(k, low), np.full(k, high), np.arange(k))
            assert got.tolist() == full.tolist()


@pytest.mark.parametrize("chunk_cells, asks_per_copy", [(65_536, 100_000), (40, 30), (1, 7)])
def test_band_ranks(spark, sold, cells, chunk_cells, asks_per_copy):
    full, rows = {}, []
    for market, ask, low, high in bands(random.Random(3), 250):
        full[ask] = sorted(p for m, s, p, n in sold if m == market and low <= s <= high for _ in range(n))
        k = len(full[ask])
        rows += [(market, ask, slot, low, high, rank) for slot, rank in enumerate({0, k // 3, (k - 1) // 2, k - 1}) if k]
    asks = spark.createDataFrame(rows, "market int, ask_id long, slot int, low double, high double, rank long")
    o = Options(chunk_cells=chunk_cells, asks_per_copy=asks_per_copy)
    got = {(r.ask_id, r.slot): r.price for r in band_ranks(cells, asks, ["market"], o).collect()}
    assert got == {(ask, slot): full[ask][rank] for _, ask, slot, _, _, rank in rows}


def test_equal_prices_have_no_spread(spark, make_sales):
    rows = [{"code_postal": 1, "type_local": "Appartement", "surface_reelle_bati": 20.0 + k / 7, "valeur_fonciere": 9123.4567 * (20.0 + k / 7)} for k in range(3)]
    rows = [{**r, "prix_m2": 9123.4567} for r in rows for _ in range(5)] + [{**rows[0], "surface_reelle_bati": 90.0, "prix_m2": 1e15}]
    cells = sales_cells(derive_price_m2(make_sales(rows)))
    asked = spark.createDataFrame([(1, "Appartement", 20.0)], "zipcode int, property_type string, surface_m2 double")
    row = comparables(asked, cells).first()
    assert (row.n_comparables, row.market_std_m2, row.market_median_m2) == (15, 0.0, 9123.4567)
    assert row.market_mean_m2 == pytest.approx(9123.4567, rel=1e-13)


def test_one_market_with_continuous_surfaces(spark):
    """Every request has its own band of thousands of sales; the price order is cut into several chunks."""
    size = 6000
    surface = (F.lit(10.0) + F.col("id") * (100.0 / size)).alias("surface")
    price = (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 3.0).alias("price")
    one = F.lit(1).cast("long")
    cells = spark.range(size).select(
        F.lit(1).alias("code_postal"), F.lit("A").alias("type_local"), surface, price, F.lit(2024).alias("year"), F.lit(True).alias("recent"),
        one.alias("n"), one.alias("dated"), F.lit(9).cast("long").alias("age"),
    )
    asked = spark.range(size).select(
        F.lit(1).alias("zipcode"), F.lit("A").alias("property_type"), (F.lit(12.0) + F.col("id") * (90.0 / size)).alias("surface_m2")
    )
    sold = np.array([(r.surface, r.price) for r in cells.select("surface", "price").collect()])
    got = comparables(asked, cells, Options(chunk_cells=256)).collect()
    assert len(got) == size
    for row in got[:: 50]:
        inside = sold[(sold[:, 0] >= row.surface_m2 * 0.7) & (sold[:, 0] <= row.surface_m2 * 1.3), 1]
        assert row.n_comparables == len(inside)
        assert [row.market_median_m2, row.market_mean_m2, row.market_std_m2] == pytest.approx([np.median(inside), inside.mean(), inside.std(ddof=1)], rel=1e-11)
