"""Steps that must not be repeated, or not see each price, as sales grow."""

from pyspark.sql import functions as F

from parvis.operators import comparables, models
from parvis.operators.market import derive_price_m2, sales_cells
from parvis.operators.range_quantiles import _chunks
from parvis.options import Options


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_ordered_once(spark):
    cells = spark.range(100).selectExpr("1 as market", "id % 10 + 0.5d as surface", "id + 0.5d as price", "1L as n")
    placed = _chunks(cells, ["market"], 30)
    assert "Window" not in plan(placed) and "Exchange" not in plan(placed.filter("chunk > 0"))
    got = {(r.price, r.chunk) for r in placed.select("price", "chunk").collect()}
    assert got == {(i + 0.5, i // 30) for i in range(100)}


def test_bands_are_ordered_by_surface_not_by_price(spark, make_sales, monkeypatch):
    rows = [
        {"id_mutation": f"M{i}", "code_postal": 75001, "type_local": "Loft", "surface_reelle_bati": s, "prix_m2": 100.0 + i}
        for i, s in enumerate([20.0, 20.0, 20.0, 30.0, 30.0, None, float("nan")])
    ]
    sales = make_sales(rows).withColumn("prix_m2", F.lit(100.0) + F.substring("id_mutation", 2, 9).cast("double"))
    seen, real = [], comparables.band_sums
    monkeypatch.setattr(comparables, "band_sums", lambda table, *rest: seen.append(table) or real(table, *rest))
    asked = spark.createDataFrame([(75001, "Loft", 20.0), (75001, "Loft", 25.0)], "zipcode int, property_type string, surface_m2 double")
    got = comparables.choose_tier(asked, sales_cells(sales)).collect()
    assert {r.surface_m2: (r.n_band, r.n_pool) for r in got} == {20.0: (3, 7), 25.0: (5, 7)}
    assert {r.surface_m2: r.s1 for r in got} == {20.0: 721.0, 25.0: 510.0}
    assert sorted(r.n for r in seen[0].filter("surface is not null").collect()) == [2, 3]


def test_the_forest_reads_vectors_made_once(spark, make_sales, monkeypatch):
    rows = [
        {"id_mutation": f"M{i}", "code_postal": 75001, "type_local": "Maison", "surface_reelle_bati": 20.0 + i % 9, "valeur_fonciere": 1000.0 * (i + 1), "nombre_pieces_principales": 1}
        for i in range(60)
    ]
    read, real = [], models.RandomForestRegressor.fit
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, df: read.append(df) or real(self, df))
    model = models.fit_forest(derive_price_m2(make_sales(rows)), Options(n_trees=2, tree_depth=2))
    assert "UDF" not in plan(read[0]) and "VectorAssembler" not in plan(read[0])
    assert read[0].count() == 60 and model.metrics().first()["n_train"] == 60
