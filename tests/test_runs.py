import pytest

from checks import oracle
from checks.compare import connect, difference
from checks.queries import QUERIES
from parvis import fixed
from parvis.operators.evaluation import signal_accuracy
from parvis.plans import appraisal, model_store
from parvis.plans.appraisal import run, run_files
from parvis.plans.ingest import ingest
from parvis.sources import derived, schemas
from parvis.sources.tables import fingerprint, number_rows, read_listings, read_sales, rejects, write_table

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["valuation", "dedup_log", "comparables", "llm_merge", "market_stats", "signal_precision"])
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(FOLDER), name, FOLDER) == ""


def test_every_query_has_sql():
    assert set(oracle.FINAL) == set(QUERIES)


def test_run_is_repeatable_and_accurate(spark):
    listings, sales = derived.listings(spark, FOLDER), derived.sales(spark, FOLDER)
    first, second = run(listings, sales).results, run(listings, sales).results
    assert first.columns == fixed.RESULT_COLUMNS
    assert sorted(first.collect()) == sorted(second.collect())
    assert signal_accuracy(first).first().accuracy_pct >= 93.3


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_files(spark, tmp_path, file_format):
    ending = ".csv" if file_format == "csv" else ""
    listings, sales = derived.listings(spark, FOLDER), derived.sales(spark, FOLDER)
    raw, sold = f"{tmp_path}/raw{ending}", f"{tmp_path}/sold{ending}"
    write_table(listings, raw)
    write_table(sales, sold)
    run_files(spark, raw, sold, f"{tmp_path}/out", file_format=file_format, multi_line=True)
    want = sorted(run(listings, sales).results.collect(), key=lambda r: r.listing_id)

    def load(stage):
        path = f"{tmp_path}/out/{stage}{ending}"
        if file_format == "parquet":
            return spark.read.parquet(path)
        return spark.read.options(header=True, multiLine=True, escape='"').csv(path)

    got = load("valuation_results").collect()
    assert len(got) == len(want)
    texts = sorted((r.listing_id, r.report_full) for r in got)
    assert texts == [(r.listing_id, r.report_full) for r in want]
    assert load("dedup_log").count() > 0 and load("training_metrics").count() == 1
    assert {"listings_clean", "listings_addressed", "dedup_log"} <= {
        p.name.removesuffix(".csv") for p in (tmp_path / "out").iterdir()
    }


def test_ingest(spark, tmp_path):
    write_table(derived.listings(spark, FOLDER), f"{tmp_path}/raw")
    clean = ingest(spark, f"{tmp_path}/raw", f"{tmp_path}/clean", f"{tmp_path}/log")
    assert read_listings(spark, f"{tmp_path}/clean").count() == clean.count()


def test_dirty_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_text(
        "listing_id,raw_address,description,code_postal,surface_m2,asking_price,source,extra\n"
        'A,"1, ""rue"" X","two\nlines",75001.0,50,100000.0,PAP,e\n'
        "B,,,,NaN,,SeLoger,\n"
    )
    rows = number_rows(spark, f"{tmp_path}/l.csv", f"{tmp_path}/numbered", multi_line=True).orderBy("row_idx").collect()
    assert [(r.listing_id, r.raw_address, r.description) for r in rows] == [
        ("A", '1, "rue" X', "two\nlines"), ("B", None, None),
    ]
    assert [(r.code_postal, r.surface_m2, r.asking_price) for r in rows] == [(75001, 50.0, 100000), (None, None, None)]
    assert rows[0].extra == "e"
    (tmp_path / "s.csv").write_text(
        "date_mutation,valeur_fonciere,code_postal,type_local,surface_reelle_bati\n"
        "2024-02-30,1,75001,Maison,2\n2024-02-28,1,75001,Maison,\n"
    )
    sales = read_sales(spark, f"{tmp_path}/s.csv").collect()
    assert [str(r.date_mutation) for r in sales] == ["None", "2024-02-28"]
    with pytest.raises(ValueError):
        read_listings(spark, f"{tmp_path}/s.csv")


def test_limit(spark):
    listings, sales = derived.listings(spark, FOLDER), derived.sales(spark, FOLDER)
    capped = run(listings, sales, max_listings=40)
    assert capped.addressed.count() == 40
    full = run(listings, sales)
    ids = {r.listing_id for r in full.clean.orderBy("row_idx").limit(40).collect()}
    assert {r.listing_id for r in capped.results.collect()} == {
        r.listing_id for r in full.results.collect() if r.listing_id in ids
    }


@pytest.mark.parametrize("ending", ["", ".csv"])
def test_numbers_do_not_depend_on_splits(spark, tmp_path, ending):
    path = f"{tmp_path}/many{ending}"
    rows = derived.listings(spark, FOLDER).drop("row_idx")
    rows.unionAll(rows).unionAll(rows).repartition(3).write.format("csv" if ending else "parquet").options(header=True).save(path)
    setting, found = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(setting)
    for size in ("700", "9000", "128m"):
        spark.conf.set(setting, size)
        numbered = number_rows(spark, path, f"{tmp_path}/numbered-{size}")
        found.append({r.row_idx: r.listing_id for r in numbered.collect()})
    spark.conf.set(setting, before)
    assert sorted(found[0]) == list(range(3 * rows.count()))
    assert found[0] == found[1] == found[2]


def test_rejects(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "date_mutation,valeur_fonciere,code_postal,type_local,surface_reelle_bati\n"
        "2024-02-30,1,75001,Maison,2\n2024-02-28,NaN,75001,Maison,\n2024-02-28,x,7500l,Maison,3\n"
    )
    got = rejects(spark, f"{tmp_path}/s.csv", schemas.SALES).orderBy("reasons").collect()
    assert [r.reasons for r in got] == [
        "code_postal is no int: 7500l; valeur_fonciere is no double: x", "date_mutation is no date: 2024-02-30",
    ]
    assert all(r.file.endswith("s.csv") and '"type_local":"Maison"' in r.record for r in got)


def test_a_failed_run_goes_on_at_its_first_missing_stage(spark, tmp_path, monkeypatch):
    raw, sold, out = f"{tmp_path}/raw", f"{tmp_path}/sold", f"{tmp_path}/out"
    write_table(derived.listings(spark, FOLDER), raw)
    write_table(derived.sales(spark, FOLDER), sold)
    made, write = [], appraisal.write_table

    def counting(df, path):
        made.append(path.rsplit("/", 1)[-1])
        write(df, path)

    def failing(df, path):
        if path.endswith("listings_addressed"):
            raise OSError("the cluster is gone")
        counting(df, path)

    monkeypatch.setattr(appraisal, "write_table", failing)
    with pytest.raises(OSError):
        run_files(spark, raw, sold, out)
    assert made == ["rejects", "removals", "dedup_log", "listings_clean"]
    made.clear()
    monkeypatch.setattr(appraisal, "write_table", counting)
    first = sorted(run_files(spark, raw, sold, out).collect())
    assert made == ["listings_addressed", "training_metrics", "valuation_results"]
    made.clear()
    assert sorted(run_files(spark, raw, sold, out).collect()) == first and made == []
    # Other options, or another input, make every stage anew.
    run_files(spark, raw, sold, out, max_listings=5)
    assert len(made) == 7
    before = fingerprint(spark, raw, sold)
    write_table(derived.sales(spark, FOLDER).limit(300), sold)
    assert fingerprint(spark, raw, sold) != before


@pytest.mark.parametrize("method", ["statistical", "forest"])
def test_stored_models(spark, tmp_path, method):
    sales = derived.sales(spark, FOLDER)
    cells, model = appraisal.fit_market(sales, method=method)
    path = f"{tmp_path}/model"
    with pytest.raises(model_store.ModelNotTrained):
        model_store.load_model(spark, path)
    model_store.save_model(model, path)
    loaded = model_store.load_model(spark, path)
    assert loaded.metrics().collect() == model.metrics().collect()
    asked = run(derived.listings(spark, FOLDER), sales).addressed.limit(60)
    valued = [sorted(map(repr, appraisal.appraise(asked, cells, m).select("listing_id", "fair_value", "ci_low", "ci_high").collect())) for m in (model, loaded)]
    assert valued[0] == valued[1] and len(valued[0]) > 30
    spark.createDataFrame([(99, "forest", "2024-06-01")], "format int, kind string, scoring_date string").write.mode("overwrite").parquet(f"{path}/manifest")
    with pytest.raises(model_store.ModelNotTrained):
        model_store.load_model(spark, path)
