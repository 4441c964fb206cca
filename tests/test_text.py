import pytest
from pyspark.sql import functions as F

from parvis.functions import text
from parvis.operators.addresses import enrich_addresses, with_market


def evaluate(spark, fn, rows, n_args):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"a{k} string" for k in range(n_args))
    )
    out = df.select("i", fn(*[F.col(f"a{k}") for k in range(n_args)]).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


def test_normalize_address(spark):
    cases = {
        None: "",
        "": "",
        "   ": "",
        "12, Bd. Voltaire!": "12 boulevard voltaire",
        "3 AV  Foch ; Paris": "3 avenue foch paris",
        "pl st imp vla che crs pas": "place saint impasse villa chemin cours passage",
        "bdx abd bd-bd": "bdx abd boulevard-boulevard",
        " 7 ALLÉE des Érables ": "7 allée des érables",
        "avé av": "avé avenue",
    }
    got = evaluate(spark, text.normalize_address, [(k,) for k in cases], 1)
    assert got == list(cases.values())


def test_similarity(spark):
    pairs = [("abc", "abc"), ("abcd", "abcx"), ("", "a"), (None, "a"), ("kitten", "sitting"), ("allée", "allee"), ("", "")]
    got = evaluate(spark, text.address_similarity, pairs, 2)
    assert got == pytest.approx([1.0, 0.75, 0.0, 0.0, 1 - 3 / 7, 0.8, 0.0])
    assert evaluate(spark, text.address_similarity, [(b, a) for a, b in pairs], 2) == got


CASES = [
    # raw address, description, zip -> address, zip, confidence, method
    ("12 rue de Lappe", "x", 75011, "12 rue de Lappe", 75011, 0.95, "existing"),
    ("  9 rue X 75003 ", None, 75011, "9 rue X 75003", 75003, 0.95, "existing"),
    (" 12345678 ", "Au 5 rue Monge", 75005, "5 rue Monge, Paris 75005", 75005, 0.75, "regex"),
    (None, "Studio, 12 rue des Martyrs, 75009 Paris", 75018, "12 rue des Martyrs, Paris 75009", 75009, 0.75, "regex"),
    (None, "12bis", 69001, "", None, 0.0, "unknown"),
    (None, "7b, ALLÉE des Cygnes. 15ème", 75001, "7b ALLÉE des Cygnes, Paris 75015", 75015, 0.75, "regex"),
    (None, "8 rue Foo, Paris 33eme", 75001, "8 rue Foo, Paris None", None, 0.75, "regex"),
    (None, "8 rue Foo", None, "8 rue Foo, Paris None", None, 0.75, "regex"),
    (None, "Bel appartement 75116", 75002, "Paris 75116", 75116, 0.35, "zipcode_only"),
    (None, "Dans le 3ème arrondissement", 75002, "Paris 75003", 75003, 0.35, "zipcode_only"),
    (None, "au 5eme étage", 75002, "Paris 75005", 75005, 0.35, "zipcode_only"),
    (None, "au 33eme étage", 75002, "", None, 0.0, "unknown"),
    (None, "charmant", 75002, "Paris 75002", 75002, 0.35, "zipcode_only"),
    (None, "charmant", 92100, "", None, 0.0, "unknown"),
    (None, None, None, "", None, 0.0, "unknown"),
    ("", "code 175009 non", None, "", None, 0.0, "unknown"),
]


def test_extract_address(make_listings):
    rows = [{"raw_address": r, "description": d, "code_postal": z} for r, d, z, *_ in CASES]
    got = enrich_addresses(make_listings(rows)).orderBy("row_idx").collect()
    found = [(g.address_clean, g.address_zipcode, g.address_confidence, g.address_method) for g in got]
    assert found == [c[3:] for c in CASES]


def test_extract_column_equals_stage(make_listings):
    rows = [{"raw_address": r, "description": d, "code_postal": z} for r, d, z, *_ in CASES]
    one = text.extract_address(F.col("raw_address"), F.col("description"), F.col("code_postal"))
    got = make_listings(rows).select("row_idx", one.alias("a")).orderBy("row_idx").collect()
    assert [tuple(g.a) for g in got] == [c[3:] for c in CASES]


def test_market_of_a_listing(spark):
    rows = [(75003, 75011, "maison"), (0, 75011, "Loft"), (None, 75004, None), (None, None, " MAISON "), (69001, 75002, None), (7500, 1, None)]
    df = spark.createDataFrame(
        [(i, "a", *r) for i, r in enumerate(rows)],
        "row_idx long, address_clean string, address_zipcode int, code_postal int, property_type string",
    )
    got = with_market(df).orderBy("row_idx").collect()
    assert [g.zipcode for g in got] == [75003, 75011, 75004, 75011, 75002, 7500]
    assert [g.property_type for g in got] == ["Maison", "Appartement", "Appartement", "Maison", "Appartement", "Appartement"]


def test_usable(spark):
    df = spark.createDataFrame([(75001, 0.35), (75001, 0.3), (None, 0.95), (75001, 0.29)], "z int, c double")
    got = df.select(text.address_usable(F.col("z"), F.col("c")).alias("u")).collect()
    assert [g.u for g in got] == [True, True, False, False]
