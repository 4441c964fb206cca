import json

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.queries import QUERIES
from parvis import fixed
from parvis.functions import memo, scoring
from parvis.functions.answers import parse_address_answer, parse_memo_answer
from parvis.operators import evaluation
from parvis.operators.addresses import address_prompts, attach_answers, enrich_addresses, missing_addresses
from parvis.operators.models import StatisticalModel
from parvis.operators.valuation import label, memo_prompts, results, write_memos
from parvis.options import DEFAULTS, Options


def columns(spark, rows, schema, **made):
    df = spark.createDataFrame(rows, schema)
    return df.select(*[c.alias(n) for n, c in made.items()]).collect()


def test_labels_at_the_thresholds(spark):
    gaps = [-15.001, -15.0, -8.001, -8.0, 0.0, 10.0, 10.001, 20.0, 20.001, None]
    got = columns(
        spark, [(g,) for g in gaps], "g double",
        s=scoring.signal(F.col("g"), DEFAULTS), t=scoring.signal_strength(F.col("g"), DEFAULTS),
    )
    assert [(r.s, r.t) for r in got] == [
        ("undervalued", "strong"), ("undervalued", "moderate"), ("undervalued", "moderate"), ("fair", "weak"),
        ("fair", "weak"), ("fair", "weak"), ("overvalued", "moderate"), ("overvalued", "moderate"),
        ("overvalued", "strong"), (None, None),
    ]


def test_money_is_cut_towards_zero(spark):
    rows = [(1999.9, 1.0), (-1999.9, 1.0), (-999.0, 1.0), (10500.0, 62.0)]
    got = columns(spark, rows, "p double, s double", v=scoring.whole_thousands(F.col("p"), F.col("s")))
    assert [r.v for r in got] == [1000, -1000, 0, 651000]


def test_gap_of_a_worthless_listing(spark):
    got = columns(spark, [(500, 0), (90, 100)], "a long, f long", v=scoring.price_gap(F.col("a"), F.col("f")))
    assert [r.v for r in got] == [50000.0, -10.0]


def test_confidence(spark):
    nan = float("nan")
    rows = [
        (20, 0.0, 0.0, 9000.0), (40, 0.0, 0.0, 9000.0), (10, 73.0, 900.0, 9000.0), (0, 999.0, 0.0, 0.0),
        (20, None, None, None), (20, nan, nan, 9000.0), (5, 400.0, 9000.0, 9000.0),
    ]
    got = columns(
        spark, rows, "n long, f double, s double, m double",
        v=scoring.confidence_score(F.col("n"), F.col("f"), F.col("s"), F.col("m")),
    )
    assert [r.v for r in got] == [1.0, 1.0, 0.62, 0.2, 0.4, 0.4, 0.1]


def test_fallback_without_training_sales(spark):
    cells = spark.createDataFrame(
        [(75001, "Appartement", 100.0, 1)], "code_postal int, type_local string, price double, n long"
    )
    asked = spark.createDataFrame(
        [(75001, "Appartement", 9.0, 5.0), (75002, "Appartement", 200.0, 10.0), (75003, "Appartement", 200.0, 0.0)],
        "zipcode int, property_type string, market_median_m2 double, market_std_m2 double",
    )
    got = {r.zipcode: r for r in StatisticalModel(cells).predict(asked).collect()}
    assert (got[75001].predicted_m2_exact, got[75001].low_m2, got[75001].high_m2) == (100.0, 100.0, 100.0)
    assert (got[75002].low_m2, got[75002].high_m2) == pytest.approx((187.2, 212.8))
    assert (got[75003].low_m2, got[75003].high_m2) == pytest.approx((200 - 1.28 * 24, 200 + 1.28 * 24))


def valued(spark, rows):
    schema = (
        "row_idx long, listing_id string, asking_price long, fair_value long, confidence_score double, "
        "surface_m2 double, zipcode int, ci_low long, ci_high long, n_comparables long, freshness_days_exact double, "
        "market_median_m2 double, trend_pct double, predicted_m2_exact double, address string, property_type string, "
        "pricing_bias string"
    )
    full = [
        (i, f"L{i}", ask, fair, score, 75.0, 75011, 900000, 1100000, 12, 200.5, 10000.5, -0.25, 9999.5, "1 rue A",
         "Appartement", bias)
        for i, (ask, fair, score, bias) in enumerate(rows)
    ]
    return label(spark.createDataFrame(full, schema))


def test_memo_branches(spark):
    rows = [(850000, 1000000, 0.51, "under"), (850000, 1000000, 0.5, "under"), (1250000, 1000000, 0.6, "over"),
            (1000000, 1000000, 0.61, "fair")]
    got = write_memos(valued(spark, rows)).withColumn("text", memo.memo_text()).orderBy("row_idx").collect()
    assert [r.recommendation.split(" ")[0] for r in got] == ["MONITOR", "NEUTRAL", "PASS", "NEUTRAL"]
    assert "15.0% below" in got[0].executive_summary and "25.0% above" in got[2].executive_summary
    assert "fairly priced" in got[3].executive_summary and "75.0m²" in got[3].executive_summary
    assert got[2].executive_summary.endswith("Handle with caution.")
    assert "1,250,000€" in got[2].valuation_section and "+25.0%" in got[2].valuation_section
    assert "10,000 €/m²" in got[0].market_context and "-0.2%" in got[0].market_context
    assert ["adequate" in r.risk_factors for r in got] == [False, False, False, True]
    assert "200 days" in got[0].risk_factors and "0.51/1.00" in got[0].data_note
    assert got[0].text.startswith("INVESTMENT MEMO — L0\n" + "=" * 50 + "\n\nEXECUTIVE SUMMARY\n")
    assert got[0].text.endswith("[Generated by: template]")


def test_memo_json_has_eight_keys(spark):
    row = write_memos(valued(spark, [(1, 1, 0.5, None)])).select(memo.memo_json().alias("j")).first()
    assert list(json.loads(row.j)) == [
        "listing_id", "executive_summary", "valuation", "market_context", "risk_factors", "recommendation",
        "data_note", "generated_by",
    ]


def test_memo_answers(spark):
    five = {"executive_summary": "E", "valuation_section": "V", "market_context": "M", "risk_factors": "R", "recommendation": "B"}
    four = {k: v for k, v in five.items() if k != "risk_factors"}
    texts = ["```json\n" + json.dumps(five) + "\n```", json.dumps(four), "no json", None, json.dumps({**five, "x": 1})]
    answers = spark.createDataFrame([(f"L{i}", t) for i, t in enumerate(texts)], "listing_id string, response_text string")
    rows = [(1000000, 1000000, 0.71 if i == 0 else 0.5, "fair") for i in range(6)]
    got = write_memos(valued(spark, rows), answers).orderBy("row_idx").collect()
    written = [r.generated_by.startswith("llm:") for r in got]
    assert written == [True, False, False, False, True, False]
    assert got[0].executive_summary == "E" and got[0].data_note.endswith("High confidence.")
    assert got[4].data_note.endswith("use with caution.") and got[1].data_note.startswith("Written from a template.")
    assert len(got) == 6


def test_memo_prompt(spark):
    prompt = memo_prompts(valued(spark, [(750000, 1000000, 0.5, None)])).first().prompt
    assert "750,000€ (10000 €/m²)" in prompt and "-25.0%" in prompt and "executive_summary" in prompt


def test_address_answers(spark):
    cases = [
        ('```json\n{"address": "1 rue A", "zipcode": 75004}\n```', ("1 rue A", 75004, 0.65, "llm")),
        ('{"address": "1 rue A"}', ("1 rue A", 75001, 0.65, "llm")),
        ('{"address": "1 rue A", "zipcode": null}', ("1 rue A", None, 0.65, "llm")),
        ('{"address": "1 rue A", "zipcode": "75006"}', ("1 rue A", 75006, 0.65, "llm")),
        ('{"address": null}', None),
        ('{"address": ""}', None),
        ("[1, 2]", None),
        ("sorry", None),
        ("", None),
        (None, None),
    ]
    got = columns(
        spark, [(c[0],) for c in cases], "t string", v=parse_address_answer(F.col("t"), F.lit(75001))
    )
    assert [r.v and tuple(r.v) for r in got] == [c[1] for c in cases]


def test_answers_only_fill_gaps(spark, make_listings):
    listings = make_listings(
        [{"description": "rien"}, {"description": "au 5eme"}, {"raw_address": "12 rue de Lappe"}, {"description": "x" * 600}]
    )
    answers = spark.createDataFrame(
        [(f"L{i}", '{"address": "3 rue B", "zipcode": 75009}') for i in range(3)], "listing_id string, response_text string"
    )
    got = enrich_addresses(listings, answers).orderBy("row_idx").collect()
    assert [r.address_method for r in got] == ["llm", "zipcode_only", "existing", "unknown"]
    assert got[0].address_zipcode == 75009 and "response_text" not in got[0].asDict()
    whole = address_prompts(enrich_addresses(listings)).orderBy("listing_id").collect()
    assert whole[1].prompt.endswith("x" * 600)
    prompts = address_prompts(enrich_addresses(listings), Options(prompt_chars=500)).orderBy("listing_id").collect()
    assert [p.listing_id for p in prompts] == ["L0", "L3"]
    assert prompts[1].prompt.endswith("x" * 500) and "x" * 501 not in prompts[1].prompt


def test_evaluation(spark):
    rows = [("undervalued", "under", 0.5, 0), ("undervalued", "fair", 0.9, 1), ("overvalued", "over", 0.4, 2),
            ("fair", "over", 0.7, 3), ("fair", "fair", 0.7, 4), ("fair", None, 0.1, 5), ("fair", "odd", 0.2, 6)]
    df = spark.createDataFrame(rows, "signal string, pricing_bias_gt string, confidence_score double, row_idx long")
    df = df.withColumn("listing_id", F.concat(F.lit("L"), "row_idx"))
    row = evaluation.signal_accuracy(df).first()
    assert (row.correct, row.total, row.accuracy_pct) == (3, 5, 60.0)
    matrix = {r.signal_gt: (r.undervalued, r.overvalued, r.fair) for r in evaluation.confusion_matrix(df).collect()}
    assert matrix == {"undervalued": (1, 0, 0), "fair": (1, 0, 1), "overvalued": (0, 1, 1)}
    per = {r.label: (r.precision, r.recall) for r in evaluation.signal_precision(df).collect()}
    assert per == {"undervalued": (0.5, 1.0), "overvalued": (1.0, 0.5), "fair": (0.5, 0.5)}
    top = evaluation.top_memo_per_signal(df, 3).collect()
    assert [(r.signal, r.listing_id) for r in top] == [("undervalued", "L1"), ("overvalued", "L2"), ("fair", "L3")]
    assert [r.signal for r in evaluation.top_memo_per_signal(df.filter("signal = 'fair'"), 2).collect()] == ["fair"]
    empty = evaluation.signal_accuracy(df.limit(0)).first()
    assert (empty.correct, empty.total, empty.accuracy_pct) == (0, 0, None)


def test_results_columns(spark):
    table = results(write_memos(valued(spark, [(1000000, 1000000, 0.5, "fair")])).withColumn("x", F.lit(1)))
    assert table.columns == fixed.RESULT_COLUMNS
    row = table.first()
    assert (row.predicted_m2, row.market_m2, row.freshness_days) == (10000.0, 10000.0, 200.0)


def test_missing_addresses(make_listings):
    rows = [{"raw_address": a} for a in ("", None, "  ", "1 rue A")]
    assert missing_addresses(make_listings(rows)).first().missing == 3


def test_incomplete_memo_answer_is_null(spark):
    got = columns(spark, [("{}",), (None,)], "t string", v=parse_memo_answer(F.col("t")))
    assert [r.v for r in got] == [None, None]


def test_later_answers_win_and_repeats_fail(spark, make_listings):
    listings = make_listings([{"description": "rien"}])
    rows = [("L0", '{"address": "1 rue A"}', 1, "first"), ("L0", '{"address": "2 rue B"}', 2, "second")]
    answers = spark.createDataFrame(rows, "listing_id string, response_text string, answered_at int, model string")
    assert enrich_addresses(listings, answers).first().address_clean == "2 rue B"
    got = attach_answers(listings, answers).first()
    assert (got.response_text, got.answered_by) == (rows[1][1], "second")
    with pytest.raises(Exception, match="several answers"):
        enrich_addresses(listings, answers.drop("answered_at")).collect()


def test_listings_that_share_an_id_get_their_own_answers(spark, tmp_path):
    """From 1,000,000 parts on, the listing ids of the derived table repeat."""
    parts = [(k, "hot ring", "Brand#1", 3) for k in (100000, 1000000, 1000001, 1000004)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    rows = QUERIES["llm_address_parse"](spark, str(tmp_path)).collect()
    assert len(rows) == queries.unplaced(spark, str(tmp_path)).count() > len({r.listing_id for r in rows})
    answers = queries.address_answers(spark, str(tmp_path))
    told = {r.row_idx: r.response_text for r in answers.collect()}
    assert "1 rue Dupont" in told[100000] and told[1000001] == '{"address": null}'
    assert told[1000004].strip() == '{"address": "quai UPF100000", "zipcode": null}'
    assert QUERIES["llm_merge"](spark, str(tmp_path)).count() == len(rows)
