from parvis.llm import quality


def none_rejected():
    return {r: [0] * len(grid) for r, grid in quality.GRID.items()}


def test_rules_share_one_error():
    # 475 labels among four strata: not enough for a fifth of the error for each rule, enough for one sequence.
    assert quality.strictest_valid([0], 475, 0.01, 0.05 / 20) is None
    got = quality.valid_cutoffs(none_rejected(), 475, 0.01, 0.05 / 4)
    assert got == {r: len(grid) - 1 for r, grid in quality.GRID.items()}
    assert quality.valid_cutoffs(none_rejected(), 307, 0.01, 0.05 / 4) == {}
    assert quality.valid_cutoffs(none_rejected(), 0, 0.01, 0.05 / 4) == {}


def test_sequence_ends_at_the_first_failure():
    counts = none_rejected()
    counts["duplicate_lines"][2] = 9
    got = quality.valid_cutoffs(counts, 475, 0.01, 0.05 / 4)
    assert got == {"symbols_per_word": 2, "marks_per_word": 2, "duplicate_lines": 1, "repeated_words": 1, "top_word": 1}


def test_other_rules_go_on_alone_with_many_labels():
    counts = none_rejected()
    counts["duplicate_lines"][0] = 900
    got = quality.valid_cutoffs(counts, 2000, 0.01, 0.05 / 4)
    assert "duplicate_lines" not in got
    assert all(got[r] == len(counts[r]) - 1 for r in counts if r != "duplicate_lines")


def test_labelled_texts_are_not_shuffled(spark, monkeypatch):
    """Check of the pipeline, round 3: the join of labels to documents shuffled every text."""
    texts = [f"word{i} " * (i % 7) + "one two three" for i in range(60)]
    docs = spark.createDataFrame([(i if i % 10 else None, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 0 if i % 3 else None) for i in [*range(0, 80, 2), 4]] + [(None, 1)], "doc_id long, quality int")
    plans = []
    plain = quality.measure
    monkeypatch.setattr(quality, "measure", lambda rows, *keep: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or plain(rows, *keep))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = quality.measure_labelled(docs, labels).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange hashpartitioning" not in plans[0]
    wanted = [i for i in range(60) if i % 10 and i % 2 == 0 and i % 3]
    assert sorted((r.doc_id, r.n_words) for r in got) == [(i, len(texts[i].split())) for i in wanted]
