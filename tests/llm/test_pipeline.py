from collections import Counter

import corpus_pipeline
from parvis.llm import quality
from parvis.llm.queries import QUERIES

from .test_dedup import line_oracle, sha
from .test_filters import contaminated_oracle
from .test_near_copies import keepers_oracle

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.dtypes, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert docs.dtypes == columns
        kept[name] = before, [(r["doc_id"], r["text"]) for r in docs.collect()]
    before, after = kept["quality rules"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = quality.judge(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)
    assert {d for d, _ in after} == {r["doc_id"] for r in judged.filter("kept").collect()}
    before, after = kept["line dedup"]
    assert Counter((d, h) for d, _, _, h in line_oracle(before, 40, 5)) == Counter((d, sha(t)) for d, t in after)
    before, after = kept["SimHash near-dedup"]
    assert Counter(d for d, _ in after) == keepers_oracle(before)
    before, after = kept["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {d for d, _ in contaminated_oracle(before, items)}
    assert sorted(after) == sorted((d, t) for d, t in before if d not in dirty)


def test_run_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    ids = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in rows} <= ids


def test_queries_cover_their_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    for name, n in (("op2_warc_zip", pages), ("op4_url_filter", pages), ("op6_sharding", docs), ("op10_toxicity", docs)):
        assert QUERIES[name](spark, FOLDER).count() == n
