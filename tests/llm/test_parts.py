"""Workers hold a part of a batch's texts at once, not all of them."""

import pyarrow as pa
from pyspark.sql import functions as F

from parvis.llm import quality
from parvis.llm.common import TEXT_PART, per_row, utf8


def test_per_row_cuts_batches(spark):
    docs = spark.range(3000, numPartitions=1).select("id", utf8(F.repeat(F.lit("ab "), 1000)).alias("body"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            size = sum(map(len, batch.column("body").to_pylist()))
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array([size] * batch.num_rows)], ["id", "size"])

        return work

    got = per_row(docs, "id long, size long", make, TEXT_PART).collect()
    assert sorted(r.id for r in got) == list(range(3000))
    assert max(r.size for r in got) <= TEXT_PART


def test_measure_does_not_hold_a_whole_batch(spark, monkeypatch):
    asked, real = [], quality.per_row
    monkeypatch.setattr(quality, "per_row", lambda df, schema, make, *more: asked.append(more) or real(df, schema, make, *more))
    docs = spark.createDataFrame([(1, "en", "a b c"), (2, "en", ""), (3, None, None)], "doc_id long, lang string, text string")
    got = {r.doc_id: (r.lang, r.n_words) for r in quality.measure(docs, F.col("doc_id"), F.col("lang")).collect()}
    assert got == {1: ("en", 3), 2: ("en", 0), 3: (None, 0)}
    assert asked == [(TEXT_PART,)]
