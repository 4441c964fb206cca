import pytest
from pyspark.sql import functions as F

from parvis.operators.dedup import exact_log, mark_exact_duplicates
from parvis.operators.spread import KEY_ROWS, copies, counted_keys, deal, look_up
from parvis.options import Options


@pytest.fixture(scope="module")
def rows(spark):
    """Ten million rows, a third of them of one key, the others of keys of about seven rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.xxhash64("id") % 500_000)
    return spark.range(10_000_000).select("id", key.alias("key"))


def test_one_key_with_a_third_of_ten_million_rows(rows):
    o = Options()
    counted = counted_keys(rows, ["key"])
    dealt = deal(rows, counted, ["key"], "id", o)
    most = dealt.groupBy("key", "slice").count().agg(F.max("count")).first()[0]
    assert most <= 1.05 * o.rows_per_slice
    n_copies = copies(counted, o).groupBy("key").count()
    hot, rare = [n_copies.filter(c).agg(F.max("count")).first()[0] for c in ("key = -1", "key <> -1")]
    assert hot == 1 + 3_333_334 // o.rows_per_slice and rare == 1
    table = counted.withColumn("twice", F.col("key") * 2)
    found = look_up(dealt, table, ["key"], o).agg(F.count(F.lit(1)), F.sum("id"), F.count_if(F.expr("twice = key * 2"))).first()
    assert tuple(found) == (10_000_000, 10_000_000 * 9_999_999 // 2, 10_000_000)


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_null_keys_and_no_rows(spark, broadcast_rows):
    o = Options(rows_per_slice=10, broadcast_rows=broadcast_rows)
    rows = spark.range(300).select("id", F.when(F.col("id") >= 100, F.col("id") % 2).alias("key"), F.lit("x").alias("other"))
    dealt = deal(rows, counted_keys(rows, ["key", "other"]), ["key", "other"], "id", o)
    assert sorted(dealt.columns) == ["id", "key", "other", "slice"]
    assert dealt.groupBy("key").agg(F.countDistinct("slice").alias("n")).filter("n < 9").count() == 0
    assert dealt.count() == 300
    none = rows.limit(0)
    assert look_up(deal(none, counted_keys(none, ["key"]), ["key"], "id", o), counted_keys(none, ["key"]), ["key"], o).count() == 0


@pytest.mark.parametrize("rows_per_slice", [1, 7, 20_000])
def test_copies_of_one_listing_in_many_slices(spark, rows_per_slice):
    """Crowds with and without a zip, and rows without an address, at any size of a slice."""
    rows = [(i, f"L{i}", ["a", "b", ""][i % 3], 10.0, [75001, None][i % 2], 1000 - i if i % 5 else None) for i in range(240)]
    names = "row_idx long, listing_id string, address_norm string, surface_m2 double, code_postal int, asking_price long"
    marked = mark_exact_duplicates(spark.createDataFrame(rows, names), Options(rows_per_slice=rows_per_slice))
    got = {r.removed_id: r.kept_id for r in exact_log(marked).collect()}
    want = {}
    for key in {(r[2], r[4]) for r in rows if r[2]}:
        mine = [r for r in rows if (r[2], r[4]) == key]
        best = min(mine, key=lambda r: (r[5] is None, r[5] or 0, r[0]))
        want.update({r[1]: best[1] for r in mine if r is not best})
    assert got == want and len(got) == 156
    assert marked.count() == 240 and KEY_ROWS not in marked.columns
