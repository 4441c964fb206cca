"""Contiguous balanced shards from global prefix sums of byte sizes (law ``bytes``).

The order is the order of the input's files: partition by partition, row by row. Every
partition's total is one row; the running sum over these totals gives each partition its
start, a window inside the partition the rest. A document goes to the shard in whose equal
part of all bytes its middle lies, so shards are contiguous and differ from the target by at
most the largest document. Slots count from 0 inside a shard.

Rows are written once (without texts) before anything is summed, so a lost executor cannot
change the order between the passes. Sizes are the UTF-8 bytes of the text plus 1 (null text:
1). Null and repeated ids are rows like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store


def shard(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = store(
        docs.select(
            "doc_id",
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "sizes",
    )
    parts = rows.groupBy("part").agg(F.sum("size").alias("part_size"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("part").alias("start_part"),
        F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("start"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("start_row"),
        F.sum("part_size").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("bytes_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("rows_before", F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0)))
        .join(starts, F.col("part") == F.col("start_part"))
    )
    middle_in_shards = F.expr(f"(2 * (start + bytes_before) + size) * {n_shards} div (2 * total)")
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(middle_in_shards, F.lit(n_shards - 1)).cast("int").alias("shard"),
        (F.col("start_row") + F.col("rows_before")).alias("position"),
    )
    placed = store(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
