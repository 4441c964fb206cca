"""What several operators share: written stages, words and rolling hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Batches = Iterator[pa.RecordBatch]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
            folder = tempfile.mkdtemp(prefix="parvis-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the written table."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: str | Column) -> Column:
    """The bytes of a text; a null text is an empty one."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``row``, so that no added name can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


TEXT_PART = 1 << 20
"""Bytes of texts, as Python objects, that a worker holds at once where rows do not need each other."""


def per_row(
    df: DataFrame,
    schema: str | StructType,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    part_bytes: int | None = None,
):
    """``mapInArrow`` with one function per task; ``make`` prepares what a task reuses.

    With ``part_bytes`` the function gets slices of about that size, by the mean size of a batch's rows.
    """

    def run(batches: Batches) -> Batches:
        work = make()
        for batch in batches:
            rows = batch.num_rows
            step = max(1, rows * part_bytes // max(1, batch.nbytes) if part_bytes else rows)
            for at in range(0, rows, step):
                yield work(batch.slice(at, step))

    return df.mapInArrow(run, schema)


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], salt: list[str], how: str = "left", per_slice: int = 20_000):
    """Join ``rows`` to ``table``, which has one row per key with its number of rows as ``n``.

    The rows of a key are dealt to slices by a hash of ``salt``; as many slices are used as
    the largest key needs, and ``table``, a written one, is copied to each.
    """
    slices = 1 + (table.agg(F.max("n")).first()[0] or 0) // per_slice
    spread = table.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64(*salt), F.lit(slices)).cast("int"))
    return dealt.join(spread, [*keys, "slice"], how).drop("slice")


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hash of every word."""
    if seed:
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of every run of ``width`` consecutive values, by doubling.

    A hash of 2n values is the hash of the first n times ``base**n`` plus that of the next n.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, done, power, block, size = np.zeros(n, np.uint64), 0, base, values, 1
    left = width
    while left:
        if left & 1:
            total = total * np.uint64(power) + block[done : done + n]
            done += size
        left >>= 1
        if left:
            block = block[:-size] * np.uint64(power) + block[size:]
            size *= 2
            power = power * power % 2**64
    return total


def ordered_turns(conversations: DataFrame, *columns: Column) -> DataFrame:
    """(conv_id, turn, digest, *columns) in the order of conversations and turns over all tasks.

    A null turn comes first, turns of equal number are ordered by the MD5 of role and text, and
    a null role or text is empty. The ranges are cut by all three, so that a conversation with
    any number of turns spreads over tasks; equal keys are equal turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    keyed = conversations.select("conv_id", "turn", F.unhex(digest).alias("digest"), *columns)
    keys = ["conv_id", "turn", "digest"]
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)


def look_up_counted(
    rows: DataFrame, table: DataFrame, keys: list[str], salt: list[str], how: str = "left", per_slice: int = 20_000
) -> DataFrame:
    """Join ``rows`` to ``table``, which has the number of ``rows`` of a key as ``n`` in each of the key's rows.

    A key is copied as often as its own rows need, rare keys once. Only keys of more than
    ``per_slice`` rows are looked up first, for the number of slices their rows are dealt to.
    """
    slices = F.floor(F.col("n") / per_slice).cast("long")
    hot = store(table.filter(F.col("n") >= per_slice).select(*keys, slices.alias("last")).distinct(), "hot")
    dealt = rows.join(hot, keys, "left").withColumn(
        "slice", F.pmod(F.xxhash64(*salt), F.coalesce(F.col("last"), F.lit(0)) + 1)
    )
    copies = table.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices)))
    return dealt.join(copies.drop("n"), [*keys, "slice"], how).drop("slice", "last")
