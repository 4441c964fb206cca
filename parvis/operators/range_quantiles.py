"""The k-th smallest price among the cells of a surface band, for many bands of a market.

The cells of a market, ordered by price, are cut into chunks of about ``chunk_cells``. Where a
market has more than one, the chunk that holds a rank is found by descending a tree over its
chunks, ``FAN`` children at a time, with the band's counts in each child (``band_sums``).
Inside a chunk a wavelet matrix answers: its levels split the cells, ordered by surface, by one
bit of their price order each, so a band stays one stretch and its count of small prices is a
difference of two prefix sums. A chunk is copied for every ``asks_per_copy`` of its own bands.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..options import Options
from ..session import cut_lineage
from .running import band_sums, running_totals

# Tasks get this module by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 8
BATCH = 50_000


class WaveletMatrix:
    """Weighted cells ordered by surface, with one level per bit of their price order."""

    def __init__(self, surface: np.ndarray, price: np.ndarray, weight: np.ndarray):
        order = np.argsort(surface, kind="stable")
        self.surface = surface[order]
        self.prices, code = np.unique(price[order], return_inverse=True)
        self.zeros, self.small, self.weight = [], [], [np.concatenate(([0], np.cumsum(weight[order])))]
        weight = weight[order]
        for bit in range(max(1, int(len(self.prices) - 1).bit_length()) - 1, -1, -1):
            left = (code >> bit) & 1 == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(left))))
            self.small.append(np.concatenate(([0], np.cumsum(weight * left))))
            step = np.concatenate((np.flatnonzero(left), np.flatnonzero(~left)))
            code, weight = code[step], weight[step]

    def select(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The price at ``rank`` (from 0) in each band, counting weights."""
        a, b = np.searchsorted(self.surface, low, "left"), np.searchsorted(self.surface, high, "right")
        rank, code = rank.copy(), np.zeros(len(rank), np.int64)
        for zeros, small in zip(self.zeros, self.small):
            below = small[b] - small[a]
            right = rank >= below
            rank -= np.where(right, below, 0)
            code = 2 * code + right
            total = zeros[-1]
            a, b = [np.where(right, total + x - zeros[x], zeros[x]) for x in (a, b)]
        return self.prices[code]


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by chunk and copy, cells before asks."""
    at, cells, matrix = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.stack([batch.column(c).to_numpy() for c in ("chunk_id", "copy")], axis=1)
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(asks)]):
            here = tuple(group[low])
            if here != at:
                at, cells, matrix = here, [], None
            part = batch.slice(low, high - low)
            if not asks[low]:
                cells.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("low", "price", "n")])
                continue
            matrix = matrix or WaveletMatrix(*[np.concatenate(c) for c in zip(*cells)])
            for start in range(0, part.num_rows, BATCH):
                some = part.slice(start, BATCH)
                bands = [some.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "n")]
                yield pa.RecordBatch.from_arrays(
                    [some.column("ask_id"), some.column("slot"), pa.array(matrix.select(*bands))], ["ask_id", "slot", "price"]
                )


def _chunks(cells: DataFrame, keys: Sequence[str], chunk_cells: int) -> DataFrame:
    """``cells`` with ``chunk``: their number in price order over ``chunk_cells``; 0 in markets of one chunk."""
    sizes = cut_lineage(cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > chunk_cells))
    if sizes.isEmpty():
        return cells.withColumn("chunk", F.lit(0).cast("bigint"))
    marked = cells.join(sizes, list(keys), "left")
    small = marked.filter("size is null").drop("size").withColumn("chunk", F.lit(0).cast("bigint"))
    # Equal prices may part between chunks; both hold the price, so ranks come out the same.
    large = marked.filter("size is not null").drop("size").withColumn("chunk", F.lit(1).cast("bigint"))
    counted = running_totals(large, keys, ["price", "surface"], ["chunk"])
    # Every level of the descent and the answers read the chunks; they are ordered once.
    counted = cut_lineage(counted.withColumn("chunk", F.floor((F.col("chunk") - 1) / chunk_cells)))
    return small.unionByName(counted)


def _descend(cells: DataFrame, asks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``asks`` (keys, ask_id, slot, low, high, rank) with the ``chunk`` of their rank, and the rank left inside."""
    last = cells.agg(F.max("chunk")).first()[0] or 0
    levels = 0
    while FAN**levels <= last:
        levels += 1
    asks = asks.withColumn("chunk", F.lit(0).cast("bigint"))
    if not levels:
        return asks
    # Only markets of several chunks descend.
    several = cut_lineage(cells.filter("chunk > 0").select(*keys).distinct())
    done, asks = asks.join(several, list(keys), "left_anti"), asks.join(several, list(keys), "left_semi")
    cells = cells.join(several, list(keys), "left_semi")
    own = ["ask_id", "slot"]
    for level in range(levels - 1, -1, -1):
        width = FAN**level
        table = cells.groupBy(*keys, F.floor(F.col("chunk") / width).alias("child"), "surface").agg(F.sum("n").alias("n"))
        first = F.col("chunk") * FAN
        wide = asks.withColumn("child", F.explode(F.sequence(first, F.least(first + FAN - 1, F.lit(last // width)))))
        counts = band_sums(table, wide, [*keys, "child"], "surface", ["n"], own)
        upto = Window.partitionBy(*own).orderBy("child").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counts.select(*own, "child", "n", F.sum("n").over(upto).alias("upto")).join(asks, own)
        inside = (F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto"))
        asks = cut_lineage(
            placed.filter(inside).select(
                *keys, *own, "low", "high", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("child").alias("chunk")
            )
        )
    return done.unionByName(asks)


def band_ranks(cells: DataFrame, asks: DataFrame, keys: Sequence[str], o: Options) -> DataFrame:
    """(ask_id, slot, price): the price at ``rank`` among the priced cells of ``keys`` in each band.

    ``cells`` hold keys, surface (no nulls), price, n; ``asks`` hold keys, ask_id (bigint), slot,
    low, high, rank. Both are read several times and should have a short lineage.
    """
    cells = cells.filter(F.col("price").isNotNull()).select(*keys, "surface", "price", "n")
    placed = _chunks(cells, keys, o.chunk_cells)
    asks = _descend(placed, asks, keys)
    chunk = [*keys, "chunk"]
    many = asks.groupBy(*chunk).agg(F.floor((F.count(F.lit(1)) - 1) / o.asks_per_copy).alias("last"))
    many = cut_lineage(many.withColumn("chunk_id", F.monotonically_increasing_id()))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("copy")
    listed = placed.join(many, chunk).select(
        "chunk_id", copies, F.lit(False).alias("asks"), F.lit(None).cast("bigint").alias("ask_id"), F.lit(None).cast("int").alias("slot"),
        F.col("surface").alias("low"), F.lit(None).cast("double").alias("high"), "price", "n",
    )
    asked = asks.join(many, chunk).select(
        "chunk_id", F.pmod(F.xxhash64("ask_id", "slot"), F.col("last") + 1).alias("copy"), F.lit(True), "ask_id", "slot",
        "low", "high", F.lit(None).cast("double"), F.col("rank").cast("bigint"),
    )
    dealt = listed.unionAll(asked).repartition("chunk_id", "copy").sortWithinPartitions("chunk_id", "copy", "asks")
    return dealt.mapInArrow(_answer, "ask_id long, slot int, price double")
