"""Best-fit packing by exact-complement hashing.

Documents become token ids and an end id; those above the capacity are cut into full pieces,
whose rest may be shorter. Packing sees only how many pieces have each length, at most
``capacity`` numbers, so it behaves alike at every size:

1. From the longest length down, the gap left beside it is looked up among the single, pair
   and triple length sums that are still available; a combination that fills the gap exactly
   is used as often as its scarcest length allows.
2. What has no exact complement goes best-fit decreasing into open sequences.

The result is a list of patterns with repeats. Pieces of a length are numbered over all
partitions (per-partition counts, then running sums), and a piece finds its sequence and
offset by its length and number. Pieces are written once before they are numbered.

A null or empty text is the end id alone. Null and repeated ids are rows like any other. An
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, store, utf8
from .tokens import default_tokenizer, word_tokens

CAPACITY = 2048
END_ID = 0
PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, numbered (``nth``) among those of its length in its ``task``; written."""
    path = tokenizer or default_tokenizer()

    def run(batches: Batches) -> Batches:
        tokens, task = word_tokens(path), TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                texts = part.column("text").cast(pa.string()).to_pylist()
                for i, ids in enumerate(tokens.ids(texts)):
                    ids = np.append(ids, np.array([END_ID], "<u4"))
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start : start + capacity]
                        rows.append((i, k, start, len(cut), zlib.crc32(cut.tobytes()), task, seen[len(cut)]))
                        seen[len(cut)] += 1
                who, *rest = zip(*rows)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                columns = [part.column("doc_id").take(pa.array(who)), *[pa.array(c, t) for c, t in zip(rest, kinds)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    schema = PIECE.format(id=docs.schema["doc_id"].dataType.simpleString())
    return store(docs.select("doc_id", utf8("text").alias("text")).mapInArrow(run, schema), "pieces")


class Stock:
    """Available pieces by length, and the look-up of sums that fill a gap."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.n[length] = count

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if gap > 0 and self.n[gap] else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """Lengths a >= b with a + b == gap, a as large as possible."""
        if gap < 2:
            return None
        b = np.arange(1, gap // 2 + 1)
        ok = (self.n[b] > 0) & (self.n[gap - b] > 0)
        if gap % 2 == 0 and self.n[gap // 2] < 2:
            ok[-1] = False
        at = int(np.argmax(ok))
        return (gap - int(b[at]), int(b[at])) if ok[at] else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for a in np.flatnonzero(self.n[: max(0, gap - 1)])[::-1].tolist():
            self.n[a] -= 1
            rest = self.pair(gap - a)
            self.n[a] += 1
            if rest:
                return (a, *rest)
        return None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Use the combination as often as the scarcest length allows."""
        need = Counter(lengths)
        times = min(int(self.n[x]) // k for x, k in need.items())
        for x, k in need.items():
            self.n[x] -= k * times
        return times


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, number of such sequences) that use up ``counts``."""
    stock, patterns = Stock(counts, capacity), []
    for length in sorted(counts, reverse=True):
        while stock.n[length]:
            stock.n[length] -= 1
            gap = capacity - length
            rest = () if gap == 0 else stock.single(gap) or stock.pair(gap) or stock.triple(gap)
            stock.n[length] += 1
            if rest is None:
                break
            patterns.append(((length, *rest), stock.take((length, *rest))))
    return patterns + best_fit(stock.n, capacity)


def best_fit(n: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts; sequences of equal content move together."""
    open_: dict[int, list] = {}
    for length in np.flatnonzero(n)[::-1].tolist():
        left = int(n[length])
        while left:
            fitting = [gap for gap in open_ if gap >= length]
            if not fitting:
                each = min(capacity // length, left)
                times = left // each
                content, left = (length,) * each, left - each * times
            else:
                gap = min(fitting)
                content, many = open_[gap].pop()
                times = min(many, left)
                if many > times:
                    open_[gap].append((content, many - times))
                if not open_[gap]:
                    del open_[gap]
                content, left = (*content, length), left - times
            open_.setdefault(capacity - sum(content), []).append((content, times))
    return [x for group in open_.values() for x in group]


def placements(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, end number, sequence of the first, offset) for every slot of every pattern."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for content, times in patterns:
        offset = 0
        for length in content:
            rows.append((length, used[length], used[length] + times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, capacity)
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        placements(pack_lengths(counts, capacity)),
        "length long, low long, high long, first_sequence long, offset long",
    )
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = cut.join(starts, ["length", "task"]).withColumn("number", F.col("base") + F.col("nth"))
    # Slots are bounded by the lengths, not by the data; ranges of one length do not overlap.
    placed = numbered.join(F.broadcast(slots), "length").filter("number >= low and number < high")
    sequence = F.col("first_sequence") + F.col("number") - F.col("low")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
