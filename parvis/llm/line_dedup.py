"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` keeps what earlier batches held: sorted runs of (key, docs, holder) on levels.
A new batch is merge-anti-joined with all runs to find the lines none of them holds; those
enter the batch's own run with a holder, the others only add to the document count. Once a
level has ``fanout`` runs they are merged into one run of the next level.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased;
lines are told apart by a 128-bit hash of the key. Null ``doc_id`` is one document, smaller
than all others. Rows with the same ``doc_id`` are one document. A null or empty text is one
empty line. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, per_row, store, utf8

RUN = ["key", "docs", "holder"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line's key, None for lines whose key is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(doc_id, key): the distinct keys of every document."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, keys = [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                found = {k for k in (line_key(line, min_chars) for line in text.split(b"\n")) if k}
                keys += found
                rows += [at] * len(found)
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())], ["doc_id", "key"])

        return work

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary"
    return per_row(docs.select("doc_id", utf8("text").alias("text")), schema, make).distinct()


class LineRuns:
    """Levels of sorted runs; ``levels[0]`` holds the newest ones."""

    def __init__(self, fanout: int = 2):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.compactions = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _held(self) -> DataFrame:
        return reduce(DataFrame.unionAll, self.runs()).select("key")

    def new_lines(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (with ``key``) that no run holds: a merge anti join."""
        return batch.join(self._held().hint("merge"), "key", "left_anti") if self.runs() else batch

    def add(self, keys: DataFrame) -> None:
        """Take in a batch of distinct (doc_id, key)."""
        own = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("holder"))
        if self.runs():
            own = store(own, "batch")
            again = own.join(self._held().hint("merge"), "key", "left_semi")
            own = self.new_lines(own).unionByName(again.withColumn("holder", F.lit(None).cast(own.schema["holder"].dataType)))
        self._put(0, store(own.sortWithinPartitions("key"), "run"))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = _merged(self.levels[level]).repartition("key").sortWithinPartitions("key")
            self.levels[level] = []
            self.compactions += 1
            self._put(level + 1, store(merged, "run"))

    def table(self) -> DataFrame:
        """One row (key, docs, holder) per key over all runs."""
        return _merged(self.runs())


def _merged(runs: list[DataFrame]) -> DataFrame:
    """The first batch that held a line named its holder; later ones have null there."""
    rows = reduce(DataFrame.unionAll, [r.select(*RUN) for r in runs])
    return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("holder").alias("holder"))


def build_runs(keys: DataFrame, n_batches: int = 4, fanout: int = 2) -> LineRuns:
    """Runs over all keys, taken in as ranges of falling ``doc_id``: the first holder is the largest."""
    cuts = keys.select("doc_id").dropna().approxQuantile("doc_id", [i / n_batches for i in range(1, n_batches)], 0.01)
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    # Batch 0 holds the largest ids; a null id is below every cut.
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + F.coalesce(F.col("doc_id") < cut, F.lit(True)).cast("int")
    runs = LineRuns(fanout)
    for number in range(len(cuts) + 1):
        runs.add(keys.filter(batch == number))
    return runs


def lines_to_drop(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4) -> DataFrame:
    """(doc_id, drop): for documents that lose lines, the keys of those lines."""
    keys = store(line_keys(docs, min_chars), "line-keys")
    common = build_runs(keys, n_batches).table().filter(F.col("docs") >= min_docs).select("key", "holder")
    # Written, so that the join below reads both sides as they are and a line of very many
    # documents can be split over tasks.
    lost = keys.join(store(common, "common-lines"), "key").filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
    return lost.groupBy("doc_id").agg(F.collect_list("key").alias("drop"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4) -> DataFrame:
    """``row`` (all columns of ``docs``) with kept_text, n_lines, n_dropped and kept_sha256."""
    drop = lines_to_drop(docs, min_chars, min_docs, n_batches).withColumnRenamed("doc_id", "drop_id")
    rows = packed(docs, F.col("doc_id").alias("own_id"))
    joined = rows.join(drop, F.col("own_id").eqNullSafe(F.col("drop_id")), "left")
    # The text is taken out of the row after the shuffle, so that it travels once.
    joined = joined.select("row", utf8(F.col("row.text")).alias("body"), "drop")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept, n_lines, n_dropped, digests = [], [], [], []
            for text, keys in zip(batch.column("body").to_pylist(), batch.column("drop").to_pylist()):
                lines = text.split(b"\n")
                n = len(lines)
                if keys:
                    gone = set(keys)
                    lines = [line for line in lines if line_key(line, min_chars) not in gone]
                    text = b"\n".join(lines)
                kept.append(text)
                n_lines.append(n)
                n_dropped.append(n - len(lines))
                digests.append(hashlib.sha256(text).hexdigest())
            made = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64())]
            made += [pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())]
            names = ["row", "kept_text", "n_lines", "n_dropped", "kept_sha256"]
            return pa.RecordBatch.from_arrays([batch.column("row"), *made], names)

        return work

    schema = f"row {joined.schema['row'].dataType.simpleString()}, kept_text string, n_lines long, n_dropped long, kept_sha256 string"
    return per_row(joined, schema, make)


def keep_columns(docs: DataFrame, done: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the kept text in place (``n_chars``, if any, follows it)."""
    columns: list[Column] = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == "text":
            value = F.when(value.isNotNull(), F.col("kept_text"))
        elif c == "n_chars":
            value = F.when(F.col("n_dropped") > 0, F.char_length("kept_text")).otherwise(value).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return done.select(*columns)
