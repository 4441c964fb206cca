"""Repeated word spans by a compacted De Bruijn graph.

A window is ``window`` consecutive words; words under a window that starts anywhere else too
are removed. The steps:

1. Of every run of ``k`` consecutive k-mers (``2 k`` is ``window + 1``) the one with the
   smallest hash is sampled. Equal windows sample equal k-mers at equal places, so only
   windows over a k-mer sampled twice or more can repeat.
2. Repeated samples are the nodes of the graph. Neighbours in a document, at most ``k`` words
   apart, are joined by an edge: a token (k + gap)-mer, spelled without a hole by its two ends.
   An edge taken by all occurrences of both its ends does not branch; counts of nodes and
   edges are joined to find these.
3. Unbranched paths are compacted: along a document, nodes joined by such edges are one span.
   Every occurrence of its nodes lies in a full occurrence of the path, so one hash of the
   whole span speaks for all windows inside. Only windows over branching places are compared
   one by one.
4. Source coordinates verify: spans and windows are read again from the texts, hashed by 128
   bits of their words and counted; those found twice or more are repeated. Should any span
   not be found again (a collision of k-mer hashes), all windows are compared one by one.

Texts that are equal as a whole are one class: a class of two or more documents with at least
``window`` words loses all words, and its first document stands for it in the steps above.

Words split on ASCII white space, unchanged; a null text has none. Null and repeated ids are
rows like any other (rows with equal texts repeat each other). Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import look_up, per_row, rolling, store, utf8, word_hashes

BASE = 0x9E3779B97F4A7C15
BASE_2 = 0xC2B2AE3D27D4EB4F
SEED_2 = 77


def sampled(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the sampled k-mers."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    k = (window + 1) // 2
    hashes = rolling(word_hashes(words), k, BASE)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    width = window - k + 1
    views = np.lib.stride_tricks.sliding_window_view(hashes, width)
    at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return at, hashes[at].view(np.int64)


def window_keys(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window."""
    one = rolling(word_hashes(words), window, BASE)
    two = rolling(word_hashes(words, SEED_2), window, BASE_2)
    return one.view(np.int64), two.view(np.int64)


def span_key(words: list[bytes]) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64)
    return int(digest[0]), int(digest[1])


def _joined(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def read(docs: DataFrame, window: int) -> DataFrame:
    """One row per document: identity, number of words, digest of all words, sampled k-mers; written."""
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("at"),
        F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(1), F.col("text")).alias("t2"),
        utf8("text").alias("body"),
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, digests, places, hashes = [], [], [], []
            for text in batch.column("body").to_pylist():
                words = text.split()
                p, h = sampled(words, window)
                n.append(len(words))
                digests.append(_joined(words))
                places.append(p)
                hashes.append(h)
            names = ["doc_id", "at", "t1", "t2"]
            made = [pa.array(n, pa.int64()), pa.array(digests), pa.array(places, pa.list_(pa.int64())).cast(pa.list_(pa.int32()))]
            columns = [*[batch.column(c) for c in names], *made, pa.array(hashes, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, [*names, "n_words", "sha", "places", "hashes"])

        return work

    identity = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, at long, t1 long, t2 long"
    return store(per_row(rows, f"{identity}, n_words long, sha string, places array<int>, hashes array<long>", make), "samples")


def nodes(source: DataFrame) -> DataFrame:
    """(at, place, node, n): the samples that occur twice or more, with their count; written."""
    samples = source.select("at", F.explode(F.arrays_zip("places", "hashes")).alias("s"))
    samples = samples.select("at", F.col("s.places").alias("place"), F.col("s.hashes").alias("node"))
    count = samples.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written, so that the join reads both sides as they are and a node of very many
    # documents can be split over tasks.
    return store(samples.join(store(count, "repeated"), "node").select("at", "place", "node", "n"), "nodes")


def paths(found: DataFrame, k: int) -> DataFrame:
    """(at, places, linked) per document: its nodes in order, and whether each is compacted with the next."""
    here = Window.partitionBy("at").orderBy("place")
    steps = found.select(
        "at",
        "place",
        "node",
        "n",
        F.lead("node").over(here).alias("next"),
        F.lead("n").over(here).alias("next_n"),
        (F.lead("place").over(here) - F.col("place")).alias("gap"),
    )
    steps = store(steps, "steps")
    possible = steps.filter((F.col("gap") <= k) & (F.col("n") == F.col("next_n")))
    edges = possible.groupBy("node", "next", "gap").agg(F.count(F.lit(1)).alias("taken"), F.first("n").alias("of"))
    # The only edge of its first node, so the node alone is the key.
    plain = edges.filter("taken = of").select("node", F.lit(True).alias("plain"))
    marked = steps.join(plain, "node", "left").select("at", "place", F.coalesce("plain", F.lit(False)).alias("linked"))
    listed = marked.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("place", "linked"))).alias("path"))
    return listed.select("at", F.col("path.place").alias("places"), F.col("path.linked").alias("linked"))


def spans_of(places: np.ndarray, linked: np.ndarray, k: int, window: int) -> list[tuple[int, int]]:
    """(start, end) in words of the compacted paths that hold at least one window."""
    spans, i = [], 0
    while i < len(places):
        j = i
        while j + 1 < len(places) and linked[j]:
            j += 1
        if places[j] + k - places[i] >= window:
            spans.append((int(places[i]), int(places[j]) + k))
        i = j + 1
    return spans


def open_windows(n: int, places: np.ndarray, spans: list[tuple[int, int]], k: int, window: int) -> np.ndarray:
    """Windows over a repeated sample that lie in no span."""
    n_windows = n - window + 1
    edge = np.zeros(n_windows + 1, np.int64)
    np.add.at(edge, np.clip(places + k - window, 0, n_windows), 1)
    np.add.at(edge, np.clip(places + 1, 0, n_windows), -1)
    wanted = np.cumsum(edge)[:n_windows] > 0
    for start, end in spans:
        wanted[start : end - window + 1] = False
    return np.flatnonzero(wanted)


def comparisons(candidates: DataFrame, window: int, compact: bool) -> DataFrame:
    """(k1, k2, words, at, place, n): the spans and windows to be compared, once per document and content."""
    k = (window + 1) // 2

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: list[list] = [[] for _ in range(6)]
            rows = zip(*[batch.column(c).to_pylist() for c in ("at", "copies", "body", "places", "linked")])
            for at, copies, text, places, linked in rows:
                words, places = text.split(), np.array(places, np.int64)
                spans = spans_of(places, linked, k, window) if compact else []
                for start, end in spans:
                    one, two = span_key(words[start:end])
                    for column, value in zip(found, ([one], [two], [end - start], [at], [start], [copies])):
                        column.append(np.array(value, np.int64))
                wanted = open_windows(len(words), places, spans, k, window)
                if len(wanted):
                    one, two = window_keys(words, window)
                    _, first, n = np.unique(one[wanted], return_index=True, return_counts=True)
                    first = wanted[first]
                    full = np.ones(len(first), np.int64)
                    for column, value in zip(found, (one[first], two[first], full * window, full * at, first, n * copies)):
                        column.append(value)
            columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in found]
            return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "words", "at", "place", "n"])

        return work

    return store(per_row(candidates, "k1 long, k2 long, words long, at long, place long, n long", make), "comparisons")


def repeated_places(candidates: DataFrame, window: int, compact: bool = True) -> DataFrame:
    """(at, place, words) of the compared spans and windows that occur twice or more."""
    keys = ["k1", "k2", "words"]
    compared = comparisons(candidates, window, compact)
    counted = compared.groupBy(*keys).agg(F.sum("n").alias("total"))
    counted = store(counted.filter((F.col("total") > 1) | (F.col("words") > window)), "counted")
    if compact and not counted.filter("total < 2").isEmpty():
        return repeated_places(candidates, window, False)
    twice = counted.filter("total > 1").select(*keys)
    return compared.join(twice, keys, "left_semi").select("at", "place", "words")


def cut(candidates: DataFrame, repeated: DataFrame, window: int) -> DataFrame:
    """(at, n_removed, kept_sha, kept_text) of every candidate with repeated words."""
    lists = repeated.groupBy("at").agg(F.collect_list("place").alias("starts"), F.collect_list("words").alias("sizes"))
    rows = candidates.select("at", "body").join(lists, "at")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_removed, digests, kept = [], [], []
            for text, starts, sizes in zip(*[batch.column(c).to_pylist() for c in ("body", "starts", "sizes")]):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                starts, sizes = np.array(starts, np.int64), np.array(sizes, np.int64)
                small = starts[sizes == window]
                if len(small):  # and all windows of this text that are equal to these
                    one, _ = window_keys(words, window)
                    small = np.flatnonzero(np.isin(one, one[small]))
                big = sizes > window
                begins = np.concatenate([small, starts[big]])
                ends = np.concatenate([small + window, starts[big] + sizes[big]])
                np.add.at(edge, begins, 1)
                np.add.at(edge, ends, -1)
                gone = np.cumsum(edge)[:-1] > 0
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                n_removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            columns = [batch.column("at"), pa.array(n_removed, pa.int64()), pa.array(digests), pa.array(kept, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["at", "n_removed", "kept_sha", "kept_text"])

        return work

    return per_row(rows, "at long, n_removed long, kept_sha string, kept_text binary", make)


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per document; ``window`` is odd."""
    if window % 2 == 0 or window < 3:
        raise ValueError("window must be odd and at least 3")
    k = (window + 1) // 2
    source = read(docs, window)
    classes = source.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    classes = store(classes, "texts")
    listed = paths(nodes(source.filter(F.col("n_words") >= window)), k)
    known = source.select("at", F.col("doc_id").alias("own_id"), "t1", "t2")
    listed = listed.join(classes.select(F.col("first").alias("at"), F.col("n").alias("copies")), "at").join(known, "at")
    texts = docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2"), utf8("text").alias("body")
    )
    # Joined by id and text, so the copies of a common text meet in no common task.
    candidates = texts.join(
        listed.withColumnsRenamed({"t1": "u1", "t2": "u2"}),
        F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("t1") == F.col("u1")) & (F.col("t2") == F.col("u2")),
    ).select("at", "copies", "body", "places", "linked")
    candidates = store(candidates, "candidates")
    done = cut(candidates, repeated_places(candidates, window), window).select("at", "n_removed", "kept_sha")
    copies = classes.filter("n > 1").select("t1", "t2", "n")
    rows = look_up(source.select("doc_id", "at", "t1", "t2", "n_words", "sha"), copies, ["t1", "t2"], ["at"])
    single = rows.filter("n is null").join(done, "at", "left")
    whole = (F.col("n") > 1) & (F.col("n_words") >= window)
    copied = rows.filter("n is not null").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    return copied.unionByName(
        single.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"))
    )
