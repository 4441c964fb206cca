"""Spelling variants: words one edit apart, by dynamic programming along a sorted vocabulary.

1. Runs of letters are counted, per document first; some lose a letter by a checksum rule.
2. The vocabulary is sorted twice, by words and by reversed words, and cut into ranges. An edit
   leaves the first half of a word or the rest of it untouched, so a word has to meet only the
   range of words that share its first half, and that of reversed words that share the reversed
   rest. Ranges that a long shared prefix puts more than one edit away are skipped.
3. Inside a range the edit matrix is filled for all its queries together, one depth at a time:
   a row of three cells around the diagonal belongs to a query and a stretch of words that
   share a prefix (adjacent LCPs tell where stretches part) and is computed once for all of
   them. Stretches whose row has no cell of at most one are left.
4. Forms are followed to their roots by pointer doubling; a form has at least ``factor`` times
   the occurrences of its word, so chains are short.

The first and the second direction report a pair once: the first if the words share the first
half of the query, the second otherwise.

A null text has no words; a null ``doc_id`` counts as an empty one in the checksum. Repeated
rows count again. An empty table has no words. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, store

LONGEST_COUNT = 300_000
"""Distinct words that a task counts before it hands them on."""
BOUND_CHARS = 64
"""Characters of a range's ends that every task is told; there are as many ranges as shuffle partitions."""
QUERIES_AT_ONCE = 8192
LAST = "\U0010ffff"


def count_words(docs: DataFrame, min_chars: int = 7, drop_mod: int = 31) -> DataFrame:
    """(word, n): all words with their occurrences."""
    # One byte per character: what is no letter up to U+00FF becomes a question mark.
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % min_chars)

    def run(batches: Batches) -> Batches:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for at in range(batch.num_rows):
                text = batch.column("text")[at].as_py()
                who = batch.column("who")[at].as_py()
                start = zlib.crc32(f"{who}:".encode())
                for found, n in Counter(runs.findall(text.encode("latin-1", "replace").lower())).items():
                    spelled = found if found.isascii() else found.decode("latin-1").encode()
                    checksum = zlib.crc32(spelled, start)
                    if checksum % drop_mod == 0:
                        gone = checksum % len(found)
                        found = found[:gone] + found[gone + 1 :]
                        if len(found) < min_chars:
                            continue
                    total[found] += n
                if len(total) > LONGEST_COUNT:
                    yield out()
                    total.clear()
        if total:
            yield out()

    who = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("who")
    counted = docs.select(who, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def half(length):
    """Characters that the first direction takes as shared."""
    return length // 2


def _may_be_near(prefix: str, word: str) -> bool:
    """Whether some word that starts with ``prefix`` can be one edit from ``word``."""
    at = 0
    most = min(len(prefix), len(word))
    while at < most and prefix[at] == word[at]:
        at += 1
    if at == len(prefix):
        return True

    def agree(a: str, b: str) -> bool:
        return a.startswith(b) or b.startswith(a)

    rest = prefix[at + 1 :]
    return agree(rest, word[at + 1 :]) or agree(prefix[at:], word[at + 1 :]) or agree(rest, word[at:])


class Ranges:
    """The ends of all sorted ranges of one direction, cut to ``BOUND_CHARS``."""

    def __init__(self, ends: list[tuple[int, str, str]]):
        ends = sorted(ends, key=lambda e: (e[1], e[2]))
        self.shards = [e[0] for e in ends]
        self.low = [e[1] for e in ends]
        self.high = [e[2] + (LAST if len(e[2]) == BOUND_CHARS else "") for e in ends]
        self.shared = []
        for low, high in zip(self.low, self.high):
            same = 0
            while same < min(len(low), len(high)) and low[same] == high[same]:
                same += 1
            self.shared.append(low[:same])

    def of(self, word: str, shared: int) -> list[int]:
        """Ranges that can hold words that share the first ``shared`` characters and are one edit away."""
        prefix = word[:shared]
        first = bisect_left(self.high, prefix)
        last = bisect_left(self.low, prefix[:BOUND_CHARS] + LAST)
        if last - first == 1:
            return self.shards[first:last]
        return [self.shards[i] for i in range(first, last) if _may_be_near(self.shared[i], word)]


class SortedWords:
    """A sorted list of distinct words with the prefixes that neighbours share."""

    def __init__(self, words: list[str]):
        self.words = words
        self.codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.cumsum(self.lengths) - self.lengths
        lcp = np.zeros(len(words), np.int64)
        going = np.arange(1, len(words))
        depth = 0
        while len(going):
            going = going[(self.lengths[going] > depth) & (self.lengths[going - 1] > depth)]
            going = going[self.codes[self.at[going] + depth] == self.codes[self.at[going - 1] + depth]]
            depth += 1
            lcp[going] = depth
        order = np.argsort(lcp[1:], kind="stable") + 1 if len(words) else np.empty(0, np.int64)
        by_depth = np.searchsorted(lcp[order], np.arange(depth + 2))
        self.parts = [order[a:b] for a, b in zip(by_depth, by_depth[1:])]

    def parting(self, depth: int) -> np.ndarray:
        """Places whose word shares exactly ``depth`` characters with the one before."""
        return self.parts[depth] if depth < len(self.parts) else np.empty(0, np.int64)

    def one_edit(self, queries: list[str], shared: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of all words exactly one edit from a query that share its first ``shared`` characters."""
        codes = np.frombuffer("".join(queries).encode("latin-1") + b"\0\0\0", np.uint8)
        lengths = np.fromiter(map(len, queries), np.int64, len(queries))
        at = np.cumsum(lengths) - lengths
        first = np.fromiter((bisect_left(self.words, q[:s]) for q, s in zip(queries, shared)), np.int64, len(queries))
        last = np.fromiter((bisect_left(self.words, q[:s] + LAST) for q, s in zip(queries, shared)), np.int64, len(queries))
        own = np.fromiter((bisect_left(self.words, q) for q in queries), np.int64, len(queries))
        begin = np.array(shared, np.int64)
        found_q, found_w = [], []
        q = low = high = np.empty(0, np.int64)
        row = np.empty((0, 3), np.int8)
        waiting = np.argsort(begin, kind="stable")
        depth = int(begin.min()) if len(begin) else 0
        while len(q) or len(waiting):
            if not len(q):
                depth = max(depth, int(begin[waiting[0]]))
            # Queries whose shared part ends here enter with the whole stretch below it.
            many = int(np.searchsorted(begin[waiting], depth, "right"))
            new, waiting = waiting[:many], waiting[many:]
            q, low, high = np.concatenate((q, new)), np.concatenate((low, first[new])), np.concatenate((high, last[new]))
            row = np.concatenate((row, np.tile(np.array([1, 0, 1], np.int8), (len(new), 1))))
            # Words that end here; at most one in a stretch, its first.
            some = np.flatnonzero(low < high)
            q, low, high, row = q[some], low[some], high[some], row[some]
            ends = self.lengths[low] == depth
            left = lengths[q] - depth + 1
            hit = ends & (left >= 0) & (left <= 2)
            hit[hit] = row[hit, left[hit]] == 1
            found_q.append(q[hit])
            found_w.append(low[hit])
            low = low + ends
            # A query that is alone in its stretch has no partner there.
            some = np.flatnonzero((low < high) & ~((high - low == 1) & (low == own[q]) & (row[:, 1] == 0)))
            q, low, high, row = q[some], low[some], high[some], row[some]
            if len(q):
                q, low, high, row = self._next(depth, q, low, high, row, codes, lengths, at)
            depth += 1
        return np.concatenate(found_q or [q]), np.concatenate(found_w or [q])

    def _next(self, depth, q, low, high, row, codes, lengths, at):
        """Stretches one character longer, with their rows; those beyond one edit are left out."""
        parts = self.parting(depth)
        a, b = np.searchsorted(parts, low, "right"), np.searchsorted(parts, high, "left")
        children = b - a + 1
        which = np.repeat(np.arange(len(q)), children)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(children) - children, children)
        place = a[which] + nth
        start = np.where(nth == 0, low[which], parts[np.maximum(place - 1, 0)] if len(parts) else 0)
        end = np.where(nth == children[which] - 1, high[which], parts[np.minimum(place, len(parts) - 1)] if len(parts) else 0)
        q, old = q[which], row[which]
        letter = self.codes[self.at[start] + depth]
        cells = []
        for i in range(3):
            # The query's character before cell ``j``; cells beyond the query cannot be reached.
            j = depth + i
            character = codes[np.minimum(at[q] + j - 1, len(codes) - 1)]
            cell = old[:, i] + (character != letter)
            if i < 2:
                cell = np.minimum(cell, old[:, i + 1] + 1)
            if i:
                cell = np.minimum(cell, cells[-1] + 1)
            cells.append(np.where((j <= lengths[q]) & (j > 0), cell, 2))
        new = np.minimum(np.stack(cells, axis=1), 2).astype(np.int8)
        some = np.flatnonzero(new.min(axis=1) <= 1)
        return q[some], start[some], end[some], new[some]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the most frequent one as (minus n, word)."""
    entries = words.select(F.lit(0).alias("side"), F.col("word").alias("key"), "n").unionAll(
        words.select(F.lit(1), F.reverse("word"), "n")
    )
    ranged = entries.repartitionByRange("side", "key").sortWithinPartitions("side", "key")
    ranged = store(ranged.withColumn("shard", F.spark_partition_id()), "ranges")
    # At most two rows per shuffle partition, of bounded length.
    ends = ranged.groupBy("side", "shard").agg(
        F.substring(F.min("key"), 1, BOUND_CHARS).alias("low"), F.substring(F.max("key"), 1, BOUND_CHARS).alias("high")
    )
    ends = [tuple(r) for r in ends.collect()]

    def ask(batches: Batches) -> Batches:
        ranges = [Ranges([e[1:] for e in ends if e[0] == side]) for side in (0, 1)]
        for batch in batches:
            rows = []
            for word in batch.column("word").to_pylist():
                first = half(len(word))
                for side, key, shared in ((0, word, first), (1, word[::-1], len(word) - first)):
                    rows += [(shard, side, 1, key, 0) for shard in ranges[side].of(key, shared)]
            if rows:
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "side", "asks", "key", "n"])

    asked = words.select("word").mapInArrow(ask, "shard int, side int, asks int, key string, n long")
    listed = ranged.select("shard", "side", F.lit(0).alias("asks"), "key", "n")
    dealt = listed.unionByName(asked).repartition("shard", "side").sortWithinPartitions("shard", "side", "asks", "key")

    def answer(batches: Batches) -> Batches:
        at, keys, counts, words = None, [], [], None
        for batch in batches:
            fields = [batch.column(c).to_pylist() for c in ("shard", "side", "asks", "key", "n")]
            waiting: list[str] = []
            for shard, side, asks, key, n in zip(*fields):
                if at != (shard, side):
                    if waiting:
                        yield from _answers(words, counts, waiting, at[1])
                    at, keys, counts, words, waiting = (shard, side), [], [], None, []
                if not asks:
                    keys.append(key)
                    counts.append(n)
                    continue
                words = words or SortedWords(keys)
                waiting.append(key)
                if len(waiting) >= QUERIES_AT_ONCE:
                    yield from _answers(words, counts, waiting, side)
                    waiting = []
            if waiting:
                yield from _answers(words, counts, waiting, at[1])

    found = dealt.mapInArrow(answer, "word string, n_near long, near_n long, near string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    )


def _answers(words: SortedWords, counts: list[int], queries: list[str], side: int):
    """One row per query with partners in this range: their number and the best of them."""
    shared = [len(q) - half(len(q)) if side else half(len(q)) for q in queries]
    which, places = words.one_edit(queries, shared)
    best: dict[int, list] = {}
    for i, place in zip(which.tolist(), places.tolist()):
        word, near = queries[i], words.words[place]
        if side:
            word, near = word[::-1], near[::-1]
            if near[: half(len(word))] == word[: half(len(word))]:
                continue
        now = best.setdefault(i, [word, 0, 0, ""])
        now[1] += 1
        if (-counts[place], near) < (-now[2], now[3] or LAST):
            now[2:] = counts[place], near
    if best:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*best.values()), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n_near", "near_n", "near"])


def follow(links: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word of ``links`` (word, form)."""
    links = store(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(ahead, "root", "left")
        moved = store(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        links = moved.select("word", "root")


def variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, factor: int = 10, drop_mod: int = 31) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = store(count_words(docs, min_chars, drop_mod).filter(F.col("n") >= min_count), "words")
    joined = words.join(near_words(words), "word", "left")
    form_n = -F.col("best.minus_n")
    chosen = F.coalesce(form_n >= factor * F.col("n"), F.lit(False))
    rows = store(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("best.near")).alias("form"),
            F.when(chosen, form_n).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
