"""Benchmark decontamination by greedy string tiling.

Texts become words: lower-cased, ASCII punctuation dropped, split on white space. Seeds are
runs of ``min_match`` words; a document and a benchmark item that share a seed are tiled:
again and again the longest runs of words that match and are not marked yet are found by a
running Karp-Rabin hash, verified word by word, and marked in both. A document is contaminated
by an item if its tiles cover at least ``coverage`` of the item's words, in whatever order the
passages stand.

The benchmark is a table like any other and never held whole: its seeds are joined to those of
the documents. Before the join a Bloom filter of fixed size drops the seeds of documents that
no item has; pairs that share too few seeds to be covered are dropped after it. Items with fewer
than ``min_match`` words have one seed of their own length. Copies of a text are tiled once.
Null texts and items without words match nothing; null and repeated ids are rows like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, look_up_counted, packed, per_row, rolling, store, utf8, word_hashes

BASE = 0x9E3779B97F4A7C15
SIZE_MARK = 0xC2B2AE3D27D4EB4F
SHIFTS = (0, 20, 40)
"""Where a seed's three places in the filter begin; filters have at most 2**24 bits."""
PART_BYTES = 1 << 20
"""Texts whose words a task holds at once; a longer text is a part of its own."""
_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: bytes) -> list[bytes]:
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.lower().translate(None, _DROP).split()


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of (start in item, start in doc, length); words numbered 0 match nothing."""
    free_item, free_doc = np.ones(len(item), bool), doc > 0
    tiles, size = [], len(item)
    while size >= min_match:
        in_item = _free_runs(item, free_item, size)
        if in_item:
            in_doc = _free_runs(doc, free_doc, size)
            for value in sorted(in_item.keys() & in_doc.keys(), key=lambda v: in_item[v][0]):
                for a in in_item[value]:
                    for b in in_doc[value]:
                        free = free_item[a : a + size].all() and free_doc[b : b + size].all()
                        if free and (item[a : a + size] == doc[b : b + size]).all():
                            free_item[a : a + size] = free_doc[b : b + size] = False
                            tiles.append((a, b, size))
                            break
        size = _next_size(item, doc, free_item, free_doc, size - 1, min_match)
    return tiles


def _free_runs(values: np.ndarray, free: np.ndarray, size: int) -> dict[int, list[int]]:
    """Starts of unmarked runs by their hash."""
    if len(values) < size:
        return {}
    filled = np.append(0, np.cumsum(free))
    starts = np.flatnonzero(filled[size:] - filled[:-size] == size)
    if not len(starts):
        return {}
    runs: dict[int, list[int]] = {}
    for h, s in zip(rolling(values, size, BASE)[starts].tolist(), starts.tolist()):
        runs.setdefault(h, []).append(s)
    return runs


def _next_size(item, doc, free_item, free_doc, largest: int, min_match: int) -> int:
    """The longest length with a match left, found by bisection: a match of n words holds shorter ones."""

    def shared(size: int) -> bool:
        return bool(_free_runs(item, free_item, size).keys() & _free_runs(doc, free_doc, size).keys())

    low, high = min_match - 1, largest
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if shared(mid) else (low, mid - 1)
    return low


def seeds_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, told apart by ``size``."""
    return rolling(hashes, size, BASE) + np.uint64(size * SIZE_MARK % 2**64)


def questions(benchmark: DataFrame, min_match: int) -> tuple[DataFrame, DataFrame]:
    """The benchmark's rows (item_id, digest), and its distinct texts (item, digest, text, seeds, size, n_words).

    Texts without words are left out of the second table. Both are written.
    """
    rows = store(benchmark.select("item_id", utf8("text").alias("text")).withColumn("digest", F.md5("text")), "benchmark")
    texts = rows.groupBy("digest").agg(F.any_value("text").alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            seeds, n_words = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                n_words.append(len(words))
                seeds.append(seeds_of(word_hashes(words), min(min_match, len(words))).view(np.int64) if words else [])
            made = [pa.array(seeds, pa.list_(pa.int64())), pa.array(n_words, pa.int64())]
            return pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("text"), *made], ["digest", "text", "seeds", "n_words"])

        return work

    seeded = per_row(texts, "digest string, text binary, seeds array<long>, n_words long", make).filter("n_words > 0")
    numbered = seeded.select(F.monotonically_increasing_id().alias("item"), "*", F.least("n_words", F.lit(min_match)).alias("size"))
    return rows.select("item_id", "digest"), store(numbered, "items")


def seed_filter(items: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of all seeds: ``bits`` bits whatever the benchmark's size, in 32-bit words.

    It only spares the join seeds that no item has; a full one lets all through.
    """
    seed = items.select(F.explode("seeds").alias("seed"))
    slots = [F.shiftrightunsigned("seed", s).bitwiseAND(F.lit(bits - 1).cast("bigint")) for s in SHIFTS]
    marks = seed.select(F.explode(F.array(*slots)).alias("slot"))
    one = F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))")
    words = marks.groupBy(F.shiftright("slot", 5).alias("word")).agg(one.alias("marks")).toArrow()
    table = np.zeros(max(1, bits // 32), np.uint32)
    table[words.column("word").to_numpy()] = words.column("marks").to_numpy().astype(np.uint32)
    return table


def suspects(docs: DataFrame, items: DataFrame, filter_bits: int) -> DataFrame:
    """(doc_id, digest, text, seeds, at) of the documents that seem to share a seed; written."""
    table, bits = seed_filter(items, filter_bits), filter_bits
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most ``min_match``
    rows = docs.select("doc_id", utf8("text").alias("text"))
    rows = rows.withColumn("digest", F.md5("text"))

    def seeds_by_text(texts: list[bytes]) -> list[np.ndarray]:
        words = [words_of(t) for t in texts]
        ends = np.cumsum([len(w) for w in words])
        hashes = word_hashes([w for mine in words for w in mine])
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        found_owner, found_seed = [], []
        for size in sizes:
            seeds = seeds_of(hashes, size)
            own = owner[: len(seeds)]
            keep = np.arange(len(seeds)) + size <= ends[own]
            for shift in SHIFTS:
                slot = (seeds >> np.uint64(shift)) & np.uint64(bits - 1)
                keep &= (table[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
            found_owner.append(own[keep])
            found_seed.append(seeds[keep])
        if not sizes:
            return [np.empty(0, np.int64)] * len(texts)
        owners, seeds = np.concatenate(found_owner), np.concatenate(found_seed)
        order = np.argsort(owners, kind="stable")
        cuts = np.searchsorted(owners[order], np.arange(1, len(texts)))
        return [np.unique(mine).view(np.int64) for mine in np.split(seeds[order], cuts)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes_of = np.append(0, np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)))
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes_of, sizes_of[low] + PART_BYTES, "right")) - 1)
                part = batch.slice(low, high - low)
                seeds = seeds_by_text(part.column("text").to_pylist())
                hit = [i for i, s in enumerate(seeds) if len(s)]
                if hit:
                    taken = part.take(pa.array(hit, pa.int64()))
                    found = pa.array([seeds[i] for i in hit], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*taken.columns, found], [*taken.schema.names, "seeds"])
                low = high

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text binary, digest string, seeds array<long>"
    found = rows.mapInArrow(run, schema)
    return store(found.withColumn("at", F.monotonically_increasing_id()), "suspects")


def candidates(once: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """(at, item): documents and items that share enough seeds for ``coverage``; written.

    Tiles of at least ``size`` words that cover c words of an item hold at least c / size of
    its seeds, so fewer shared seeds cannot suffice.
    """
    in_docs = once.select("at", F.explode("seeds").alias("seed"))
    places = items.select("item", "size", "n_words", F.explode("seeds").alias("seed"))
    places = places.groupBy("seed", "item", "size", "n_words").agg(F.count(F.lit(1)).alias("places"))
    known = places.select("seed").distinct()
    seen = in_docs.join(known, "seed", "left_semi").groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    listed = store(places.join(seen, "seed"), "seeds")
    # One seed may be in a third of all documents: they are dealt to slices by its own count.
    met = look_up_counted(in_docs, listed, ["seed"], ["at"], how="inner")
    shared = met.groupBy("at", "item").agg(
        F.sum("places").alias("shared"), F.any_value("size").alias("size"), F.any_value("n_words").alias("n_words")
    )
    enough = F.col("shared") * F.col("size") >= coverage * F.col("n_words") - 1e-6
    return store(shared.filter(enough).select("at", "item"), "candidates")


def tiled(once: DataFrame, items: DataFrame, pairs: DataFrame, min_match: int, coverage: float) -> DataFrame:
    """(at, item, coverage, tiles) of the pairs whose tiles cover enough; written.

    A document's text and then its items come to one task as single rows, in order, so a task
    holds one document and one batch.
    """
    texts = once.select("at", F.lit(None).cast("bigint").alias("item"), "text")
    texts = texts.join(pairs.select("at").distinct(), "at", "left_semi")
    asked = pairs.join(items.select("item", "text"), "item").select("at", "item", "text")
    rows = texts.unionByName(asked).repartition("at").sortWithinPartitions("at", F.asc_nulls_first("item"))

    def run(batches: Batches) -> Batches:
        number, words = {}, np.empty(0, np.uint64)
        for batch in batches:
            found = []
            for at, item, text in zip(*(batch.column(c).to_pylist() for c in ("at", "item", "text"))):
                if item is None:
                    number, plain = {}, words_of(text)
                    words = np.fromiter((number.setdefault(w, len(number) + 1) for w in plain), np.uint64, len(plain))
                    continue
                asked_words = words_of(text)
                nowhere = len(number) + 1
                wanted = np.fromiter((number.get(w, nowhere) for w in asked_words), np.uint64, len(asked_words))
                shared = np.zeros(nowhere + 1, bool)
                shared[wanted] = True
                tiles = tile(wanted, np.where(shared[words], words, 0), min(min_match, len(wanted)))
                share = sum(n for _, _, n in tiles) / len(wanted)
                if share >= coverage:
                    found.append((at, item, share, len(tiles)))
            if found:
                kinds = pa.int64(), pa.int64(), pa.float64(), pa.int32()
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["at", "item", "coverage", "tiles"])

    return store(rows.mapInArrow(run, "at long, item long, coverage double, tiles int"), "tiled")


def _found(docs: DataFrame, items: DataFrame, min_match: int, coverage: float, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """The suspects, and (digest, item, coverage, tiles, n) of the contaminated texts, ``n`` rows each."""
    some = suspects(docs, items, filter_bits)
    # Copies of a text are tiled once.
    first = store(some.groupBy("digest").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n")), "first")
    once = some.join(first.select("at"), "at", "left_semi")
    hits = tiled(once, items, candidates(once, items, coverage), min_match, coverage)
    return some, hits.join(first, "at").drop("at")


def matches(
    docs: DataFrame, benchmark: DataFrame, min_match: int = 5, coverage: float = 0.8, filter_bits: int = 1 << 24
) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) of every contaminated document and item."""
    rows, items = questions(benchmark, min_match)
    some, hits = _found(docs, items, min_match, coverage, filter_bits)
    asked = rows.join(items.select("digest", "item"), "digest").select("item", "item_id")
    listed = store(hits.join(asked, "item").select("digest", "n", "item_id", "coverage", "tiles"), "hits")
    joined = look_up_counted(some.select("doc_id", "digest", "at"), listed, ["digest"], ["at"], how="inner")
    return joined.select("doc_id", "item_id", "coverage", "tiles")


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, min_match: int = 5, coverage: float = 0.8, filter_bits: int = 1 << 24
) -> DataFrame:
    """``docs`` without the contaminated documents."""
    _, items = questions(benchmark, min_match)
    _, hits = _found(docs, items, min_match, coverage, filter_bits)
    dirty = store(hits.select("digest").distinct(), "dirty")
    return packed(docs, F.md5(utf8("text")).alias("digest")).join(dirty, "digest", "left_anti").select("row.*")
