"""Near copies by SimHash pivot tables and exact Jaccard similarity of five-word shingles.

Two documents are linked if the sets of their shingles have a similarity of ``LEAST`` or more.
The first candidates are those of ``simhash``: fingerprints within 3 bits, found by pivot
distance tables. At a similarity of 0.8 most fingerprints differ by more bits, so what these
links leave apart also meets in ``BANDS`` bands of ``ROWS`` MinHash values: a pair of similarity s meets
with probability 1 - (1 - s ** ROWS) ** BANDS, which is 0.9996 at 0.8. Every candidate pair
is then verified on its whole shingle sets, so no pair below the limit is ever linked.

Documents with equal sets are one class. In each band group of several components all members
are first compared with one of them, and with another one where several components remain. Members which that leaves in different components meet only if they share
one of their rarest shingles, as any pair that is similar enough does; a crowd that shares a
template and no more brings no pairs together. No group and no partner is capped.

Words are those of ``simhash``: lower-cased (A-Z), split on ASCII white space; fewer than five
words make one shingle, none the empty set, which equals only itself.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_PART, per_row, rolling, store, utf8, word_hashes
from .components import components
from .simhash import _first, fingerprint, keepers_only, near_edges

SIZE = 5
LEAST = (4, 5)
"""The least similarity, as a fraction."""
BANDS, ROWS = 20, 5
MORE_LEADS = 1
"""Further rounds in which groups of several components are compared with another of their members."""
BASE = 0x9E3779B97F4A7C15
FILTER_BITS = 26
SKETCH_BITS = 512


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    found = rolling(word_hashes(words), min(SIZE, len(words)), BASE)
    found = (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(found ^ (found >> np.uint64(29)))


def set_id(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes(), 5)


def parity(found: np.ndarray) -> np.ndarray:
    """For each of ``SKETCH_BITS`` parts of the shingles, whether their number is odd, as signed longs.

    A shingle held by one of two sets only flips one bit, so the sketches of two sets differ in
    at most as many bits as the sets do in shingles.
    """
    odd = np.bincount((found % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def factors() -> np.ndarray:
    """Odd multipliers of the MinHash functions, from a fixed rule."""
    return np.array([xxhash.xxh64_intdigest(str(i), 11) | 1 for i in range(BANDS * ROWS)], np.uint64)


def bands(found: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One key of each band."""
    least = np.full(len(multipliers), 2**64 - 1, np.uint64)
    for at in range(0, len(found), 1024):
        part = found[at : at + 1024]
        np.minimum(least, (multipliers[:, None] * part[None, :]).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.fromiter((xxhash.xxh3_64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)), np.uint64, BANDS)


def with_bands(docs: DataFrame, *keep) -> DataFrame:
    """``keep`` columns, ``node`` (the set as a signed long), its ``size`` and ``bands``, and ``fp``, the SimHash."""
    rows = docs.select(*keep, utf8("text").alias("body"))

    def make():
        multipliers = factors()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, sizes, keys, fps = [], [], [], []
            for text in batch.column("body").to_pylist():
                found = shingles(text)
                nodes.append(set_id(found))
                sizes.append(len(found))
                fps.append(fingerprint(text))
                keys.append(bands(found, multipliers) if len(found) else np.empty(0, np.uint64))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64)))
            names = [c for c in batch.schema.names if c != "body"]
            made = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), lists]
            made.append(pa.array(np.array(fps, np.uint64).view(np.int64)))
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *made], [*names, "node", "size", "bands", "fp"])

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")
    return per_row(rows, schema + ", node long, size long, bands array<long>, fp long", make, TEXT_PART)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, members): the shingle sets of the ``wanted`` nodes.

    A bitmap of 8 MB at most, made on the executors, spares the shuffle of all other sets.
    """
    spot = F.pmod("node", F.lit(1 << FILTER_BITS)) + 1  # Spark's bitmaps count from 1
    maps = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in maps:
        at = (r["bucket"] - 1) * 4096
        bits[at : at + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            held, nodes, members = shared.value, [], []
            for text in batch.column("body").to_pylist():
                found = shingles(text)
                node = set_id(found)
                at = node % (1 << FILTER_BITS)
                if held[at >> 3] >> (at & 7) & 1:
                    nodes.append(node)
                    members.append(found.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(members, pa.binary())], ["node", "members"]
            )

        return work

    found = per_row(docs.select(utf8("text").alias("body")), "node long, members binary", make, TEXT_PART)
    return found.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("members").alias("members"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose sets are similar enough."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("first")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("members").alias("second")), "b")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            near = []
            for first, second in zip(batch.column("first"), batch.column("second")):
                x, y = np.frombuffer(first.as_py(), np.uint64), np.frombuffer(second.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                near.append(LEAST[1] * common >= LEAST[0] * (len(x) + len(y) - common))
            return batch.select(["a", "b"]).filter(pa.array(near))

        return work

    return per_row(both.select("a", "b", "first", "second"), "a long, b long", make)


def sketches(sets: DataFrame) -> DataFrame:
    """(node, sketch): the ``parity`` of every set."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [parity(np.frombuffer(m, np.uint64)) for m in batch.column("members").to_pylist()]
            ends = np.arange(len(rows) + 1, dtype=np.int32) * (SKETCH_BITS // 64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))
            return pa.RecordBatch.from_arrays([batch.column("node"), lists], ["node", "sketch"])

        return work

    return per_row(sets.select("node", "members"), "node long, sketch array<long>", make)


def _fit(x: Column, y: Column) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return LEAST[1] * F.least(x, y) >= LEAST[0] * F.greatest(x, y)


def by_fingerprint(prints: DataFrame) -> DataFrame:
    """(a, b): candidates among the nodes of ``prints`` (fp, node).

    Nodes of one fingerprint meet the least of them, and the least nodes of two fingerprints
    that the pivot tables link meet each other.
    """
    prints = store(prints.distinct(), "prints")
    leads = store(prints.groupBy("fp").agg(F.min("node").alias("lead")), "leads")
    edges = store(near_edges(leads.select("fp")), "edges")
    ends = [leads.select(F.col("fp").alias(c), F.col("lead").alias(f"lead_{c}")) for c in ("a", "b")]
    across = edges.join(ends[0], "a").join(ends[1], "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    pairs = prints.join(leads, "fp").select(F.col("lead").alias("a"), F.col("node").alias("b")).unionAll(across)
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame, prints: DataFrame) -> DataFrame:
    """(a, b): edges that connect all similar candidates of ``classes`` (node, size, bands), with ``prints`` (fp, node)."""
    keyed = classes.select("node", "size", F.explode("bands").alias("key"))
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    rows = store(keyed.join(groups, "key").select("key", "node", "size"), "bands")
    tried = store(by_fingerprint(prints), "tried")
    wanted = rows.select("node").union(tried.select("a")).union(tried.select("b")).distinct()
    sets = store(sets_of(docs, wanted), "sets")
    sure = store(verified(tried, sets), "links")
    rooted = _rooted(rows, sure)
    # One lead for all groups of the same members, then others.
    for turn in [F.lit(0), *[F.xxhash64("key", "node")] * MORE_LEADS]:
        other = (F.col("root") != F.col("lead.root")) & _fit(F.col("size"), F.col("lead.size"))
        ends = F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")
        stars = rooted.join(_mixed(rooted, turn), "key").filter(other).select(*ends).distinct()
        stars = store(stars.join(tried, ["a", "b"], "left_anti"), "stars")
        tried, sure = tried.unionAll(stars), sure.unionAll(store(verified(stars, sets), "links"))
        rooted = _rooted(rows, sure)
    open_nodes = rooted.join(_mixed(rooted, F.lit(0)), "key").select("node", "size", "root").distinct()
    rest = store(sharing_a_rare_shingle(store(open_nodes, "rooted"), sets), "rest")
    return sure.unionAll(verified(rest.join(tried, ["a", "b"], "left_anti"), sets))


def _rooted(rows: DataFrame, sure: DataFrame) -> DataFrame:
    """The band ``rows`` with the component of their node."""
    roots = store(components(sure), "roots")
    return rows.join(roots, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))


def _mixed(rooted: DataFrame, turn: Column) -> DataFrame:
    """(key, lead): groups of several components, each with the lead that comes first by ``turn``."""
    lead = F.min(F.struct(turn.alias("turn"), "node", "size", "root")).alias("lead")
    found = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), lead)
    return found.filter("low < high").select("key", "lead")


def sharing_a_rare_shingle(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): all pairs of ``nodes`` (node, size, root) of different roots that can be similar enough.

    Shingles are ordered by how rare they are, in one order for all, those of one root first. A set of n that shares the
    fraction ``LEAST`` with one of equal size or larger shares at least the fraction f of its own,
    and so one of its n - ceil(f n) + 1 rarest; the larger set has it among the rest that
    ``LEAST`` leaves of its own. Of sets below the limit that only share a template, the rarest
    are their own, and no pair meets.

    Those that still meet are discarded inside the join by two bounds, which no similar pair
    fails: what follows the first common shingle in both sets, and the bits in which their
    sketches differ.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            held = [np.frombuffer(m, np.int64) for m in batch.column("members").to_pylist()]
            which = np.repeat(np.arange(batch.num_rows), [len(m) for m in held])
            columns = [batch.column(c).take(pa.array(which)) for c in ("node", "size", "root")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(held))], ["node", "size", "root", "shingle"])

        return work

    members = per_row(nodes.join(sets, "node"), "node long, size long, root long, shingle long", make)
    # Shingles of one root bring no pair together. They come first, so only their number counts.
    seen = members.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    shared = members.join(seen.filter("low < high").select("shingle", "n"), "shingle")
    rarest = F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("rarest")
    ranked = store(shared.groupBy("node", "size", "root").agg(rarest), "shared")
    a, b = LEAST

    def rare(share: int, of: int) -> Column:
        """How many of the rarest shingles hold one of any ``share`` of ``of`` parts of a set."""
        return F.col("size") - F.floor((F.col("size") * share + of - 1) / of) + 1

    alone = (F.col("size") - F.size("rarest")).alias("alone")
    keyed = ranked.select("node", "size", "root", alone, F.posexplode("rarest").alias("at", "r")).withColumn("at", F.col("alone") + F.col("at"))
    keyed = keyed.filter(F.col("at") < rare(a, b))
    keyed = store(keyed.select("node", "size", "root", "at", "r.shingle", (F.col("at") < rare(2 * a, a + b)).alias("first")), "prefixes")
    mixed = keyed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("first").alias("met"))
    keyed = store(keyed.join(mixed.filter("low < high and met").select("shingle"), "shingle"), "prefixes")
    met = sets.join(keyed.select("node").distinct(), "node", "left_semi")
    keyed = keyed.join(store(sketches(met), "sketches"), "node")
    x, y = keyed.filter("first").alias("x"), keyed.alias("y")
    larger = F.struct("x.size", "x.node") < F.struct("y.size", "y.node")
    meet = (F.col("x.shingle") == F.col("y.shingle")) & larger & (F.col("x.root") != F.col("y.root"))
    both = F.col("x.size") + F.col("y.size")
    enough = (a + b) * F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at")) >= a * both
    words = [F.bit_count(F.col("x.sketch")[i].bitwiseXOR(F.col("y.sketch")[i])) for i in range(SKETCH_BITS // 64)]
    alike = (a + b) * reduce(add, words) <= (b - a) * both
    near = x.join(y, meet & _fit(F.col("x.size"), F.col("y.size")) & enough & alike)
    return near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest ``doc_id``."""
    rows = store(with_bands(docs, F.col("doc_id"), F.xxhash64("text").alias("text_hash")), "sketches")
    classes = rows.groupBy("node").agg(
        F.min(_first("doc_id", "text_hash")).alias("least"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    classes = store(classes, "classes")
    roots = store(components(store(links(docs, classes.select("node", "size", "bands"), rows.select("fp", "node")), "edges")), "roots")
    rooted = classes.select("node", "least").join(roots, "node", "left").select("least", F.coalesce("root", "node").alias("root"))
    return keepers_only(docs, rows, rooted.groupBy("root").agg(F.min("least").alias("first")))
