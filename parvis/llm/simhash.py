"""SimHash near duplicates with pivot distance tables.

Fingerprints of equal value are one class. Each class carries its pivot table: the Hamming
distances to ``N_PIVOTS`` reference fingerprints. Two fingerprints within 3 bits differ by at
most 3 in every coordinate, so pairs whose largest coordinate difference exceeds 3 are
discarded and only survivors are verified bit by bit.

Candidates meet without a cross join: a fingerprint is cut into five parts, and any two within
3 bits agree on at least two of them, so classes are grouped by each of the ten pairs of parts
(about 25 bits). Groups above ``chunk`` classes are cut into chunks, and every pair of chunks
is one work unit. A unit walks its classes: a visited class leaves the unit, so a crowd of near
copies gives a spanning forest instead of all its pairs. Forests are joined by connected
components; no partner is capped.

Texts are lower-cased (A-Z), words split on ASCII white space, shingles have three words;
fewer words make one shingle, none the fingerprint zero. Null text: none. Ids may be null or
repeated; a null id never names a component unless all members are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, look_up, packed, per_row, store, utf8
from .components import components

LIMIT = 3
FILTER_BITS = 26
N_PIVOTS = 16
PARTS = [(0, 13), (13, 26), (26, 39), (39, 52), (52, 64)]


def fingerprint(text: bytes, size: int = 3) -> int:
    """SimHash of one text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    if n == 1:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[:n].tolist()
        stops = (ends[size - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, *keep) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint as a signed long)."""
    rows = docs.select(*keep, utf8("text").alias("body"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t) for t in batch.column("body").to_pylist()], np.uint64).view(np.int64)
            names = [c for c in batch.schema.names if c != "body"]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(fps)], [*names, "fp"])

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")
    return per_row(rows, schema + ", fp long", make)


def pivots() -> list[int]:
    """Reference fingerprints, from a fixed rule."""
    return [xxhash.xxh64_intdigest(str(i), 7) for i in range(N_PIVOTS)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def pivot_table(classes: DataFrame) -> DataFrame:
    """(fp, table): each distinct fingerprint with its distances to all pivots, a byte each."""
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))) for p in pivots()]
    return classes.select("fp", F.unhex(F.concat(*[F.lpad(F.hex(d.cast("long")), 2, "0") for d in distances])).alias("table"))


def _keys() -> F.Column:
    """The ten pairs of parts of ``fp`` as (pair number, bits) longs."""
    masks = [sum(1 << b for part in pair for b in range(*part)) for pair in combinations(PARTS, 2)]
    return F.array(*[F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)])


def forest(fps: np.ndarray, table: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect all links between ``first`` and ``second`` members of one unit.

    A link needs one end in either set; both sets are all members where a unit is one chunk.
    """
    order = np.argsort(table[:, 0], kind="stable")
    fps, table, first, second = fps[order], table[order], first[order], second[order]
    lead = table[:, 0]
    alive, edges = np.ones(len(fps), bool), []
    for seed in range(len(fps)):
        if not alive[seed]:
            continue
        alive[seed], stack = False, [seed]
        while stack:
            x = stack.pop()
            a, b = np.searchsorted(lead, [lead[x] - LIMIT, lead[x] + LIMIT + 1])
            near = a + np.flatnonzero(alive[a:b] & ((first[x] & second[a:b]) | (second[x] & first[a:b])))
            if len(near):
                near = near[np.abs(table[near] - table[x]).max(axis=1) <= LIMIT]
                near = near[np.bitwise_count(fps[near] ^ fps[x]) <= LIMIT]
            if len(near):
                alive[near] = False
                stack += near.tolist()
                edges += [(int(fps[x]), int(fps[y])) for y in near]
    return edges


def _walk(batches: Batches) -> Batches:
    """Edges of all units of one task; units come sorted and one after the other."""
    columns = ["pair", "bits", "low", "high", "fp", "table", "chunk"]
    held: list[pa.RecordBatch] = []

    def flush(rows: pa.Table) -> pa.RecordBatch:
        if not rows.num_rows:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])
        get = {c: rows.column(c).to_numpy() for c in columns if c != "table"}
        table = np.frombuffer(b"".join(rows.column("table").to_pylist()), np.uint8).reshape(-1, N_PIVOTS).astype(np.int16)
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for c in columns[:4]:
            new[1:] |= get[c][1:] != get[c][:-1]
        starts = np.flatnonzero(new)
        edges = []
        for s, e in zip(starts, np.append(starts[1:], rows.num_rows)):
            if e - s > 1:
                fps, chunk = get["fp"][s:e].view(np.uint64), get["chunk"][s:e]
                edges += forest(fps, table[s:e], chunk == get["low"][s], chunk == get["high"][s])
        ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        last = [rows.column(c)[rows.num_rows - 1].as_py() for c in columns[:4]]
        if [batch.column(c)[0].as_py() for c in columns[:4]] == last:
            continue  # one unit so far, at most two chunks long
        tail = np.ones(rows.num_rows, bool)
        for c, v in zip(columns[:4], last):
            tail &= rows.column(c).to_numpy() == v
        cut = int(np.argmax(tail))
        yield flush(rows.slice(0, cut))
        held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield flush(pa.Table.from_batches(held))


def near_edges(classes: DataFrame, chunk: int = 4096) -> DataFrame:
    """(a, b): links that connect every two fingerprints of ``classes`` (fp) within 3 bits."""
    table = store(pivot_table(classes), "pivots")
    keyed = table.withColumn("key", F.explode(_keys())).select("key.pair", "key.bits", "fp", "table")
    sizes = store(keyed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "groups")
    rows = keyed.join(sizes, ["pair", "bits"]).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    # A chunk meets itself and every other one: as (low, high) units.
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    units = rows.withColumn("other", other).select(
        "pair", "bits", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "fp", "table", "chunk"
    )
    unit = ["pair", "bits", "low", "high"]
    return units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_walk, "a long, b long")


def _first(doc_id: str, text_hash: str):
    """Ordering of documents by id, null ids last."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(text_hash).alias("text_hash"))


def classes_and_components(rows: DataFrame, chunk: int = 4096) -> DataFrame:
    """(fp, n, first) of every fingerprint in ``rows`` (doc_id, text_hash, fp).

    ``n`` counts its rows, ``first`` is the document with the smallest ``doc_id`` of the component: id and text_hash.
    """
    least = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(_first("doc_id", "text_hash")).alias("least"))
    least = store(least, "classes")
    roots = store(components(near_edges(least, chunk)), "roots")
    rooted = least.join(roots, least.fp == roots.node, "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.join(smallest, "root").select("fp", "n", "first")


def _fingerprinted(docs: DataFrame) -> DataFrame:
    columns = [F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("at")]
    return store(with_fingerprints(docs, *columns), "fingerprints")


def near_duplicates(docs: DataFrame, chunk: int = 4096, per_slice: int = 20_000) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document."""
    rows = _fingerprinted(docs)
    found = classes_and_components(rows, chunk)
    joined = look_up(rows, store(found, "components"), ["fp"], ["doc_id", "at"], "inner", per_slice)
    return joined.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.id").alias("component_id")
    )


def keep_one(docs: DataFrame, chunk: int = 4096) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest ``doc_id``."""
    rows = _fingerprinted(docs)
    return keepers_only(docs, rows, classes_and_components(rows, chunk))


def _marked(keys: DataFrame, names: list[str]) -> DataFrame:
    """(bucket, bits): a bitmap of 8 MB at most that holds a hash of every row of ``keys``."""
    spots = keys.select((F.pmod(F.xxhash64(*names), F.lit(1 << FILTER_BITS)) + 1).alias("spot"))  # Spark's bitmaps count from 1
    return spots.groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")
    )


def _with_mark(rows: DataFrame, marks: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with ``marked``: true for all keys that ``marks`` holds and for few others."""
    spot = F.pmod(F.xxhash64(*names), F.lit(1 << FILTER_BITS)) + 1
    found = rows.withColumn("bucket", F.bitmap_bucket_number(spot)).withColumn("place", F.bitmap_bit_position(spot))
    found = found.join(F.broadcast(marks), "bucket", "left")
    byte = F.conv(F.hex(F.substr("bits", (F.floor(F.col("place") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod("place", F.lit(8)).cast("int")).bitwiseAND(1)
    return found.withColumn("marked", F.coalesce(bit == 1, F.lit(False))).drop("bucket", "place", "bits")


def keepers_only(docs: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """The documents of ``docs`` that are the ``first`` of a row of ``found``; ``rows`` has their doc_id and text_hash.

    Only documents that may have to go, by a bitmap of the ids that do, are shuffled with their texts.
    """
    keepers = found.select("first.none", F.coalesce("first.id", F.lit(0)).alias("id"), "first.text_hash").distinct()
    own = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id")]
    keys = ["none", "id", "text_hash"]
    counted = rows.select(*own, "text_hash").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.join(keepers.withColumn("first", F.lit(True)), keys, "left").filter("first is null or n > 1")
    marks = store(_marked(counted, keys), "marks")
    dealt = _with_mark(packed(docs, *own, F.xxhash64("text").alias("text_hash")), marks, keys)
    # The window has the keys of the join, so texts are shuffled once.
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row")))
    doubtful = dealt.filter("marked").join(keepers, keys).withColumn("turn", turn).filter("turn = 1")
    return dealt.filter(~F.col("marked")).select("row.*").unionAll(doubtful.select("row.*"))
