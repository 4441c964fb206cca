"""A trie of conversation prefixes, held as balanced parentheses per shard.

Every conversation is rebuilt (the first turns of its family's base, then its own) and becomes
a path of node keys: 128 bits that depend on all turns up to a depth. The steps:

1. Turns are numbered by a sort over ranges of (conv_id, turn, digest) and counts per range,
   so one conversation may have any number of turns. Texts end here; digests and lengths go on.
2. Paths are cut into blocks of ``BLOCK`` depths. Block totals are combined by running XOR, so
   a key needs no more than its own block and one total.
3. Nodes are the distinct keys, merged before their shuffle: members, smallest member, children.
4. Of the conversations that end at a node, the smallest stands for all. These paths, sorted,
   are dealt in ranges to shards. A shard writes its trie as balanced parentheses; range
   min-max blocks over the excess find the close of every open, which delimits the subtree;
   rank counts the leaf pairs in it and a cumulative array gives its savings. Every node's own
   saving enters in one shard only, under its smallest member.
5. Nodes that several shards hold (their shared spines) are merged by adding up.

A path that goes on in a later block stands in its block with a pair that carries what lies
below, so results do not depend on how paths are cut or shards are filled.

A null ``conv_id`` belongs to no conversation and is left out; a null turn comes first, ties of
``turn`` are ordered by the MD5 of role and text, null roles and texts are empty, repeated rows
are turns of their own. An empty table has no nodes, not even the root. Further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, look_up_counted, ordered_turns, per_row, store

BLOCK = 1024
"""Depths of a path that one row holds."""
SHARD_NODES = 1 << 18
"""Parentheses pairs after which a task starts the next trie."""
CHUNK = 1 << 16
"""Bytes of joined ids that one row holds."""
NODE = ["depth", "key"]


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with range min-max blocks over its excess."""

    WIDTH = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1)).astype(np.int64)
        n = -(-len(bits) // self.WIDTH) or 1
        size = 1 << (n - 1).bit_length()
        high = len(bits) + 1
        padded = np.full(size * self.WIDTH, high, np.int64)
        padded[: len(bits)] = self.excess
        self.blocks = padded.reshape(size, self.WIDTH)
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].reshape(-1, 2).min(axis=1))

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The close of each open at ``at``: the first later place whose excess is below the open's."""
        found = np.full(len(at), -1, np.int64)
        for low in range(0, len(at), 4096):
            some = at[low : low + 4096]
            found[low : low + 4096] = self._find(some, self.excess[some] - 1)
        return found

    def _find(self, at: np.ndarray, below: np.ndarray) -> np.ndarray:
        block = at // self.WIDTH
        inside = (self.blocks[block] <= below[:, None]) & (np.arange(self.WIDTH) > (at % self.WIDTH)[:, None])
        found = block * self.WIDTH + inside.argmax(axis=1)
        far = np.flatnonzero(~inside.any(axis=1))
        if len(far):
            block = self._next_block(block[far] + 1, below[far])
            found[far] = block * self.WIDTH + (self.blocks[block] <= below[far, None]).argmax(axis=1)
        return found

    def _next_block(self, node: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The first block from ``node`` on whose minimum is at most ``below``: up the tree, then down."""
        node, level = node.copy(), np.zeros(len(node), np.int64)
        going = np.arange(len(node))
        while len(going):
            least = np.empty(len(going), np.int64)
            for depth in np.unique(level[going]):
                here = level[going] == depth
                least[here] = self.levels[depth][node[going[here]]]
            going = going[least > below[going]]
            node[going] += 1
            while len(up := going[(node[going] & 1 == 0) & (level[going] < len(self.levels) - 1)]):
                node[up] >>= 1
                level[up] += 1
        while len(down := np.flatnonzero(level)):
            level[down] -= 1
            node[down] *= 2
            for depth in np.unique(level[down]):
                here = down[level[down] == depth]
                node[here] += self.levels[depth][node[here]] > below[here]
        return node

    def rank(self, marks: np.ndarray) -> np.ndarray:
        """``rank[i]``: the marks before place i."""
        return np.concatenate(([0], np.cumsum(marks)))


class Shard:
    """Collects sorted paths of one task as parentheses and sums up every subtree."""

    def __init__(self):
        self.steps: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.depths: list[np.ndarray] = []
        self.leaves: list[int] = []
        self.weights: list[tuple[int, int]] = []
        self.n, self.start, self.path = 0, -1, np.empty((0, 2), np.uint64)
        self.stack = np.empty(0, np.int64)

    def _open(self, keys: np.ndarray, first_depth: int) -> None:
        self.steps.append(np.ones(len(keys), bool))
        self.keys.append(keys)
        self.depths.append(np.arange(first_depth, first_depth + len(keys)))
        self.n += len(keys)

    def add(self, start: int, path: np.ndarray, leaf: bool, goes_on: bool, weights: list[tuple[int, int]], after: int) -> None:
        """``weights`` are (depth, saving) of the nodes that this path speaks for, ``after`` the sum of later blocks."""
        shared = 0
        if start == self.start:
            many = min(len(path), len(self.path))
            other = np.flatnonzero((path[:many] != self.path[:many]).any(axis=1))
            shared = int(other[0]) if len(other) else many
        self.steps.append(np.zeros(len(self.stack) - shared, bool))
        self.stack = np.concatenate((self.stack[:shared], np.arange(self.n, self.n + len(path) - shared)))
        self._open(path[shared:], start + shared)
        self.start, self.path = start, path
        self.weights += [(int(self.stack[depth - start]), saving) for depth, saving in weights]
        if goes_on:
            # A pair without a key stands for what lies in later blocks.
            if leaf:
                self.leaves.append(self.n)
            self.weights.append((self.n, after))
            self._open(np.zeros((1, 2), np.uint64), -1)
            self.steps.append(np.zeros(1, bool))
        elif leaf:
            self.leaves.append(int(self.stack[-1]))

    def totals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(depth, key, leaves, savings) of every node."""
        bits = np.concatenate([*self.steps, np.zeros(len(self.stack), bool)])
        tree = Parentheses(bits)
        opens = np.flatnonzero(bits)
        closes = tree.find_close(opens)
        real = np.zeros(self.n, bool)
        real[self.leaves] = True
        pairs = np.zeros(len(bits), bool)
        pairs[opens] = real & ~bits[opens + 1]
        rank = tree.rank(pairs)
        own = np.zeros(self.n, np.int64)
        np.add.at(own, [at for at, _ in self.weights], [saving for _, saving in self.weights])
        saved = np.concatenate(([0], np.cumsum(own)))
        nodes = np.arange(self.n)
        until = nodes + (closes - opens + 1) // 2
        depth = np.concatenate(self.depths)
        kept = depth >= 0
        got = depth, np.concatenate(self.keys), rank[closes] - rank[opens], saved[until] - saved[nodes]
        return tuple(x[kept] for x in got)


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def step_keys(digests: bytes, start: int) -> np.ndarray:
    """Two 64-bit words per turn that depend on its digest and depth; zero for the root."""
    words = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)
    depth = np.arange(start, start + len(words), dtype=np.uint64)
    salt = np.stack((mix(depth * np.uint64(2) + np.uint64(1)), mix(depth * np.uint64(2) + np.uint64(2))), axis=1)
    words = mix(words + salt)
    words[depth == 0] = 0
    return words


def rebuilt(conversations: DataFrame, family: int, most: int) -> DataFrame:
    """(conv_id, depth, length, digest, n_chars): the rebuilt turns below a root turn at depth 0."""
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    turns = ordered_turns(conversations.filter("conv_id is not null"), n_chars)
    rows = store(turns.select("conv_id", "digest", "n_chars", F.monotonically_increasing_id().alias("at")), "turns")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    runs = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = store(
        runs.withColumns({"before": F.coalesce(F.sum("n").over(before), F.lit(0)), "total": F.sum("n").over(whole)}), "runs"
    )
    place = F.col("before") + F.col("at") - F.col("first")
    heads = (
        rows.filter(F.col("conv_id") % family == 0)
        .join(runs.filter(F.col("before") < most), ["conv_id", "part"])
        .filter(place < most - 1)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "digest", "n_chars"))).alias("head"))
    )
    wanted = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = (
        runs.filter("before = 0")
        .select("conv_id", "total", wanted.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
        .join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int")))
    )
    given = F.size("head").cast("long")
    convs = convs.withColumns({"given": given, "length": given + F.greatest(F.col("total") - F.col("h"), F.lit(0))})
    convs = store(convs.select("conv_id", "h", "given", "length", "head"), "conversations")
    nothing = F.lit(bytes(16)).alias("digest")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", nothing, F.lit(0).cast("long").alias("n_chars"))
    given = convs.select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.place") + 1).alias("depth"), "length", "t.digest", "t.n_chars"
    )
    plan = runs.join(convs.select("conv_id", "h", "given", "length"), "conv_id")
    own = (
        rows.join(plan, ["conv_id", "part"])
        .filter(place >= F.col("h"))
        .select("conv_id", (place - F.col("h") + F.col("given") + 1).alias("depth"), "length", "digest", "n_chars")
    )
    return roots.unionAll(given).unionAll(own)


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: ``parent`` key, keys of its nodes (``path``) and text lengths; written."""
    block = F.floor(F.col("depth") / BLOCK).alias("block")
    listed = F.sort_array(F.collect_list(F.struct("depth", "digest", "n_chars")))
    blocks = turns.groupBy("conv_id", block).agg(F.max("length").alias("length"), listed.alias("t"))
    digests = F.array_join(F.transform("t.digest", F.hex), "")
    flat = blocks.select("conv_id", "block", "length", F.unhex(digests).alias("digests"), F.col("t.n_chars").alias("chars"))

    def totals():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sums = [
                np.bitwise_xor.reduce(step_keys(d, b * BLOCK), axis=0).view(np.int64)
                for d, b in zip(batch.column("digests").to_pylist(), batch.column("block").to_pylist())
            ]
            columns = [*batch.columns, *[pa.array([int(s[i]) for s in sums], pa.int64()) for i in (0, 1)]]
            return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "x", "y"])

        return work

    plain = "conv_id {}, block long, length long, digests binary, chars array<long>".format(turns.schema["conv_id"].dataType.simpleString())
    summed = store(per_row(flat, f"{plain}, x long, y long", totals), "blocks")
    # Conversations of one block need no running total.
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = summed.filter(F.col("length") >= BLOCK).select(
        "conv_id", "block", F.bit_xor("x").over(before).alias("bx"), F.bit_xor("y").over(before).alias("by")
    )
    joined = summed.drop("x", "y").join(later.filter("block > 0"), ["conv_id", "block"], "left")

    def keys():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, above = [], []
            fields = [batch.column(c).to_pylist() for c in ("digests", "block", "bx", "by")]
            for digests, block, x, y in zip(*fields):
                parent = np.array([x or 0, y or 0], np.int64).view(np.uint64)
                path = np.bitwise_xor.accumulate(step_keys(digests, block * BLOCK), axis=0) ^ parent
                found.append(path.astype(">u8").tobytes())
                above.append(parent.astype(">u8").tobytes())
            columns = [batch.column("conv_id"), batch.column("block"), batch.column("length"), batch.column("chars")]
            columns += [pa.array(above, pa.binary()), pa.array(found, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "block", "length", "chars", "parent", "path"])

        return work

    schema = plain.replace("digests binary, ", "") + ", parent binary, path binary"
    return store(per_row(joined, schema, keys), "paths")


def _binary(keys: np.ndarray) -> pa.Array:
    """Rows of two words as 16-byte values."""
    data = pa.py_buffer(keys.astype(">u8").tobytes())
    offsets = pa.py_buffer((np.arange(len(keys) + 1) * 16).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, data])


def visits(found: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, n_chars, ends): every node of every path."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            fields = [batch.column(c).to_pylist() for c in ("block", "length", "parent", "path")]
            keys, parents, depths, ends, many = [], [], [], [], []
            for block, length, parent, path in zip(*fields):
                words = np.frombuffer(parent + path, ">u8").reshape(-1, 2)
                keys.append(words[1:])
                parents.append(words[:-1])
                depth = block * BLOCK + np.arange(len(words) - 1)
                depths.append(depth)
                ends.append(depth == length)
                many.append(len(depth))
            who = batch.column("conv_id").take(pa.array(np.repeat(np.arange(batch.num_rows), many)))
            columns = [
                who,
                pa.array(np.concatenate(depths)),
                _binary(np.concatenate(keys)),
                _binary(np.concatenate(parents)),
                batch.column("chars").flatten(),
                pa.array(np.concatenate(ends)),
            ]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "depth", "key", "parent", "n_chars", "ends"])

        return work

    conv = found.schema["conv_id"].dataType.simpleString()
    return per_row(found, f"conv_id {conv}, depth long, key binary, parent binary, n_chars long, ends boolean", make)


def ends_digests(seen: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256) of the nodes at which conversations end.

    Ids are sorted over ranges of (node, id) and joined there to texts of bounded size, so the
    one task that must hash a node's ids in order reads few rows, one after the other.
    """
    keys = [*NODE, "conv_id"]
    rows = seen.filter("ends").select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def join(batches: Batches) -> Batches:
        part, nth = TaskContext.get().partitionId(), 0
        at, ids, size = None, [], 0
        names = ["depth", "key", "part", "nth", "ids"]

        def row() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            values = [*at, part, nth, ",".join(ids).encode()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)

        done: list[pa.RecordBatch] = []
        for batch in batches:
            for depth, key, conv in zip(*[batch.column(c).to_pylist() for c in ("depth", "key", "conv_id")]):
                if at != (depth, key) or size > CHUNK:
                    if at is not None:
                        done.append(row())
                        nth += 1
                    at, ids, size = (depth, key), [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if len(done) > 500:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if at is not None:
            done.append(row())
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]

    chunks = rows.mapInArrow(join, "depth long, key binary, part long, nth long, ids binary")
    chunks = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "part", "nth")

    def digest(batches: Batches) -> Batches:
        at, hashed = None, None
        for batch in batches:
            done = []
            for depth, key, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "key", "ids")]):
                if at == (depth, key):
                    hashed.update(b"," + ids)
                    continue
                if at is not None:
                    done.append((*at, hashed.hexdigest()))
                at, hashed = (depth, key), hashlib.sha256(ids)
            if done:
                yield _digests(done)
        if at is not None:
            yield _digests([(*at, hashed.hexdigest())])

    return chunks.mapInArrow(digest, "depth long, key binary, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    depth, key, sha = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(depth, pa.int64()), pa.array(key, pa.binary()), pa.array(sha)], ["depth", "key", "ends_sha256"]
    )


def subtree_totals(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, key, n_leaves, saved_tokens), from the parentheses of all shards."""
    stand_in = nodes.filter("first_end is not null").select(
        F.col("first_end").alias("conv_id"), (F.col("n_children") == 0).alias("leaf")
    )
    saving = (F.col("n_convs") - 1) * F.col("n_chars")
    own = (
        nodes.filter(saving > 0)
        .groupBy("conv_id", F.floor(F.col("depth") / BLOCK).alias("block"))
        .agg(F.collect_list(F.struct("depth", saving.alias("saving"))).alias("weights"), F.sum(saving).alias("sum"))
    )
    own = store(own, "savings")
    rows = found.join(stand_in, "conv_id").join(own.drop("sum"), ["conv_id", "block"], "left")
    # What lies in later blocks, for conversations of several blocks.
    long = found.filter(F.col("length") >= BLOCK).select("conv_id", "block").join(own.drop("weights"), ["conv_id", "block"], "left")
    behind = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    after = long.select("conv_id", "block", F.sum("sum").over(behind).alias("after"))
    rows = rows.join(after, ["conv_id", "block"], "left").select(
        "conv_id", "block", "length", "leaf", "path", "weights", F.coalesce("after", F.lit(0)).cast("long").alias("after")
    )
    dealt = rows.repartitionByRange("block", F.substring("path", 1, 128), "conv_id").sortWithinPartitions("block", "path")

    def run(batches: Batches) -> Batches:
        shard = Shard()
        for batch in batches:
            fields = [batch.column(c).to_pylist() for c in ("block", "length", "leaf", "path", "weights", "after")]
            for block, length, leaf, path, weights, after in zip(*fields):
                words = np.frombuffer(path, ">u8").astype(np.uint64).reshape(-1, 2)
                start = block * BLOCK
                pairs = [(w["depth"], w["saving"]) for w in weights or ()]
                shard.add(start, words, leaf, start + len(words) <= length, pairs, after)
                if shard.n > SHARD_NODES:
                    yield from _totals(shard)
                    shard = Shard()
        if shard.n:
            yield from _totals(shard)

    local = dealt.mapInArrow(run, "depth long, key binary, n_leaves long, saved_tokens long")
    return local.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _totals(shard: Shard) -> Iterator[pa.RecordBatch]:
    depth, keys, leaves, saved = shard.totals()
    for low in range(0, len(depth), 20_000):
        part = slice(low, low + 20_000)
        columns = [pa.array(depth[part]), _binary(keys[part]), pa.array(leaves[part].astype(np.int64)), pa.array(saved[part])]
        yield pa.RecordBatch.from_arrays(columns, ["depth", "key", "n_leaves", "saved_tokens"])


def prefix_trie(conversations: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c takes its first ``h = crc32(c) % most`` turns from conversation
    ``c - c % family`` and goes on with its own turns after its first h.
    """
    found = paths(rebuilt(conversations, family, most))
    seen = visits(found)
    nodes = seen.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.any_value("parent").alias("parent"),
        F.any_value("n_chars").alias("n_chars"),
        F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("first_end"),
    )
    nodes = store(nodes, "nodes")
    children = (
        nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = store(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "tree")
    done = nodes.join(subtree_totals(found, nodes), NODE).join(ends_digests(seen), NODE, "left")
    above = nodes.filter("n_children > 0").select(
        F.col("depth").alias("above"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n")
    )
    done = look_up_counted(done.withColumn("above", F.col("depth") - 1), above, ["above", "parent"], ["key"])
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return done.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256")
    )
