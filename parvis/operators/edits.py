"""Near matches inside large blocks: edit distances of whole lists of addresses at a time.

A block holds rows of a first and of a second side, all of which are compared. Distances are
bit-parallel (Myers, 1999): one machine word holds a column of the distance table of an address,
and one operation on an array of words moves the columns of all addresses of a tile by one
character. The characters come from the other side's addresses in sorted order, so that what an
address shares with the one before it is not done again; addresses are read from the end where
they share more of their ends, as those of one street do. Where they share little, pairs are
discarded by their characters first, and the columns of the others move pair by pair.

Every distance is exact. Nothing is kept but the rows of one block and the matches of one tile.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks get this module by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = 64
LONGEST = 1024
"""Characters of an address up to which blocks are compared here."""
PATTERNS = 2048
TEXTS = 4096
"""Addresses of either side in a tile."""
STATE_WORDS = 2**21
"""Words of all columns that a tile remembers, one for each depth of the trie."""
HELD_CHARACTERS = 128
"""Characters whose places in a tile are kept."""
PAIRS = 8192
"""Pairs whose columns move at a time."""
SAMPLE = 16
"""Addresses of a tile whose characters are looked at together, and first to tell how many pairs they leave."""
# Rough nanoseconds: a column's move in a row of them and by itself, and the look at two rows' characters.
MOVE, MOVE_ALONE, LOOK = 6.5, 12.0, 6.0
FOUND = 2**18
"""Close addresses that are gathered before their rows are compared."""
ROWS_PER_BATCH = 50_000


@dataclass(frozen=True)
class Rules:
    min_similarity: float
    price_tolerance: float
    surface_gap: float


def characters(texts: Sequence[bytes]) -> list[np.ndarray]:
    """For 64 groups of characters the bits that tell whether a text holds one, two or three of the group, as longs.

    A character counts by its first byte, in UTF-8; digits and signs are apart from letters.
    """
    codes = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    whole = (codes & 0xC0) != 0x80
    groups = (codes + np.where(codes < 64, 16, 0)) % 64
    held = np.bincount(rows[whole] * 64 + groups[whole], minlength=64 * len(texts)).reshape(-1, 64)
    return [np.packbits(held >= n, axis=1, bitorder="little").view(np.int64).ravel() for n in (1, 2, 3)]


class Patterns:
    """Addresses as columns of the distance table, each in the last bits of ``words`` words."""

    def __init__(self, texts: Sequence[str], words: int):
        self.words, self.n = words, len(texts)
        self.lengths = np.fromiter(map(len, texts), np.int64, self.n)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        row = np.repeat(np.arange(self.n), self.lengths)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        bit = words * WORD - self.lengths[row] + place
        order = np.argsort(codes, kind="stable")
        self.codes = codes[order]
        self.at = (bit[order] // WORD, row[order])
        self.bits = np.uint64(1) << (bit[order] % WORD).astype(np.uint64)
        self.start = self._set(slice(None))
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _set(self, which: slice) -> np.ndarray:
        words = np.zeros((self.words, self.n), np.uint64)
        np.bitwise_or.at(words, (self.at[0][which], self.at[1][which]), self.bits[which])
        return words

    def places(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the addresses hold a character, and where they do not."""
        found = self.held.get(code)
        if found is None:
            if len(self.held) >= HELD_CHARACTERS:
                self.held.clear()
            low, high = np.searchsorted(self.codes, (code, code + 1))
            held = self._set(slice(low, high))
            found = self.held[code] = (held, ~held)
        return found


class Trie:
    """Addresses in sorted order, with the number of characters that each shares with the one before.

    ``turned`` tells that they are read from the end.
    """

    def __init__(self, texts: Sequence[str]):
        plain, turned = self._sorted(texts), self._sorted([t[::-1] for t in texts])
        self.turned = turned[0] < plain[0]
        self.moves, self.order, self.wide, self.lengths, self.shared = turned if self.turned else plain
        self.codes, self.n = self.wide.tolist(), len(texts)

    @staticmethod
    def _sorted(texts: Sequence[str]) -> tuple:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        width = int(lengths.max())
        wide = np.array(texts, f"<U{width}")
        order = np.argsort(wide, kind="stable")
        codes, lengths = wide[order].view(np.uint32).reshape(len(texts), width), lengths[order]
        other = codes[1:] != codes[:-1]
        run = np.where(other.any(axis=1), other.argmax(axis=1), width)
        shared = np.concatenate([[0], np.minimum(run, np.minimum(lengths[1:], lengths[:-1]))])
        return int((lengths - shared).sum()), order, codes, lengths.tolist(), shared.tolist()


def close(patterns: Patterns, trie: Trie, slack: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text, patterns, distances) for every text of ``trie``: the patterns within ``slack`` of the longer length.

    The columns keep their upward steps and the complement of their downward ones.
    """
    n, words, depth = patterns.n, patterns.words, max(trie.lengths) + 1
    up = [[np.empty(n, np.uint64) for _ in range(words)] for _ in range(depth)]
    not_down = [[np.empty(n, np.uint64) for _ in range(words)] for _ in range(depth)]
    for w in range(words):
        up[0][w][:] = patterns.start[w]
        not_down[0][w][:] = np.uint64(2**64 - 1)
    h, g, x, lost, gained = [np.empty(n, np.uint64) for _ in range(5)]
    top = np.uint64(WORD - 1)
    both, either, plus, differ, moved = np.bitwise_and, np.bitwise_or, np.add, np.bitwise_xor, np.right_shift
    bounds: dict[int, np.ndarray] = {}
    for text, codes, length, shared in zip(trie.order.tolist(), trie.codes, trie.lengths, trie.shared):
        for d in range(shared, length):
            held, missing = patterns.places(codes[d])
            for w in range(words):
                here, p, q = held[w], up[d][w], not_down[d][w]
                if w:
                    here = either(here, lost)
                both(here, p, h)
                plus(h, p, h)
                differ(h, p, h)
                either(h, here, h)
                either(h, p, g)
                both(g, q, g)  # not a step up along the row
                both(h, p, h)  # a step down along the row
                both(missing[w], q, x)
                if w + 1 < words:
                    next_lost, next_gained = moved(h, top), moved(g, top)
                plus(g, g, g)
                plus(h, h, h)
                if w:
                    either(g, gained, g)
                    either(h, lost, h)
                if w + 1 < words:
                    lost, gained = next_lost, next_gained
                either(g, x, not_down[d + 1][w])
                both(x, g, x)
                either(x, h, up[d + 1][w])
        # Steps down a column add up to its last distance.
        steps = np.bitwise_count(up[length][0])
        steps = steps if words == 1 else steps.astype(np.int32)
        steps += np.bitwise_count(not_down[length][0])
        for w in range(1, words):
            steps += np.bitwise_count(up[length][w])
            steps += np.bitwise_count(not_down[length][w])
        spare = words * WORD - length
        if length not in bounds:
            most = np.floor(slack * np.maximum(patterns.lengths, length) + 1e-9).astype(np.int64) + spare
            bounds[length] = np.clip(most, 0, 255).astype(np.uint8) if words == 1 else most.astype(np.int32)
        found = np.flatnonzero(steps <= bounds[length])
        if len(found):
            yield text, found, steps[found].astype(np.int64) - spare


class Alike:
    """Which pairs of a tile have characters that allow a match: an edit takes at most one away and adds at most one."""

    def __init__(self, texts: Sequence[np.ndarray], text_lengths: np.ndarray, patterns: Sequence[np.ndarray], lengths: np.ndarray, slack: float):
        self.texts, self.patterns = texts, patterns
        self.text_lengths, self.lengths = text_lengths, lengths
        self.text_sizes, self.sizes = [sum(np.bitwise_count(c).astype(np.int16) for c in side) for side in (texts, patterns)]
        self.most = np.floor(slack * np.arange(max(text_lengths.max(), lengths.max()) + 1) + 1e-9).astype(np.int16)

    def of(self, texts: np.ndarray) -> np.ndarray:
        """A row for each of ``texts``, a column for each pattern."""
        common = sum(np.bitwise_count(x[texts][:, None] & y[None]) for x, y in zip(self.texts, self.patterns))
        longest = np.maximum(self.text_lengths[texts][:, None], self.lengths[None])
        return common >= np.maximum(self.text_sizes[texts][:, None], self.sizes[None]) - self.most[longest]


def close_alike(patterns: Patterns, trie: Trie, alike: Alike, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``close`` finds, as columns, for patterns of one word: the columns of pairs that are ``alike`` move one by one."""
    alphabet, index = np.unique(trie.wide, return_inverse=True)
    index = np.ascontiguousarray(index.reshape(trie.wide.shape).T)
    table = np.stack([patterns.places(code)[0][0] for code in alphabet.tolist()]).ravel()
    lengths = np.array(trie.lengths)
    by_length = np.argsort(lengths, kind="stable")
    for length in np.unique(lengths).tolist():
        places = by_length[np.searchsorted(lengths[by_length], length) : np.searchsorted(lengths[by_length], length, "right")]
        for low in range(0, len(places), SAMPLE):
            some = places[low : low + SAMPLE]
            row, column = np.nonzero(alike.of(trie.order[some]))
            for start in range(0, len(row), PAIRS):
                place, pattern = some[row[start : start + PAIRS]], column[start : start + PAIRS]
                up, not_down = patterns.start[0][pattern], np.full(len(pattern), 2**64 - 1, np.uint64)
                for d in range(length):
                    here = table.take(index[d].take(place) * patterns.n + pattern)
                    across = (((here & up) + up) ^ up) | here
                    not_up = (across | up) & not_down
                    across &= up
                    here = ~here
                    here &= not_down
                    not_up += not_up
                    across += across
                    not_down = not_up | here
                    up = (here & not_up) | across
                steps = np.bitwise_count(up) + np.bitwise_count(not_down)
                distance = steps.astype(np.int64) + (length - WORD)
                found = np.flatnonzero(distance <= slack * np.maximum(patterns.lengths[pattern], length) + 1e-9)
                yield trie.order[place[found]], pattern[found], distance[found]


class Side:
    """The rows of one side of a block, those of similar length together and then by number."""

    def __init__(self, rows: pa.Table):
        number = rows.column("row_idx").to_numpy()
        raw = rows.column("address_norm").cast(pa.binary()).to_pylist()
        texts = [t.decode("utf-8", "replace") for t in raw]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        words = -(-lengths // WORD)
        order = np.lexsort((number, words))
        self.texts = [texts[k] for k in order]
        self.number, self.lengths, self.words = number[order], lengths[order], words[order]
        self.characters = [c[order] for c in characters(raw)]
        price = rows.column("asking_price").combine_chunks()
        self.unpriced = price.is_null().to_numpy(zero_copy_only=False)[order]
        self.price = price.fill_null(0).to_numpy(zero_copy_only=False)[order]
        self.surface = rows.column("surface_m2").to_numpy()[order].astype(np.float64)
        self.listing_id = rows.column("listing_id").combine_chunks().take(pa.array(order)) if "listing_id" in rows.column_names else None

    def tiles(self, size: Callable[[int], int]) -> Iterator[slice]:
        """Cuts of up to ``size`` rows whose addresses take as many words each."""
        low = 0
        while low < len(self.texts):
            words = int(self.words[low])
            high = min(low + size(words), int(np.searchsorted(self.words, words, "right")))
            yield slice(low, high)
            low = high


def _may_meet(x: Side, y: Side, s: slice, t: slice, slack: float) -> bool:
    """Whether lengths allow a match of the tiles ``s`` of ``x`` and ``t`` of ``y``."""
    least = 1 - slack - 1e-9
    return x.lengths[s].max() >= least * y.lengths[t].min() and y.lengths[t].max() >= least * x.lengths[s].min()


def _gathered(found: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``close`` finds as columns, about ``FOUND`` rows at a time."""
    held, size = [], 0
    for one in chain(found, [None]):
        if one:
            held.append(one)
            size += len(one[1])
        if size >= FOUND or held and not one:
            texts, patterns, distances = zip(*held)
            yield np.repeat(texts, [len(p) for p in patterns]), np.concatenate(patterns), np.concatenate(distances)
            held, size = [], 0


def _close(many: Side, few: Side, s: slice, t: slice, patterns: Patterns, trie: Trie, slack: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Close addresses of the tiles ``s`` and ``t``, by the way that costs less."""
    if patterns.words == 1:
        sides = [([c[x] for c in side.characters], side.lengths[x]) for side, x in ((few, t), (many, s))]
        alike = Alike(*sides[0], *sides[1], slack)
        left = alike.of(np.linspace(0, trie.n - 1, min(SAMPLE, trie.n)).astype(np.int64)).mean()
        if LOOK + left * MOVE_ALONE * np.mean(trie.lengths) < MOVE * trie.moves / trie.n and len(np.unique(trie.wide)) < STATE_WORDS // PATTERNS:
            return close_alike(patterns, trie, alike, slack)
    return _gathered(close(patterns, trie, slack))


def block_matches(first: Side, second: Side, rules: Rules) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in ``first``, places in ``second``, similarities) of the matches of a block."""
    slack = 1 - rules.min_similarity
    swapped = len(second.texts) > len(first.texts)
    many, few = (second, first) if swapped else (first, second)
    depth = int(few.lengths.max()) + 1
    cuts = list(many.tiles(lambda words: max(1, min(PATTERNS, STATE_WORDS // (2 * depth * words)))))
    made: dict[tuple[int, bool], Patterns] = {}
    for t in few.tiles(lambda words: TEXTS):
        trie = None
        for k, s in enumerate(cuts):
            of_first, of_second = (t, s) if swapped else (s, t)
            if first.number[of_first].min() >= second.number[of_second].max() or not _may_meet(many, few, s, t, slack):
                continue
            trie = trie or Trie(few.texts[t])
            if (k, trie.turned) not in made:
                texts = many.texts[s]
                made[k, trie.turned] = Patterns([x[::-1] for x in texts] if trie.turned else texts, int(many.words[s.start]))
            for at_few, at_many, distance in _close(many, few, s, t, made[k, trie.turned], trie, slack):
                i, j = (at_few + t.start, at_many + s.start) if swapped else (at_many + s.start, at_few + t.start)
                kept = first.number[i] < second.number[j]
                i, j, distance = i[kept], j[kept], distance[kept]
                price, other = first.price[i], second.price[j]
                similarity = 1.0 - distance / np.maximum(first.lengths[i], second.lengths[j])
                kept = (
                    (similarity >= rules.min_similarity)
                    & (np.abs(first.surface[i] - second.surface[j]) <= rules.surface_gap)
                    & (first.unpriced[i] | second.unpriced[j] | (np.abs(price - other) / np.maximum(price, 1) <= rules.price_tolerance))
                )
                yield i[kept], j[kept], similarity[kept]


def _blocks(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of one block after the other."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            here = key[:, low].tolist()
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = here
    if held:
        yield pa.Table.from_batches(held)


def matcher(keys: Sequence[str], rules: Rules) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Work of a task: the matches of blocks that come one after the other.

    Rows have ``keys``, ``is_second``, row_idx, asking_price, surface_m2 and address_norm. Matches have
    i, j and similarity, and with the column listing_id also the zip, ids and prices.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, keys):
            of_second = block.column("is_second")
            if of_second.null_count or len(pc.unique(of_second)) < 2:
                continue
            first, second = [Side(block.filter(pc.equal(of_second, which))) for which in (False, True)]
            for places in block_matches(first, second, rules):
                for low in range(0, len(places[0]), ROWS_PER_BATCH):
                    i, j, similarity = [p[low : low + ROWS_PER_BATCH] for p in places]
                    columns = {"i": pa.array(first.number[i]), "j": pa.array(second.number[j]), "similarity": pa.array(similarity)}
                    if first.listing_id is not None:
                        columns |= {
                            "code_postal": pa.repeat(block.column("code_postal")[0], len(i)),
                            "id_i": first.listing_id.take(pa.array(i)),
                            "id_j": second.listing_id.take(pa.array(j)),
                            "price_i": pa.array(first.price[i], mask=first.unpriced[i]),
                            "price_j": pa.array(second.price[j], mask=second.unpriced[j]),
                        }
                    yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return run
