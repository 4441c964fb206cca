"""Near duplicates: the blocked self-join that finds them.

Two listings match when they share a zip, their surfaces and prices are close, and their
addresses are similar. Surfaces and prices become bins whose neighbours cover every match,
so the join is an equality join on (zip, surface bin, price bin). Each pair meets under
exactly one key: the first side is copied to the neighbouring surface bins, the second to
the neighbouring price bins, or the first to both where it is much the smaller (``few_first``).
A missing price matches any price; it has keys of its own.

Blocks that stay large also need a common rare trigram, where their counted trigrams say that
this spares more comparisons than it costs. That loses nothing: ``k`` edits change at most
``3 k`` trigrams, so the ``3 k + 1`` rarest of two matching addresses meet. Other large blocks
are cut into a grid of slices.

Where all matches of a table with itself are asked for, blocks that are not tiny are compared by
whole lists of addresses instead (``edits``), which needs neither.

Before any distance is computed, pairs are discarded by their characters: an edit takes at most
one away and adds at most one.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import DEFAULTS, Options
from ..session import cut_lineage
from . import edits
from .edits import characters

# Tasks get this module by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL = ["code_postal", "surface_bin", "price_key"]
MATCH = ["code_postal", "i", "j", "id_i", "id_j", "price_i", "price_j", "similarity"]
NARROW = ["i", "j", "similarity"]
# Keys under which a missing price on the first or on the second side meets the other side.
FIRST_UNPRICED = -(2**60)
SECOND_UNPRICED = FIRST_UNPRICED + 1
# About a second of work.
COMPARISONS_PER_TASK = 500_000
DENSE_COMPARISONS_PER_TASK = 64_000_000
DENSE_GAIN = 40.0
"""Comparisons of whole lists of addresses in the time of one of the join."""
MOST_TASKS = 50_000
SLICE_ROWS = 2048
"""Rows of either side in a slice of a large block."""
DENSE_SLICE_ROWS = 16_384
"""The same where whole lists of addresses are compared."""


def _price_bin(price: Column, o: Options) -> Column:
    """Logarithmic bin; a match is at most one bin away. Prices up to 0 only match themselves."""
    step = -math.log(1 - o.price_tolerance) * (1 + 1e-9)
    return F.when(price >= 1, F.floor(F.ln(price.cast("double")) / step)).otherwise(price - 10).cast("bigint")


def _longs(*values) -> Column:
    return F.array(*[(v if isinstance(v, Column) else F.lit(v)).cast("bigint") for v in values])


def _cells(rows: DataFrame, o: Options, first: bool, few_first: bool = False) -> DataFrame:
    """``rows`` once per cell they look for (first side) or lie in (second side).

    The neighbouring price bins are the second side's, or with ``few_first`` the first side's.
    """
    price = F.col("asking_price")
    surface_bin = F.floor(F.col("surface_m2") / o.surface_gap)
    price_bin = _price_bin(price, o)
    bins = [price_bin - 1, price_bin, price_bin + 1] if first == few_first else [price_bin]
    if first:
        surfaces = F.sequence(surface_bin - 1, surface_bin + 1)
        prices = F.when(price.isNull(), _longs(FIRST_UNPRICED)).otherwise(_longs(*bins, SECOND_UNPRICED))
    else:
        surfaces = F.array(surface_bin)
        prices = F.when(price.isNull(), _longs(FIRST_UNPRICED, SECOND_UNPRICED)).otherwise(_longs(*bins, FIRST_UNPRICED))
    comparable = (
        F.col("code_postal").isNotNull() & F.col("surface_m2").isNotNull() & (F.col("address_norm") != "")
    )
    return (
        rows.filter(comparable)
        .withColumn("surface_bin", F.explode(surfaces))
        .withColumn("price_key", F.explode(prices))
    )


def _cell_sizes(first: DataFrame, second: DataFrame, o: Options, keys: Sequence[str], few_first: bool = False) -> DataFrame:
    """Rows of either side per cell, with the flags ``hot``, ``lonely`` and ``dense``.

    Hot cells hold more than ``hot_cell_rows`` squared comparisons. Lonely ones are large but
    have rows of one side only, so nothing can match there. Dense ones suit ``edits``.
    """
    one, none, length = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.length("address_norm").alias("length")
    sides = [
        _cells(first, o, True, few_first).select(*keys, one.alias("n1"), none.alias("n2"), length),
        _cells(second, o, False, few_first).select(*keys, none.alias("n1"), one.alias("n2"), length),
    ]
    sums = F.sum("n1").alias("n1"), F.sum("n2").alias("n2"), F.max("length").alias("longest")
    counted = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*sums)
    comparisons = F.col("n1").cast("double") * F.col("n2")
    return counted.select(
        *keys,
        "n1",
        "n2",
        comparisons.alias("comparisons"),
        (comparisons > float(o.hot_cell_rows) ** 2).alias("hot"),
        ((comparisons == 0) & (F.col("n1") + F.col("n2") > o.hot_cell_rows)).alias("lonely"),
        ((comparisons > float(o.dense_cell_rows) ** 2) & (F.col("longest") <= edits.LONGEST)).alias("dense"),
    )


def crowded_cells(
    first: DataFrame, second: DataFrame, o: Options = DEFAULTS, more_keys: Sequence[str] = (), few_first: bool = False, own: bool = False
) -> DataFrame:
    """Large cells, of a table with itself (``own``) the dense ones too."""
    sizes = _cell_sizes(first, second, o, [*CELL, *more_keys], few_first)
    return sizes.withColumn("dense", F.col("dense") & F.lit(own)).filter(F.col("hot") | F.col("lonely") | F.col("dense"))


@dataclass(frozen=True)
class Load:
    """What a join of two sides amounts to."""

    comparisons: float
    n_hot: int
    n_lonely: int
    n_dense: int = 0


def zip_loads(
    first: DataFrame, second: DataFrame, o: Options = DEFAULTS, more_keys: Sequence[str] = (), few_first: bool = False
) -> DataFrame:
    """What the join of two sides amounts to in each zip."""
    return _cell_sizes(first, second, o, [*CELL, *more_keys], few_first).groupBy("code_postal").agg(
        F.sum("comparisons").alias("comparisons"), *[F.count_if(c).alias(f"n_{c}") for c in ("hot", "lonely", "dense")]
    )


def total(loads: DataFrame) -> Load:
    """Sums of ``zip_loads``, by one job."""
    names = ("comparisons", "n_hot", "n_lonely", "n_dense")
    row = loads.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    return Load(*row)


def measure(
    first: DataFrame, second: DataFrame, o: Options = DEFAULTS, more_keys: Sequence[str] = (), few_first: bool = False
) -> Load:
    """Counts the cells, by one job."""
    return total(zip_loads(first, second, o, more_keys, few_first))


def _trigrams(text: Column) -> Column:
    """All trigrams of the padded text, repeats told apart by their count so far."""
    pad = F.lit("\x01\x01")
    padded = F.concat(pad, text, pad)
    plain = F.transform(F.sequence(F.lit(1), F.length(text) + 2), lambda i: F.substring(padded, i, F.lit(3)))
    return F.transform(
        plain, lambda g, at: F.xxhash64(g, F.size(F.filter(F.slice(plain, F.lit(1), at + 1), lambda x: x == g)))
    )


def _count_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every batch with ``characters``."""
    for batch in batches:
        bits = characters([t or b"" for t in batch.column("address_norm").cast(pa.binary()).to_pylist()])
        held = pa.StructArray.from_arrays([pa.array(b) for b in bits], ["n1", "n2", "n3"])
        yield pa.RecordBatch.from_arrays([*batch.columns, held], [*batch.schema.names, "characters"])


def with_characters(rows: DataFrame) -> DataFrame:
    """``rows`` with ``characters``, unless they have it: for 64 groups of characters whether the
    address holds one, two or three of the group, a long each. An edit sets and clears at most one bit.
    """
    if "characters" in rows.columns:
        return rows
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_count_characters, f"{fields}, characters struct<n1:bigint,n2:bigint,n3:bigint>")


def _rarest_trigrams(addresses: DataFrame, o: Options) -> DataFrame:
    """(address_norm, grams): for each address the trigrams one of which any match shares.

    ``addresses`` has a row for every listing.
    """
    counted = addresses.groupBy("address_norm").agg(F.count(F.lit(1)).alias("n"))
    grams = counted.select("address_norm", "n", F.explode(_trigrams(F.col("address_norm"))).alias("gram"))
    # Weighed by rows: one address held by a crowd makes its grams common.
    frequency = grams.groupBy("gram").agg(F.sum("n").alias("seen"))
    # A match is at most 1 / min_similarity times as long as the address.
    edits = F.floor(F.length("address_norm") * ((1 - o.min_similarity) / o.min_similarity) + 1e-9)
    rare_first = F.sort_array(F.collect_list(F.struct("seen", "gram")))
    ranked = grams.join(frequency, "gram").groupBy("address_norm").agg(rare_first.alias("ranked"))
    kept = F.slice("ranked", F.lit(1), (3 * edits + 1).cast("int"))
    return ranked.select("address_norm", F.transform(kept, lambda g: g["gram"]).alias("grams"))


def _sifted_cells(sides: list[DataFrame], large: DataFrame, o: Options, keys: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
    """The ``large`` cells whose rows are better joined by their rare trigrams, and these by address.

    Whether they are is counted: comparisons under each trigram, and a price for keying the rows.
    """
    cost = float(o.trigram_row_cost) * (F.col("n1") + F.col("n2"))
    # In comparisons of the join; those of whole lists are cheaper.
    weighed = large.withColumn("spent", F.col("comparisons") / F.when(F.col("dense"), DENSE_GAIN).otherwise(1))
    hopeful = cut_lineage(weighed.filter(F.col("hot") & (F.col("spent") > cost)).select(*keys, "comparisons", "spent", cost.alias("cost")))
    if hopeful.isEmpty():
        return None
    inside = [side.join(hopeful.select(*keys), list(keys), "left_semi").select(*keys, "address_norm") for side in sides]
    rarest = cut_lineage(_rarest_trigrams(inside[0].select("address_norm").union(inside[1].select("address_norm")), o))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    keyed = [side.join(rarest, "address_norm").select(*keys, F.explode("grams").alias("gram")) for side in inside]
    counted = keyed[0].select("*", one.alias("g1"), none.alias("g2")).unionByName(keyed[1].select("*", none.alias("g1"), one.alias("g2")))
    met = counted.groupBy(*keys, "gram").agg(F.sum("g1").alias("g1"), F.sum("g2").alias("g2"))
    shared = met.groupBy(*keys).agg(F.sum(F.col("g1").cast("double") * F.col("g2")).alias("shared"))
    spared = hopeful.join(shared, list(keys), "left").filter(F.coalesce("shared", F.lit(0.0)) + F.col("cost") < F.col("spent"))
    return cut_lineage(spared.select(*keys, "comparisons")), rarest


def _with_slices(rows: DataFrame, first: bool, slice_rows: int) -> DataFrame:
    """``rows`` of a side with the slices ``at_i`` and ``at_j``; each is in one of its own side and copied along the other's.

    ``n1`` and ``n2`` are the rows of its cell, null where that is not large.
    """
    own, other, n_own, n_other = ("at_i", "at_j", "n1", "n2") if first else ("at_j", "at_i", "n2", "n1")
    last = {n: F.coalesce(F.floor(F.col(n) / slice_rows), F.lit(0)).cast("bigint") for n in (n_own, n_other)}
    dealt = rows.withColumn(own, F.pmod(F.xxhash64("row_idx"), last[n_own] + 1))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), last[n_other])))


def _hinted(cells: DataFrame, n: int, o: Options) -> DataFrame:
    """A table of ``n`` cells, for a broadcast where that is safe."""
    return F.broadcast(cells) if n <= o.broadcast_rows else cells


def near_pairs(
    first: DataFrame,
    second: DataFrame,
    o: Options = DEFAULTS,
    load: Load | None = None,
    more_keys: Sequence[str] = (),
    of_second: Sequence[str] = (),
    only: Column | None = None,
    few_first: bool = False,
    narrow: bool = False,
) -> DataFrame:
    """All matches (i, j) with i from ``first`` before j from ``second``, and equal ``more_keys``.

    Inputs hold row_idx, listing_id, address_norm, surface_m2, code_postal, asking_price. The
    price test is relative to the earlier listing. Blocks are counted first, by a job, unless
    the caller has measured them (``load``). Columns ``of_second`` are carried along. ``only``
    keeps some of the matches, by their rows; it is asked before addresses are compared.
    ``few_first`` tells that ``first`` is much the smaller. ``narrow`` asks for i, j and similarity only.
    """
    own = first is second and only is None and not (more_keys or of_second or few_first)
    load = load or measure(first, second, o, more_keys, few_first)
    keys = [*CELL, *more_keys]
    named = with_characters(first), with_characters(second)
    sides = [_cells(rows, o, is_first, few_first) for rows, is_first in zip(named, (True, False))]
    if not load.n_hot and not (own and load.n_dense):
        pairs = _matches(sides, keys, o, load.comparisons, of_second, only)
        return pairs.select(*NARROW) if narrow else pairs
    large = cut_lineage(crowded_cells(first, second, o, more_keys, few_first, own))
    found = _sifted_cells(sides, large, o, keys)
    lists, comparisons = [], load.comparisons
    if own and load.n_dense:
        dense = large.filter("dense")
        dense = cut_lineage(dense.join(found[0], keys, "left_anti") if found else dense)
        large = large.filter("not dense")
        in_dense = dense.agg(F.coalesce(F.sum("comparisons"), F.lit(0.0))).first()[0]
        comparisons -= in_dense
        lists = [_dense_matches(first, dense, in_dense, o, load, narrow)]
        sides = [side.join(_hinted(dense.select(*keys), load.n_dense, o), keys, "left_anti") for side in sides]

    def flagged(side: DataFrame, cells: DataFrame, how: str) -> DataFrame:
        """The large side of the join is on the left, where an adaptive plan splits a key of very many rows."""
        return side.join(_hinted(cells, load.n_hot + load.n_lonely, o), keys, how)

    cells = large.select(*keys, "n1", "n2", "lonely")
    plain = [flagged(side, cells, "left").filter(F.col("lonely").isNull() | ~F.col("lonely")) for side in sides]
    if found:
        plain = [flagged(side, found[0].select(*keys), "left_anti") for side in plain]
        comparisons -= found[0].agg(F.coalesce(F.sum("comparisons"), F.lit(0.0))).first()[0]
    plain = [_with_slices(side, is_first, SLICE_ROWS) for side, is_first in zip(plain, (True, False))]
    lists.append(_matches(plain, [*keys, "at_i", "at_j"], o, comparisons, of_second, only))
    if found:
        # ``grams`` keeps all of a row's keys, by which a pair is told to meet under one of them.
        keyed = [flagged(side, found[0].select(*keys), "left_semi").join(found[1], "address_norm").withColumn("gram", F.explode("grams")) for side in sides]
        lists.append(_matches(keyed, [*keys, "gram"], o, None, of_second, only))
    return reduce(DataFrame.unionByName, [pairs.select(*NARROW) if narrow else pairs for pairs in lists])


def _dense_matches(rows: DataFrame, dense: DataFrame, comparisons: float, o: Options, load: Load, narrow: bool) -> DataFrame:
    """The matches of ``rows`` with themselves in ``dense`` cells, by whole lists of addresses."""
    cells = dense.select(*CELL, "n1", "n2")
    columns = ["row_idx", "asking_price", "surface_m2", "address_norm", *([] if narrow else ["listing_id"])]
    keys = [*CELL, "at_i", "at_j"]

    def side(first: bool) -> DataFrame:
        held = _cells(rows.filter(F.col("row_idx").isNotNull()), o, first).select(*CELL, *columns)
        held = held.join(_hinted(cells, load.n_dense, o), CELL)
        return _with_slices(held, first, DENSE_SLICE_ROWS).select(*keys, *columns, F.lit(not first).alias("is_second"))

    tasks = min(MOST_TASKS, math.ceil(comparisons / DENSE_COMPARISONS_PER_TASK))
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = side(True).unionByName(side(False)).repartition(max(tasks, usual), *keys).sortWithinPartitions(*keys)
    rules = edits.Rules(o.min_similarity, o.price_tolerance, o.surface_gap)
    fields = "i bigint, j bigint, similarity double"
    if narrow:
        return dealt.mapInArrow(edits.matcher(keys, rules), fields)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}["code_postal"]
    more = f", code_postal {kind}, id_i string, id_j string, price_i bigint, price_j bigint"
    return dealt.mapInArrow(edits.matcher(keys, rules), fields + more).select(*MATCH)


def _matches(
    sides: list[DataFrame], keys: Sequence[str], o: Options, comparisons: float | None, of_second: Sequence[str], only: Column | None
) -> DataFrame:
    """The matches of two sides that meet under equal ``keys``, under the least common one of their trigrams.

    ``comparisons`` tells the tasks that the join calls for; None leaves them to the adaptive plan.
    """
    sifted = "gram" in keys
    more = ["grams"] if sifted else []
    names = {"row_idx": "", "listing_id": "id_", "asking_price": "price_", "surface_m2": "surface_", "address_norm": "address_", "characters": "characters_"}
    left, right = [
        side.select(
            *keys,
            *[F.col(c).alias(prefix + which) for c, prefix in names.items()],
            F.length("address_norm").alias(f"length_{which}"),
            *[F.col(c).alias(f"{c}_{which}") for c in more],
            *(of_second if which == "j" else ()),
        )
        for side, which in zip(sides, ("i", "j"))
    ]
    if comparisons is not None:
        # No key is large, and comparing is costlier than its input suggests: as many tasks
        # as the comparisons call for. Where these are few, the rows tell.
        tasks = min(MOST_TASKS, math.ceil(comparisons / COMPARISONS_PER_TASK))
        usual = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = [tasks, *keys] if tasks > usual else keys
        left, right = left.repartition(*dealt), right.repartition(*dealt)
    c = F.col
    longest, shortest = F.greatest("length_i", "length_j"), F.least("length_i", "length_j")
    close_price = (
        c("price_i").isNull()
        | c("price_j").isNull()
        | (F.abs(c("price_i") - c("price_j")) / F.greatest(c("price_i"), F.lit(1)) <= o.price_tolerance)
    )
    # The distance stops counting just above the largest one that can pass and is then -1,
    # which pmod turns into a distance that cannot pass.
    slack = 1 - o.min_similarity
    distance = F.expr(
        "pmod(levenshtein(address_i, address_j, "
        f"cast(floor({slack!r}d * greatest(length_i, length_j)) + 1 as int)), 1 << 30)"
    )
    similarity = 1.0 - distance / longest

    def lost(of: str, other: str) -> Column:
        """At most as many as the characters that ``of`` has and ``other`` lacks."""
        return reduce(add, [F.bit_count(c(f"{of}.n{n}").bitwiseAND(F.bitwise_not(c(f"{other}.n{n}")))) for n in (1, 2, 3)])

    most = slack * longest + 1e-9
    # From cheap to costly tests.
    joined = (
        left.join(right, keys)
        .filter(c("i") < c("j"))
        .filter(F.abs(c("surface_i") - c("surface_j")) <= o.surface_gap)
        .filter(close_price)
        .filter(longest - shortest <= most)
        .filter(lost("characters_i", "characters_j") <= most)
        .filter(lost("characters_j", "characters_i") <= most)
    )
    if only is not None:
        joined = joined.filter(only)
    if sifted:
        # Of the grams that both rows are keyed by, only the least lets them meet.
        joined = joined.filter(c("gram") == F.array_min(F.array_intersect("grams_i", "grams_j")))
    return (
        joined
        .filter(similarity >= o.min_similarity)
        .withColumn("similarity", similarity)
        .select(*MATCH, *of_second)
    )
