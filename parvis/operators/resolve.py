"""Near duplicates: which listing of which match goes.

The rule is sequential. Listings take their turn in row order. One that is already flagged
is passed over. Otherwise it is compared with every later, unflagged match; the dearer of
the two is flagged, the later one on a tie, and the turn goes on even when its own listing
was flagged. A match changes nothing outside its zip, nor outside its component of matches.

So turns are replayed over the matches of whole zips, or of whole components where a zip has
too many for one task, in as few jobs for a chain of any length as for a pair. Only zips with
large blocks, where matches may be all pairs of a crowd, are resolved in another way.

Call i a *dominator* of a later match j if j is not cheaper. Then, without replaying turns:

* i takes its turn exactly when no dominator of i took its own. Everything that was passed
  over was removed by its first dominator that took a turn.
* A listing that took its turn is removed by its first later match that is cheaper (or
  where a price is missing) and that no earlier turn had flagged by then.

The first is settled in growing rounds: each first drops what earlier turns
dominate, so that a crowd meets the few that took a turn and not itself. The second looks
ahead over growing windows of the row order and stops at the first hit, so that a crowd whose
later copies are all cheaper or unpriced is left after a few steps each. Both keep one row per
listing, never the pairs.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import DEFAULTS, Options
from ..session import cut_lineage
from .components import components
from .near import Load, measure, near_pairs, total, with_characters, zip_loads
from .running import running_totals

# Tasks get this module by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOG = ["removed_idx", "removed_id", "kept_idx", "kept_id", "price_removed", "price_kept", "similarity"]
LOOK_AHEAD = 16
"""How many times longer each window is than the one before."""
GROWTH = 4
"""How many times more rows each round has behind it than the one before."""
FIRST_ROUND_WORK = 4
"""Comparisons of the first round, in those of a crowd of ``first_round_rows`` rows with itself."""
COMPARISONS_PER_MATCH = 20
"""Comparisons of a zip, for each match that a task may replay, up to which all its matches are listed."""


def _dominates() -> Column:
    return F.coalesce(F.col("price_i") <= F.col("price_j"), F.lit(False))


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logged removals of units that come one after the other, each in turn order."""
    unit = turn = None
    passed, flagged = False, set()
    for batch in batches:
        log = []
        columns = ["unit", "i", "j", "id_i", "id_j", "price_i", "price_j", "similarity"]
        for here, i, j, id_i, id_j, price_i, price_j, similarity in zip(*[batch.column(c).to_pylist() for c in columns]):
            if here != unit:
                unit, turn, flagged = here, None, set()
            if i != turn:
                turn, passed = i, i in flagged
            if passed or j in flagged:
                continue
            later_goes = price_i is not None and price_j is not None and price_i <= price_j
            gone = (j, id_j, i, id_i, price_j, price_i) if later_goes else (i, id_i, j, id_j, price_i, price_j)
            if gone[0] not in flagged:
                flagged.add(gone[0])
                log.append((*gone, similarity))
        if log:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*log), kinds)], LOG)


def replay(pairs: DataFrame) -> DataFrame:
    """The removals (LOG) that the turns make in every ``unit`` of ``pairs``."""
    dealt = pairs.repartition("unit").sortWithinPartitions("unit", "i", "j")
    longs = [F.col(c).cast("bigint").alias(c) for c in ("unit", "i", "j", "price_i", "price_j")]
    schema = "removed_idx long, removed_id string, kept_idx long, kept_id string, price_removed long, price_kept long, similarity double"
    return dealt.select(*longs, "id_i", "id_j", "similarity").mapInArrow(_replay, schema)


def _without_giants(pairs: DataFrame, o: Options) -> tuple[DataFrame, DataFrame | None]:
    """``pairs`` of units that a task can replay, and those of the others."""
    sizes = pairs.groupBy("unit").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > o.replay_pairs)
    giants = cut_lineage(sizes.select("unit"))
    if giants.isEmpty():
        return pairs, None
    return pairs.join(giants, "unit", "left_anti"), pairs.join(giants, "unit", "left_semi")


def replay_units(pairs: DataFrame, o: Options) -> tuple[DataFrame, DataFrame | None]:
    """The removals (LOG) of whole zips and, in zips too large for a task, of whole components.

    The second table has the pairs of components that are too large as well, if there are any.
    ``pairs`` is read several times and should have a short lineage.
    """
    zips, rest = _without_giants(pairs.withColumn("unit", F.col("code_postal")), o)
    if rest is None:
        return replay(zips), None
    roots = components(rest.select("i", "j"))
    parts = rest.drop("unit").join(roots.select(F.col("node").alias("i"), F.col("root").alias("unit")), "i")
    parts, giants = _without_giants(cut_lineage(parts), o)
    return replay(zips).unionByName(replay(parts)), giants


def _roots(single: DataFrame) -> DataFrame:
    """(j, up, odd) with ``up`` moved to the first row that is no ``j`` itself, by pointer doubling.

    A row with one dominator is passed over exactly if that one is not, so it shares or
    inverts (``odd``) the fate of every row above it.
    """
    while True:
        above = single.select(F.col("j").alias("up"), F.col("up").alias("next"), F.col("odd").alias("turned"))
        joined = single.join(above, "up", "left")
        single = cut_lineage(
            joined.select(
                "j",
                F.coalesce("next", "up").alias("up"),
                (F.col("odd") != F.coalesce("turned", F.lit(False))).alias("odd"),
                F.col("next").isNotNull().alias("moved"),
            )
        )
        if single.filter("moved").isEmpty():
            return single.select("j", "up", "odd")


def passed_over(edges: DataFrame) -> DataFrame:
    """Rows (``j``) dominated by a row that took its turn; ``edges`` holds dominations (i, j).

    For components too large for a task. Rows that nobody dominates take their turn. So do,
    below them, every second of a chain of rows with a single dominator, which pointer doubling
    finds at once. What any of them dominates is passed over and leaves, with all it dominates
    itself; then the next rows are free. The rounds follow the longest path of rows that have
    several dominators each.
    """
    edges = cut_lineage(edges.select("i", "j").distinct())
    found = []
    while not edges.isEmpty():
        dominated = edges.groupBy("j").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("up"))
        single = dominated.filter("n = 1").select("j", "up", F.lit(True).alias("odd"))
        free = edges.select("i").distinct().join(dominated.select(F.col("j").alias("i")), "i", "left_anti")
        below = _roots(cut_lineage(single)).filter(~F.col("odd"))
        below = below.join(free.select(F.col("i").alias("up")), "up", "left_semi").select(F.col("j").alias("i"))
        lost = cut_lineage(edges.join(free.unionAll(below), "i", "left_semi").select("j").distinct())
        found.append(lost)
        edges = cut_lineage(
            edges.join(lost.select(F.col("j").alias("i")), "i", "left_anti").join(lost, "j", "left_anti").select("i", "j")
        )
    return reduce(DataFrame.unionByName, found) if found else edges.select("j")


def _first(pairs: DataFrame, of: str, other: str) -> DataFrame:
    """(``of``, id, price, first): of each row of ``pairs`` the partner that comes first; merged before its shuffle."""
    first = F.min(F.struct(other, F.col(f"id_{other}").alias("id"), F.col(f"price_{other}").alias("price"), "similarity"))
    return pairs.groupBy(of).agg(F.any_value(f"id_{of}").alias(f"id_{of}"), F.any_value(f"price_{of}").alias(f"price_{of}"), first.alias("first"))


def settle(dominations: DataFrame, o: Options) -> DataFrame:
    """(j, id_j, price_j, first): the passed-over rows with their first dominator that took a turn.

    ``dominations`` is read several times and should have a short lineage.
    """
    removed, giants = replay_units(dominations, o)
    first = F.struct(F.col("kept_idx").alias("i"), F.col("kept_id").alias("id"), F.col("price_kept").alias("price"), "similarity")
    settled = removed.select(
        F.col("removed_idx").alias("j"), F.col("removed_id").alias("id_j"), F.col("price_removed").alias("price_j"), first.alias("first")
    )
    if giants is None:
        return settled
    lost = passed_over(giants).select(F.col("j").alias("i"))
    return settled.unionByName(_first(giants.join(lost, "i", "left_anti"), "j", "i"))


def _without(rows: DataFrame, dominated: DataFrame) -> DataFrame:
    return rows.join(dominated.select(F.col("j").alias("row_idx")), "row_idx", "left_anti")


def _round_ends(rows: DataFrame, o: Options, comparisons: float) -> list[int]:
    """Row numbers that cut the input, which has so many ``comparisons``, into rounds of growing size.

    Comparisons grow with the square of the rows, so the first round takes as many rows as its work
    allows. Its own are counted as well, since its blocks may be fuller than others.
    """
    total, most = rows.count(), FIRST_ROUND_WORK * float(o.first_round_rows) ** 2
    first = max(o.first_round_rows, int(total * math.sqrt(most / max(most, comparisons))))
    while True:
        shares, size = [], first
        while size < total:
            shares.append(size / total)
            size *= GROWTH
        ends = sorted({int(x) for x in rows.approxQuantile("row_idx", shares, 1e-4)}) if shares else []
        if not ends or first == o.first_round_rows:
            return ends
        start = rows.filter(F.col("row_idx") <= ends[0])
        if measure(start, start, o).comparisons <= FIRST_ROUND_WORK * most:
            return ends
        first = max(o.first_round_rows, first // GROWTH)


def _took_turns(rows: DataFrame, o: Options, comparisons: float) -> tuple[DataFrame, DataFrame]:
    """The rows of crowded zips that took their turn, and the others with their first dominator."""
    settled, leaders = [], None
    low = None
    for high in [*_round_ends(rows, o, comparisons), None]:
        chunk = rows if low is None else rows.filter(F.col("row_idx") > low)
        chunk = chunk if high is None else chunk.filter(F.col("row_idx") <= high)
        low = high
        if leaders is not None:
            dominated = cut_lineage(_first(near_pairs(leaders, chunk, o, only=_dominates(), few_first=True), "j", "i"))
            settled.append(dominated)
            chunk = cut_lineage(_without(chunk, dominated))
        dominated = cut_lineage(settle(cut_lineage(near_pairs(chunk, chunk, o, only=_dominates())), o))
        settled.append(dominated)
        took_turn = _without(chunk, dominated)
        leaders = cut_lineage(took_turn if leaders is None else leaders.unionByName(took_turn))
    return leaders, reduce(DataFrame.unionByName, settled)


def _gave_way(leaders: DataFrame, rows: DataFrame, dominated: DataFrame, o: Options) -> DataFrame:
    """(i, id_i, price_i, first): of each leader the first later match that is cheaper and not flagged by then.

    A leader looks at the rest of its window and at the next one; leaders are the fewer, so they are copied to both. Windows grow, and only
    leaders without a hit go on, so the number of jobs follows the logarithm of the rows.
    """
    flagged = dominated.select(F.col("j").alias("row_idx"), F.col("first.i").alias("flagged_at"))
    place = running_totals(rows.select("row_idx", F.lit(1).cast("bigint").alias("place")), [], ["row_idx"], ["place"])
    rows = cut_lineage(rows.join(flagged, "row_idx", "left").join(place, "row_idx"))
    total = rows.agg(F.max("place")).first()[0] or 0
    waiting = cut_lineage(leaders.join(rows.select("row_idx", "place"), "row_idx"))
    # A window has no larger block than all rows together, so that one count may do for all.
    whole = measure(leaders, rows, o, few_first=True)
    found, size = [], o.first_round_rows
    while True:
        load = None if whole.n_hot else Load(whole.comparisons * min(1.0, 2 * size / max(total, 1)), 0, 0)
        window = F.floor(F.col("place") / size)
        behind = waiting.withColumn("window", F.explode(F.array(window, window + 1)))
        open_then = F.col("flagged_at").isNull() | (F.col("flagged_at") > F.col("i"))
        pairs = near_pairs(
            behind, rows.withColumn("window", window), o, load, ["window"], ["flagged_at"], ~_dominates() & open_then, few_first=True
        )
        found.append(cut_lineage(_first(pairs, "i", "j")))
        if size > total:
            return reduce(DataFrame.unionByName, found)
        waiting = cut_lineage(waiting.join(found[-1].select(F.col("i").alias("row_idx")), "row_idx", "left_anti"))
        size *= LOOK_AHEAD


def _crowded_log(rows: DataFrame, o: Options, comparisons: float) -> DataFrame:
    """The removals (LOG) among rows of zips with large blocks, which have so many ``comparisons``."""
    leaders, dominated = _took_turns(rows, o, comparisons)
    dominated = cut_lineage(dominated)
    gave_way = _gave_way(leaders, rows, dominated, o)
    removed = dominated.select("j", "id_j", "first.i", "first.id", "price_j", "first.price", "first.similarity").unionAll(
        gave_way.select("i", "id_i", "first.j", "first.id", "price_i", "first.price", "first.similarity")
    )
    return removed.toDF(*LOG)


def _replayed(rows: DataFrame, o: Options, load: Load | None = None) -> DataFrame:
    """The removals (LOG) among rows whose matches can all be listed."""
    removed, giants = replay_units(cut_lineage(near_pairs(rows, rows, o, load)), o)
    if giants is None:
        return removed
    both = giants.select(F.col("i").alias("row_idx")).union(giants.select("j")).distinct()
    rows = cut_lineage(rows.join(both, "row_idx", "left_semi"))
    return removed.unionByName(_crowded_log(rows, o, measure(rows, rows, o).comparisons))


def _removals(rows: DataFrame, o: Options) -> DataFrame:
    # One file may hold most rows; characters are counted by all tasks.
    rows = cut_lineage(with_characters(rows.repartition("row_idx")))
    zips = cut_lineage(zip_loads(rows, rows, o))
    most = float(o.replay_pairs) * COMPARISONS_PER_MATCH
    crowded = zips.filter((F.col("n_hot") > 0) | (F.col("comparisons") > most))
    load = total(zips)
    if crowded.isEmpty():
        return _replayed(rows, o, load)
    calm, crowds = [cut_lineage(rows.join(crowded.select("code_postal"), "code_postal", how)) for how in ("left_anti", "left_semi")]
    return _replayed(calm, o).unionByName(_crowded_log(crowds, o, total(crowded).comparisons))


def near_log(rows: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """Log of the near duplicates among the rows that exact matching left.

    ``rows`` is read many times and should have a short lineage.
    """
    similarity = F.replace(F.format_number("similarity", 3), F.lit(","), F.lit(""))
    reason = F.concat(F.lit("fuzzy_match (sim="), similarity, F.lit(")"))
    return _removals(rows, o).select("removed_idx", "removed_id", "kept_id", reason.alias("reason"), "price_removed", "price_kept")
