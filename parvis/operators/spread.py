"""Look-up joins that stay even when a third of the rows share one key.

Every key has as many slices as its own rows need: a rare key one, so that its table row is
copied once, a key of ``n`` rows ``1 + n // Options.rows_per_slice``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import DEFAULTS, Options
from ..session import cut_lineage

KEY_ROWS = "key_rows"


def counted_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys with the number of their rows, merged before the shuffle; written."""
    return cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(KEY_ROWS)))


def _last_slice(o: Options) -> Column:
    return F.floor(F.col(KEY_ROWS) / o.rows_per_slice).cast("bigint")


def deal(rows: DataFrame, counted: DataFrame, keys: Sequence[str], row_id: str, o: Options = DEFAULTS) -> DataFrame:
    """``rows`` with the ``slice`` of their key that a hash of ``row_id`` gives.

    ``counted`` is a written table of keys with their counts. Only its keys with several
    slices are looked up, at most one in ``rows_per_slice`` rows, by broadcast up to
    ``broadcast_rows`` of them. Null keys are equal.
    """
    hot = counted.filter(F.col(KEY_ROWS) >= o.rows_per_slice)
    n_hot = hot.count()
    if not n_hot:
        return rows.withColumn("slice", F.lit(0).cast("bigint"))
    hot = hot.select(*[F.col(k).alias(f"hot_{k}") for k in keys], _last_slice(o).alias("last_slice"))
    same = [F.col(k).eqNullSafe(F.col(f"hot_{k}")) for k in keys]
    joined = rows.join(F.broadcast(hot) if n_hot <= o.broadcast_rows else hot, same, "left")
    own = F.pmod(F.xxhash64(row_id), F.coalesce("last_slice", F.lit(0)) + 1)
    return joined.withColumn("slice", own).drop("last_slice", *[f"hot_{k}" for k in keys])


def copies(table: DataFrame, o: Options = DEFAULTS) -> DataFrame:
    """``table``, one row per key with its count, once per slice of the key."""
    every = F.sequence(F.lit(0).cast("bigint"), _last_slice(o))
    return table.withColumn("slice", F.explode(every)).drop(KEY_ROWS)


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], o: Options = DEFAULTS, how: str = "inner") -> DataFrame:
    """Join ``rows`` (with ``slice``) to ``table`` (one row per key, with its count)."""
    return rows.join(copies(table, o), [*keys, "slice"], how)
