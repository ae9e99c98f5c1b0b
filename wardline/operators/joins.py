"""Joins whose cost does not depend on how the keys are distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import bounded_tasks, materialize

# Rows of one short text column that may be broadcast: some 50 MB as a hash table.
BROADCAST_ROWS = 500_000

# A value with at least this many rows is kept out of the shuffle.
HOT_ROWS = 1_000_000


def prefilter(left: DataFrame, keys: DataFrame, on: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Cut ``left`` down to the keys of ``keys`` ahead of an inner join, if they are few.

    Few keys, by count, are broadcast: one scan of ``left`` and no shuffle. With more keys
    ``left`` is returned as it is, since a shuffle here would send all rows of a hot key to
    one task before they can be aggregated.
    """
    wanted = keys.select(on)
    if wanted.count() > max_rows:
        return left
    return left.join(F.broadcast(wanted), on, "left_semi")


def anti_join(
    left: DataFrame,
    keys: DataFrame,
    on: str,
    key: str,
    left_rows: int,
    key_rows: int,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    most_stay: bool = False,
) -> DataFrame:
    """Rows of ``left`` whose ``on`` value is not among ``keys[key]``; ``keys`` may repeat values.

    A NULL matches nothing, so rows with a NULL stay. ``left_rows`` and ``key_rows`` are the
    rows of both sides, known from writing them; they choose the plan, and so does ``most_stay``, which says
    that most values of ``left`` are expected to have no counterpart.

    Few keys are broadcast, and ``left`` is not shuffled at all. With many keys the references
    of ``left`` are counted per value together with the keys, which combines before the one shuffle. The values without
    a counterpart are written and select the rows of ``left``: broadcast if they are
    few. If not, ``left`` is shuffled by value, but for NULLs and values with ``hot_rows`` rows or more, with or without
    a counterpart: these are broadcast, once to keep them out of the shuffle and once to select their rows.
    There are at most ``left_rows / hot_rows`` such values, and where that could be more than may be
    broadcast, ``hot_rows`` grows to ``left_rows / broadcast_rows``.

    Where most rows stay, the values without a counterpart are too many to be worth writing: ``left`` is shuffled at
    once, with the same exceptions, and meets the keys.
    """
    if key_rows <= broadcast_rows:
        wanted = keys.select(F.col(key).alias(on)).where(F.col(on).isNotNull()).distinct()
        return left.join(F.broadcast(wanted), on, "left_anti")
    many = max(hot_rows, left_rows // max(broadcast_rows, 1))
    known = keys.select(F.col(key).alias(on)).where(F.col(on).isNotNull())
    if most_stay:
        with bounded_tasks(left.sparkSession, left_rows):
            return _without(left, known.distinct(), on, many)
    references = left.select(on, F.lit(1).cast("bigint").alias("_rows"), F.lit(False).alias("_known"))
    parents = known.select(on, F.lit(0).cast("bigint").alias("_rows"), F.lit(True).alias("_known"))
    values = references.unionByName(parents).groupBy(on).agg(F.sum("_rows").alias("_rows"), F.max("_known").alias("_known"))
    is_hot = F.col("_rows") >= many
    # A NULL among the references has no counterpart either.
    with bounded_tasks(left.sparkSession, left_rows + key_rows):
        values = materialize(values.where((F.col("_rows") > 0) & (~F.col("_known") | is_hot)), "values")
    unmatched = values.where(~F.col("_known")).select(on, "_rows")
    if unmatched.count() <= broadcast_rows:
        return _with_values(left, F.broadcast(unmatched.select(on)), on)
    apart = is_hot | F.col(on).isNull()
    hot = F.broadcast(values.where(is_hot & F.col(on).isNotNull()).select(on))
    rest = left.where(F.col(on).isNotNull()).join(hot, on, "left_anti")
    return _with_values(left, F.broadcast(unmatched.where(apart).select(on)), on).unionByName(
        rest.join(unmatched.where(~apart).select(on), on, "left_semi")
    )


def _without(left: DataFrame, gone: DataFrame, on: str, many: int) -> DataFrame:
    """Rows of ``left`` whose ``on`` value is not among ``gone``; NULLs and values of ``many`` rows are not shuffled."""
    filled = left.where(F.col(on).isNotNull())
    counted = filled.groupBy(on).agg(F.count("*").alias("_rows")).where(F.col("_rows") >= many)
    hot = materialize(counted.select(on), "hot")
    kept = left.where(F.col(on).isNull())
    if not hot.isEmpty():
        kept = kept.unionByName(_with_values(filled, F.broadcast(hot.join(gone, on, "left_anti")), on))
        filled = filled.join(F.broadcast(hot), on, "left_anti")
    return kept.unionByName(filled.join(gone, on, "left_anti"))


def _with_values(left: DataFrame, values: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` whose ``on`` value is among ``values``, a NULL like any other."""
    return left.join(values, left[on].eqNullSafe(values[on]), "left_semi")
