"""Dense rank over a whole table without bringing the table to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import materialize

# Up to this many rows one sorting task is the cheapest plan.
ONE_TASK_ROWS = 200_000

# Rows per sorted bucket beyond that.
BUCKET_ROWS = 1_000_000


def dense_rank_desc(
    df: DataFrame,
    value: str,
    rank: str,
    key: str,
    max_rows: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``rank``: the dense rank of ``value``, highest first and NULL last.

    ``max_rows`` is a known bound on the rows of ``df``. If it is not given the rows
    are written out once and counted. Small inputs use a plain window.

    Larger inputs are sorted into ranges of (value, key), so that a value that many rows share is
    spread over ranges too, and written once with the number of the range. Ranks inside a range are
    shifted by the distinct values of the ranges above; where a range starts with the value that the
    one above ends with, that value is not counted again.
    """
    if max_rows is not None and max_rows <= one_task_rows:
        return _ranked_in_one_task(df, value, rank)
    if max_rows is None:
        df = materialize(df, "rank-input")
        max_rows = df.count()
        if max_rows <= one_task_rows:
            return _ranked_in_one_task(df, value, rank)
    return _ranked_by_range(df, value, rank, key, buckets or max(2, -(-max_rows // BUCKET_ROWS)))


def _ranked_in_one_task(df, value, rank):
    return df.withColumn(rank, F.dense_rank().over(Window.orderBy(F.desc(value))).cast("bigint"))


def _ranked_by_range(rows, value, rank, key, buckets):
    placed = rows.repartitionByRange(buckets, F.desc_nulls_last(value), F.col(key))
    placed = materialize(placed.withColumn("_range", F.spark_partition_id()), "rank-ranges")
    inside = Window.partitionBy("_range").orderBy(F.desc_nulls_last(value))
    ranked = placed.withColumn("_inside", F.dense_rank().over(inside))

    # One row per range.
    has_null = F.max(F.col(value).isNull())
    ranges = placed.groupBy("_range").agg(
        (F.count_distinct(value) + has_null.cast("bigint")).alias("_width"),
        F.max(value).alias("_first"),
        F.when(~has_null, F.min(value)).alias("_last"),
    )
    order = Window.orderBy("_range")
    above = F.lag(F.struct("_last")).over(order)
    continues = (above.isNotNull() & F.col("_first").eqNullSafe(above["_last"])).cast("bigint")
    shifts = ranges.withColumn("_continues", continues).withColumn(
        "_shift",
        F.coalesce(F.sum(F.col("_width") - F.col("_continues")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        - F.col("_continues"),
    )
    return (
        ranked.join(F.broadcast(shifts.select("_range", "_shift")), "_range")
        .withColumn(rank, F.col("_inside") + F.col("_shift"))
        .drop("_range", "_inside", "_shift")
    )
