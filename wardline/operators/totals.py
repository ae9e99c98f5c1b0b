"""A figure over all rows next to each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window

from wardline.operators.ranking import ONE_TASK_ROWS


def with_total(
    df: DataFrame, name: str, aggregate: Column, max_rows: int | None = None, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Add ``aggregate`` over the whole of ``df`` as column ``name``.

    The figure is a scalar subquery, so the rows stay where they are; a window over the
    whole table would bring them all to one task. Only when ``max_rows``, a known bound on
    the rows, is small enough for one task is the window used: it reads ``df`` once.
    """
    if max_rows is not None and max_rows <= one_task_rows:
        return df.withColumn(name, aggregate.over(Window.partitionBy()))
    return df.withColumn(name, df.agg(aggregate).scalar())
