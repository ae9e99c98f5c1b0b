"""Turn counted rows back into single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many copies in total, one task may make all of them.
ONE_TASK_COPIES = 1_000_000

# Beyond that, copies that one row may turn into inside its own task.
CHUNK = 8_192


def repeat_rows(
    df: DataFrame, times: str, total: int, chunk: int = CHUNK, one_task_copies: int = ONE_TASK_COPIES
) -> DataFrame:
    """Emit each row ``times`` times and drop the counter; rows with ``times`` < 1 vanish.

    ``total`` is a known bound on the rows emitted. If it is large, rows with a counter
    above ``chunk`` are cut into pieces that are spread over the cluster before they are
    expanded, so no task expands a huge counter, or many large ones, alone.
    """
    if total <= one_task_copies:
        return _expand(df.where(F.col(times) > 0), F.col(times), times)

    small = df.where(F.col(times).between(1, chunk))
    # Pieces are listed in two levels: one row's list of blocks is short, and each block lists its own pieces.
    last = F.expr(f"(`{times}` - 1) div {chunk}")
    blocks = (
        df.where(F.col(times) > chunk)
        .withColumn("_last", last)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"_last div {chunk}"))))
        .repartition(*df.columns, "_block")
    )
    first = F.col("_block") * chunk
    pieces = (
        blocks.withColumn("_piece", F.explode(F.sequence(first, F.least(F.col("_last"), first + (chunk - 1)))))
        .drop("_last", "_block")
        .repartition(*df.columns, "_piece")
    )
    in_piece = F.least(F.lit(chunk), F.col(times) - F.col("_piece") * chunk)
    return _expand(small, F.col(times), times).unionByName(_expand(pieces, in_piece, times).drop("_piece"))


def _expand(df: DataFrame, count: Column, times: str) -> DataFrame:
    copies = F.sequence(F.lit(1).cast("bigint"), count.cast("bigint"))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy", times)
