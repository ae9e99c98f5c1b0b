"""Physical layout of large core tables, in place of secondary indexes."""

from __future__ import annotations

from collections import Counter
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from wardline.schema import Entity
from wardline.sources.core import MONTH

# A table with fewer rows is written as it comes. Its columns are the same either way.
LAYOUT_ROWS = 50_000_000
ROWS_PER_FILE = 5_000_000
PLACE = "_place"


# Rows from which the ranges of a column are taken, and the most bits of a range's number.
SAMPLE_ROWS = 65_536
RANGE_BITS = 12

# The largest Bloom filter of a column in a row group: enough for the keys of a file at one wrong in a hundred.
BLOOM_BYTES = 8 << 20

# How staged and core tables are written, which stay on disk. The level is the fastest.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def write_core_table(
    df: DataFrame,
    entity: Entity,
    path: str,
    laid_out: bool,
    rows: int,
    keys: dict[str, int] | None = None,
    drawn_from: DataFrame | None = None,
) -> None:
    """``rows`` and ``keys`` (rows of the tables referred to) are counts from staging; they size files and filters. ``drawn_from``
    is a written table that ``df`` is made of, with the key, lookup columns and date of most rows: the limits of ranges are taken
    from it, so that ``df`` is computed only once."""
    files = max(1, -(-rows // ROWS_PER_FILE))
    if laid_out and entity.month_of:
        write_by_month(df, entity, path, files, keys, rows, drawn_from)
    elif laid_out and entity.lookups:
        write_sorted(df, entity, path, files, keys, rows, drawn_from)
    else:
        df.write.mode("overwrite").options(**PACKED).parquet(path)


def write_sorted(
    df: DataFrame,
    entity: Entity,
    path: str,
    files: int,
    keys: dict[str, int] | None = None,
    rows: int | None = None,
    drawn_from: DataFrame | None = None,
) -> None:
    """Files of ranges of (lookup columns, key): a lookup skips all files but a few."""
    rows = df.count() if rows is None else rows
    placed, order, _ = _ordered(df, entity, files, rows, drawn_from)
    order.append(entity.key)
    placed = placed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    _filtered(placed.drop(PLACE).write.mode("overwrite"), entity, keys, rows // files).parquet(path)


def write_by_month(
    df: DataFrame,
    entity: Entity,
    path: str,
    files: int,
    keys: dict[str, int] | None = None,
    rows: int | None = None,
    drawn_from: DataFrame | None = None,
) -> None:
    """One folder per month; in it, rows in the order of the columns they are looked up or joined by.

    A date filter prunes folders, and the smallest and largest value in a file's footer
    prune files for one patient or doctor. Rows to be aggregated together lie together, so that
    combining before the shuffle takes away the most.

    The rows are cut into ranges of (month, lookup columns, key). The key is unique, so both a
    month and a value that hold much of the table are spread over many tasks.
    """
    rows = df.count() if rows is None else rows
    month = F.trunc(entity.month_of, "month")
    placed, order, month_share = _ordered(df, entity, files, rows, drawn_from, month)
    order = [*order, entity.key]
    # The month is computed again behind the shuffle, which is that much smaller.
    placed = placed.repartitionByRange(files, month, *order).withColumn(MONTH, month).sortWithinPartitions(MONTH, *order)
    # A file lies in one month: its filters are no larger than the largest month can fill.
    file_rows = min(rows // files, int(rows * month_share))
    _filtered(placed.drop(PLACE).write.mode("overwrite").partitionBy(MONTH), entity, keys, file_rows).parquet(path)


def _ordered(
    df: DataFrame, entity: Entity, files: int, rows: int, drawn_from: DataFrame | None = None, month: Column | None = None
) -> tuple[DataFrame, list[str], float]:
    """Rows, the columns that put them in the order of their lookups, and the share of the rows in the largest month.

    Two columns have equal rights: each value gets the number of the range it lies in, and the bits of
    both numbers take turns. A file then spans few ranges of either column, so that a lookup by one or the
    other reads about the square root of the files.
    """
    if len(entity.lookups) < 2:
        return df, list(entity.lookups), 1.0
    bits = min(RANGE_BITS, 3 + files.bit_length() // 2)
    all_limits, month_share = _range_limits(df if drawn_from is None else drawn_from, entity, bits, rows, month)
    numbers = [_range_number(F.col(c), limits) for c, limits in all_limits.items()]
    place = reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(_spread(n), i) for i, n in enumerate(reversed(numbers))))
    return df.withColumn(PLACE, place), [PLACE], month_share


def _range_limits(
    df: DataFrame, entity: Entity, bits: int, rows: int, month: Column | None = None
) -> tuple[dict[str, list[str]], float]:
    """For each lookup column 2 ** bits - 1 values that cut it into ranges of about as many rows; the largest month's share.

    They come from at most about ``SAMPLE_ROWS`` rows, chosen by a hash of the key, and decide
    on the order of rows and the size of filters only.
    """
    share = F.pmod(F.xxhash64(entity.key), F.lit(1_000_000)) < F.lit(1_000_000 * SAMPLE_ROWS // max(rows, 1))
    months = F.lit(None).cast("date") if month is None else month
    sample = df.where(share).select(*entity.lookups, months.alias(MONTH)).collect()
    limits = {}
    for column in entity.lookups:
        values = sorted(r[column] for r in sample if r[column] is not None)
        count = 1 << bits
        limits[column] = [values[i * len(values) // count] if values else "" for i in range(1, count)]
    largest = max(Counter(r[MONTH] for r in sample).values(), default=0)
    return limits, largest / len(sample) if sample else 1.0


def _range_number(column: Column, limits: list[str]) -> Column:
    """How many of the ascending limits are no larger than the value, by halving; 0 for NULL."""
    bits = len(limits).bit_length()
    ascending = F.array(*map(F.lit, limits))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(bits))))
    found = F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(ascending[low + step - 1] <= column, low + step).otherwise(low)
    )
    return F.coalesce(found, F.lit(0)).cast("bigint")


def _spread(number: Column) -> Column:
    """A zero bit after each of the 16 lowest bits."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return number


def _filtered(
    writer: DataFrameWriter, entity: Entity, keys: dict[str, int] | None, file_rows: int
) -> DataFrameWriter:
    """Bloom filters for the key and the lookup columns, for as many values as a file can have of them."""
    # Ranges come from a sample: some files have more rows than others.
    most = 2 * file_rows + 1
    parents = dict(entity.foreign_keys)
    writer = writer.options(**PACKED).option("parquet.bloom.filter.max.bytes", str(BLOOM_BYTES))
    for column in {entity.key, *entity.lookups}:
        values = min(most, (keys or {}).get(parents.get(column, ""), most))
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(max(values, 1)))
    return writer


def in_period(df: DataFrame, column: str, start: date, end: date) -> Column:
    """``column`` between both dates, inclusive, and the month folders that can hold them."""
    inside = F.col(column).between(F.lit(start), F.lit(end))
    if MONTH in df.columns:
        inside = inside & F.col(MONTH).between(F.trunc(F.lit(start), "month"), F.trunc(F.lit(end), "month"))
    return inside
