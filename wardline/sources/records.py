"""Records of CSV files that may have line breaks inside quotes, cut by many tasks at once.

A line break ends a record if an even number of quotes lies before it in its file. So the quotes of each
line are counted, the parities are added up inside each split of a file, the totals of the splits, one row each,
are added up along the file, and every line then knows whether it starts a record, and which one. Lines that are a record by
themselves, nearly all, stay where they are; the others are gathered by record.

A quote that is no part of a quoted field breaks this count, as it breaks the format. In a file with an odd number
of quotes, the last record would reach from the quote that is never closed to the end of the file: its lines are taken one
by one in place of that, and show up as rows that cannot be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import materialize

PLACE = ("_file", "_split")


def quoted_records(spark: SparkSession, path: str, encoding: str = "UTF-8", quote: str = '"') -> DataFrame:
    """One row per record (column ``record``, without its last line break), the first of each file left out, and no empty ones."""
    lines = (
        spark.read.option("lineSep", "\n")
        .option("encoding", encoding)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            # Ascends with the lines of a split.
            F.monotonically_increasing_id().alias("_at"),
            F.col("value").alias("_line"),
            ((F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2).alias("_odd"),
        )
    )
    # The lines of a split, a bounded number of bytes, and how things would stand if it began between records.
    inside = Window.partitionBy(*PLACE).orderBy("_at")
    before = F.coalesce(F.sum("_odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("_open", before).withColumns(
        {
            "_number": F.row_number().over(inside),
            "_starts": F.sum(1 - F.col("_open")).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    lines = materialize(lines, "csv-lines")
    splits = lines.groupBy(*PLACE).agg(
        F.sum("_odd").alias("_quotes"), F.count("*").alias("_lines"), F.max("_starts").alias("_starts")
    )
    known = lines.join(_along_the_file(splits), list(PLACE))

    begun = F.col("_begun") == 1
    starts = F.when(begun, F.col("_number") - F.col("_starts")).otherwise(F.col("_starts"))
    opened = F.when(begun, 1 - F.col("_open")).otherwise(F.col("_open"))
    known = known.select(
        *PLACE,
        "_at",
        "_line",
        (F.col("_earlier") + starts).alias("_record"),
        ((opened == 1) | (F.col("_odd") == 1)).alias("_several"),
        (F.col("_unclosed") & (F.col("_earlier") + starts == F.col("_last"))).alias("_cut_off"),
    ).where(F.col("_record") > 1)
    single = known.where(~F.col("_several") | F.col("_cut_off")).select(F.col("_line").alias("record"))
    several = (
        known.where(F.col("_several") & ~F.col("_cut_off"))
        .groupBy("_file", "_record")
        .agg(F.sort_array(F.collect_list(F.struct("_split", "_at", "_line"))).alias("_parts"))
        .select(F.array_join(F.transform("_parts", lambda p: p["_line"]), "\n").alias("record"))
    )
    whole = single.unionByName(several).select(F.regexp_replace("record", "\r$", "").alias("record"))
    return whole.where(F.trim("record") != "")


def _along_the_file(splits: DataFrame) -> DataFrame:
    """For each split whether it begins inside a record, the records that start before it, and how the file ends."""
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("_file")
    begun = F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2
    splits = splits.withColumns({"_begun": begun, "_unclosed": F.sum("_quotes").over(file) % 2 == 1})
    own = F.when(F.col("_begun") == 1, F.col("_lines") - F.col("_starts")).otherwise(F.col("_starts"))
    splits = splits.withColumn("_own", own)
    return splits.select(
        *PLACE,
        "_begun",
        "_unclosed",
        F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_earlier"),
        F.sum("_own").over(file).alias("_last"),
    )
