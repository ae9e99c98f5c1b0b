"""CSV extracts: one file (or folder of files) per entity, a header line in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schema import CORRUPT, ENTITIES, Entity
from wardline.sources.records import quoted_records

TIME = "Appointment_Time"
# Fixed value: hours and minutes, seconds and their fraction if given.
TIME_PATTERN = r"^([01]?\d|2[0-3]):([0-5]\d)(:[0-5]\d(?:\.\d{1,7})?)?$"


def read_csv_extract(
    spark: SparkSession, entity: Entity, path: str, multi_line: bool = False, encoding: str = "UTF-8"
) -> DataFrame:
    """Read one extract into typed columns plus ``_corrupt_record``.

    Columns are taken by position; the header line is skipped, its names are ignored.
    An empty field is NULL. A row with a field that does not parse, with too many or too
    few fields, with a text over its staged length, or with a time that is none, keeps what
    could be read and carries its raw text in ``_corrupt_record``.

    ``multi_line`` allows line breaks inside quotes; large files are still read by many tasks, at the
    price of writing their lines once (``sources.records``).
    """
    schema = f"{entity.ddl}, {CORRUPT} string"
    options = {
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "dateFormat": "yyyy-MM-dd",
    }
    if multi_line:
        parsed = F.from_csv("record", schema, options | {"multiLine": "true"}).alias("row")
        rows = quoted_records(spark, path, encoding).select(parsed).select("row.*")
    else:
        rows = spark.read.schema(schema).options(header=True, encoding=encoding, **options).csv(path)
    return mark_unreadable(rows, entity)


def read_csv_extracts(spark: SparkSession, source_dir: str, **options) -> dict[str, DataFrame]:
    """All five extracts from ``source_dir``, by entity name."""
    base = source_dir.rstrip("/")
    return {e.name: read_csv_extract(spark, e, f"{base}/{e.file}", **options) for e in ENTITIES.values()}


def mark_unreadable(rows: DataFrame, entity: Entity) -> DataFrame:
    """Rows with ``_corrupt_record`` set where a text is too long or a time is none; times as ``HH:mm:ss``."""
    wrong = F.expr(" or ".join(f"length({c}) > {n}" for c, n in entity.staged_lengths.items()))
    wrong = F.coalesce(wrong, F.lit(False))
    timed = TIME in entity.columns
    if timed:
        wrong = wrong | F.coalesce(~F.col(TIME).rlike(TIME_PATTERN), F.lit(False))
    raw = F.to_csv(F.struct(*entity.columns))
    known = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumn(CORRUPT, F.coalesce(known, F.when(wrong, raw)))
    return rows.withColumn(TIME, _padded_time(F.col(TIME))) if timed else rows


def _padded_time(time: Column) -> Column:
    """``8:00:00`` and ``8:00`` become ``08:00:00``; a fraction of a second stays; what is no time stays as it is."""
    hour, rest = F.regexp_extract(time, TIME_PATTERN, 1), F.regexp_extract(time, TIME_PATTERN, 2)
    seconds = F.regexp_extract(time, TIME_PATTERN, 3)
    whole = F.concat(F.lpad(hour, 2, "0"), F.lit(":"), rest, F.when(seconds == "", ":00").otherwise(seconds))
    return F.when(time.rlike(TIME_PATTERN), whole).otherwise(time)
