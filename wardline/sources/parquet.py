"""Parquet extracts, and rows from elsewhere brought into the form of an extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.schema import ENTITIES, Entity
from wardline.sources.csv import mark_unreadable


def conform(df: DataFrame, entity: Entity) -> DataFrame:
    """Every column of the entity, by name, in order and type; a column ``df`` lacks is NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[f"cast({f.name if f.name in present else 'null'} as {f.type}) as {f.name}" for f in entity.fields]
    )


def read_parquet_extracts(spark: SparkSession, source_dir: str) -> dict[str, DataFrame]:
    """All five extracts from ``source_dir/<entity>.parquet``, by entity name.

    As in CSV extracts, rows with a text that is too long or a time that is none are marked in
    ``_corrupt_record``.
    """
    base = source_dir.rstrip("/")
    return {
        e.name: mark_unreadable(conform(spark.read.parquet(f"{base}/{e.name.lower()}.parquet"), e), e)
        for e in ENTITIES.values()
    }
