"""Key, reference and length checks of the clean tables before they are published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.schema import ENTITIES, Entity


def columns(df: DataFrame, entity: Entity) -> DataFrame:
    """One scan: rows without a key, and values longer than their core column."""
    conditions = {"missing": f"{entity.key} is null"}
    checks = {"missing": ("key is null", entity.key)}
    for column, limit in entity.core_lengths.items():
        conditions[column] = f"length({column}) > {limit}"
        checks[column] = (f"longer than {limit}", column)
    found = df.agg(*[F.expr(f"count_if({condition}) as {c}") for c, condition in conditions.items()])
    return _long(found, entity, checks)


def unique_key(df: DataFrame, entity: Entity) -> DataFrame:
    """Keys that occur more than once."""
    counted = df.where(F.col(entity.key).isNotNull()).groupBy(entity.key).count()
    found = counted.agg(F.count_if(F.col("count") > 1).alias("repeated"))
    return _long(found, entity, {"repeated": ("key not unique", entity.key)})


def foreign_keys(tables: dict[str, DataFrame], entity: Entity) -> DataFrame | None:
    """Rows that refer to a parent missing from the clean tables. NULL is allowed."""
    child = tables[entity.name]
    found = []
    for column, parent in entity.foreign_keys:
        # Counting the references first leaves one row of a hot reference for the join.
        references = child.where(F.col(column).isNotNull()).groupBy(column).count()
        unmatched = references.join(
            tables[parent].select(F.col(ENTITIES[parent].key).alias(column)), column, "left_anti"
        )
        total = unmatched.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("unmatched"))
        found.append(_long(total, entity, {"unmatched": (f"not found in {parent}", column)}))
    return reduce(DataFrame.unionByName, found) if found else None


def entity_checks(tables: dict[str, DataFrame], entity: Entity) -> DataFrame:
    """(Table_Name, Check, Column_Name, Violations) of one table."""
    parts = [columns(tables[entity.name], entity), unique_key(tables[entity.name], entity)]
    if entity.foreign_keys:
        parts.append(foreign_keys(tables, entity))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(Table_Name, Row_Count)."""
    counts = [
        tables[name].agg(F.count("*").alias("Row_Count")).select(F.lit(name).alias("Table_Name"), "Row_Count")
        for name in ENTITIES
    ]
    return reduce(DataFrame.unionByName, counts)


def _long(found: DataFrame, entity: Entity, checks: dict[str, tuple[str, str]]) -> DataFrame:
    """One row of counters to one row per check."""
    rows = ", ".join(
        f"'{entity.name}', '{check}', '{column}', cast({counter} as bigint)"
        for counter, (check, column) in checks.items()
    )
    return found.selectExpr(f"stack({len(checks)}, {rows}) as (Table_Name, `Check`, Column_Name, Violations)")
