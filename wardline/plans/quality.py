"""Data-quality rules as data, and the error rows they produce."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.joins import BROADCAST_ROWS, HOT_ROWS, anti_join
from wardline.operators.repeat import repeat_rows
from wardline.schema import CORRUPT, ENTITIES, Entity
from wardline.session import bounded_tasks, materialize

REASON = "Error_Reason"


@dataclass(frozen=True)
class Missing:
    """At least one of the columns is NULL."""

    reason: str
    columns: tuple[str, ...]

    def broken(self, as_of: date) -> Column:
        return reduce(or_, (F.col(c).isNull() for c in self.columns))


@dataclass(frozen=True)
class Future:
    """The date lies after the day of the run. NULL passes."""

    reason: str
    column: str

    def broken(self, as_of: date) -> Column:
        return F.col(self.column) > F.lit(as_of)


@dataclass(frozen=True)
class Negative:
    """The amount is below zero. Zero and NULL pass."""

    reason: str
    column: str

    def broken(self, as_of: date) -> Column:
        return F.col(self.column) < 0


@dataclass(frozen=True)
class Duplicate:
    """The key occurs again: one error row for every copy but one. NULL keys pass."""

    reason: str


@dataclass(frozen=True)
class Orphan:
    """The reference has no counterpart among the staged parents; a NULL never has one."""

    reason: str
    column: str
    parent: str


# Which rules apply to which table, and their texts.
RULES = {
    "Patients": (
        Duplicate("Duplicate Patient_ID"),
        Missing(
            "Missing required field (ID/Name/Registration_Date)",
            ("Patient_ID", "First_Name", "Last_Name", "Registration_Date"),
        ),
        Future("Date_Of_Birth is in the future", "Date_Of_Birth"),
    ),
    "Doctors": (Missing("Missing Doctor_ID", ("Doctor_ID",)),),
    "Appointments": (
        Duplicate("Duplicate Appointment_ID"),
        Missing(
            "Missing required field (ID/Patient/Doctor/Date)",
            ("Appointment_ID", "Patient_ID", "Doctor_ID", "Appointment_Date"),
        ),
        Future("Appointment_Date is in the future", "Appointment_Date"),
        Orphan("References a Patient_ID not found in stg.Patients", "Patient_ID", "Patients"),
        Orphan("References a Doctor_ID not found in stg.Doctors", "Doctor_ID", "Doctors"),
    ),
    "Treatments": (
        Duplicate("Duplicate Treatment_ID"),
        Missing("Missing required field (ID/Appointment_ID)", ("Treatment_ID", "Appointment_ID")),
        Orphan("References an Appointment_ID not found in stg.Appointments", "Appointment_ID", "Appointments"),
    ),
    "Billing": (
        Negative("Negative Amount", "Amount"),
        Orphan("References a Patient_ID not found in stg.Patients", "Patient_ID", "Patients"),
        Orphan("References a Treatment_ID not found in stg.Treatments", "Treatment_ID", "Treatments"),
    ),
}
UNPARSEABLE = "Unparseable row"


def error_rows(
    entity: Entity,
    staging: dict[str, DataFrame],
    as_of: date,
    rules: tuple | None = None,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(key, Error_Reason) for every breach of the entity's rules.

    All rules that look at one row share a single scan. Each duplicate rule is one
    aggregation on the key, each orphan rule one anti-join. Row counts come with ``staging`` where
    it was written by a load; other tables are counted.
    """
    rules = RULES[entity.name] if rules is None else rules
    staged = staging[entity.name]
    rows = rows_of(staging, entity.name)
    found = []

    row_rules = [r for r in rules if hasattr(r, "broken")]
    if row_rules:
        found.append(_row_errors(staged, entity.key, row_rules, as_of))
    for rule in rules:
        if isinstance(rule, Duplicate):
            found.append(repeated_keys(staged, entity.key, rule.reason, rows))
        elif isinstance(rule, Orphan):
            found.append(_orphans(staged, entity.key, rule, staging, rows, hot_rows, broadcast_rows))
    return reduce(DataFrame.unionByName, found)


def rule_rows(entity: Entity, reason: str, staging: dict[str, DataFrame], as_of: date) -> DataFrame:
    """The error rows of one rule."""
    rules = tuple(r for r in RULES[entity.name] if r.reason == reason)
    return error_rows(entity, staging, as_of, rules)


def reject_rows(raw: DataFrame, entity: Entity) -> DataFrame:
    """Error rows for the lines of an extract that could not be read."""
    return raw.where(F.col(CORRUPT).isNotNull()).select(entity.key, F.lit(UNPARSEABLE).alias(REASON))


def summary(errors: dict[str, DataFrame]) -> DataFrame:
    """(Table_Name, Quarantined_Rows): distinct keys with an error; tables without errors show 0."""
    per_table = []
    for entity in ENTITIES.values():
        # The global aggregate returns its 0 for an empty log too.
        distinct_keys = errors[entity.name].agg(F.count_distinct(entity.key).alias("Quarantined_Rows"))
        per_table.append(distinct_keys.select(F.lit(entity.name).alias("Table_Name"), "Quarantined_Rows"))
    return reduce(DataFrame.unionByName, per_table)


def rows_of(staging: dict[str, DataFrame], name: str) -> int:
    known = getattr(staging, "rows", {})
    return known[name] if name in known else staging[name].count()


def most_rows(staging: dict[str, DataFrame]) -> int:
    """The rows of the largest table, as far as they are known without counting."""
    return max(getattr(staging, "rows", {}).values(), default=0)


def _row_errors(staged: DataFrame, key: str, rules, as_of: date) -> DataFrame:
    hits = [F.when(rule.broken(as_of), F.lit(rule.reason)) for rule in rules]
    suspicious = staged.where(reduce(or_, (rule.broken(as_of) for rule in rules)))
    return suspicious.select(key, F.explode(F.array_compact(F.array(*hits))).alias(REASON))


def repeated_keys(staged: DataFrame, key: str, reason: str, rows: int) -> DataFrame:
    """An error row for every copy of a key but one."""
    # Counting combines copies before the shuffle; numbering them in a window would put
    # all copies of a key into one task.
    counted = staged.where(F.col(key).isNotNull()).groupBy(key).agg((F.count("*") - 1).alias("_more"))
    # Written: as many tasks as the rows need, and as a rule few keys are left.
    with bounded_tasks(staged.sparkSession, rows):
        repeated = materialize(counted.where(F.col("_more") > 0), "repeated")
    again = repeat_rows(repeated, "_more", total=rows)
    return again.select(key, F.lit(reason).alias(REASON))


def _orphans(staged, key, rule, staging, rows, hot_rows, broadcast_rows):
    parents = staging[rule.parent]
    references = staged.select(F.col(key).alias("_key"), F.col(rule.column).alias("_reference"))
    unmatched = anti_join(
        references,
        parents,
        "_reference",
        ENTITIES[rule.parent].key,
        left_rows=rows,
        key_rows=rows_of(staging, rule.parent),
        hot_rows=hot_rows,
        broadcast_rows=broadcast_rows,
    )
    return unmatched.select(F.col("_key").alias(key), F.lit(rule.reason).alias(REASON))
