"""Quarantine in place of a stop: rows that would break a constraint of the core, and rows that refer to them.

The rules look at each staged row by itself, so what they leave can still break a constraint: a key that
occurs twice in a table without a rule for it, a text longer than its core column, a child of a parent that
was quarantined. Tables are gone through parents first. A row that breaks a constraint is logged and left out
by its key, and the children of what is left out are found by one anti-join per reference with the
parents that were written.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.joins import anti_join
from wardline.plans import quality
from wardline.schema import ENTITIES, Entity

# Reasons that only this kind of load logs.
PARENT, REPEATED, TOO_LONG, NO_KEY = (
    "Parent quarantined",
    "Key used more than once",
    "Text longer than its core column",
    "Missing key",
)

_LONG = "_too_long"


def levels() -> list[list[Entity]]:
    """The tables, those without references first, each after all that it refers to."""
    out: list[list[Entity]] = []
    placed: set[str] = set()
    while len(placed) < len(ENTITIES):
        ready = [e for e in ENTITIES.values() if e.name not in placed and all(p in placed for _, p in e.foreign_keys)]
        out.append(ready)
        placed |= {e.name for e in ready}
    return out


def breaches(
    entity: Entity,
    kept: DataFrame,
    parents: dict[str, DataFrame],
    kept_rows: int,
    parent_rows: dict[str, int],
    **thresholds: int,
) -> DataFrame:
    """(key, Error_Reason) of the rows that the rules have left and the core cannot take.

    ``kept`` has the ``judged_columns`` of these rows. ``parents`` are the clean tables, as written. A NULL reference is allowed. ``kept_rows`` and
    ``parent_rows`` bound the rows and choose the joins.
    """
    key = F.col(entity.key)
    own = [F.when(F.col(_LONG), F.lit(TOO_LONG))]
    if not _logged_without_key(entity):
        own.append(F.when(key.isNull(), F.lit(NO_KEY)))
    found = [
        kept.select(key, F.explode(F.array_compact(F.array(*own))).alias(quality.REASON)),
    ]
    if not any(isinstance(r, quality.Duplicate) for r in quality.RULES[entity.name]):
        found.append(quality.repeated_keys(kept, entity.key, REPEATED, kept_rows))
    for column, parent in entity.foreign_keys:
        references = kept.where(F.col(column).isNotNull()).select(key.alias("_key"), F.col(column).alias("_reference"))
        orphans = anti_join(
            references, parents[parent], "_reference", ENTITIES[parent].key, kept_rows, parent_rows[parent], **thresholds
        )
        found.append(orphans.select(F.col("_key").alias(entity.key), F.lit(PARENT).alias(quality.REASON)))
    return reduce(DataFrame.unionByName, found)


def judged_columns(entity: Entity) -> list:
    """What ``breaches`` looks at: key, references, and whether a text is too long for the core."""
    names = dict.fromkeys([entity.key, *(c for c, _ in entity.foreign_keys)])
    return [*map(F.col, names), _too_long(entity).alias(_LONG)]


def _too_long(entity: Entity):
    return reduce(or_, (F.coalesce(F.length(c) > n, F.lit(False)) for c, n in entity.core_lengths.items()))


def _logged_without_key(entity: Entity) -> bool:
    return any(isinstance(r, quality.Missing) and entity.key in r.columns for r in quality.RULES[entity.name])
