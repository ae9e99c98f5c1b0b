"""Load: stage, validate, quarantine, check, and publish all five tables or none; keep a log of every load."""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.operators.joins import BROADCAST_ROWS, anti_join
from wardline.plans import cascade, checks, facts, quality
from wardline.plans.layout import LAYOUT_ROWS, PACKED, write_core_table
from wardline.schema import CORRUPT, ENTITIES, VISITS, Entity
from wardline.session import bounded_tasks, delete_path, list_folders, materialize, write_new
from wardline.sources.core import Core, commit_path, core_path, latest_run, open_core, published_runs, read_core_table
from wardline.sources.csv import read_csv_extracts

log = logging.getLogger(__name__)

# Error codes for an empty staging table.
EMPTY_STAGING_CODES = {
    "Patients": 50001,
    "Doctors": 50002,
    "Appointments": 50003,
    "Treatments": 50004,
    "Billing": 50005,
}


STOP, QUARANTINE = "stop", "quarantine"


class Staging(dict):
    """Staged tables by name, with the rows that were counted while they were written, and those that could not be read."""

    def __init__(self, tables: dict[str, DataFrame], rows: dict[str, int], unreadable: dict[str, int] | None = None):
        super().__init__(tables)
        self.rows = rows
        self.unreadable = unreadable or {}


class LoadError(Exception):
    """The load stopped; what was published before is untouched."""


class EmptyStagingError(LoadError):
    def __init__(self, table: str):
        self.table = table
        self.code = EMPTY_STAGING_CODES[table]
        super().__init__(f"{self.code}: Staging {table} table is empty.")


class TooManyRejectsError(LoadError):
    def __init__(self, table: str, rejects: int, allowed: int):
        self.table = table
        super().__init__(f"{table}: {rejects} unreadable rows, {allowed} allowed")


class ConstraintError(LoadError):
    def __init__(self, violations: list):
        self.violations = violations
        listed = "; ".join(f"{v.Table_Name}.{v.Column_Name} {v.Check}: {v.Violations}" for v in violations)
        super().__init__(f"clean tables break constraints: {listed}")


class OvertakenError(LoadError):
    def __init__(self, sequence: int):
        super().__init__(f"another load was published as number {sequence} while this one was running")


@dataclass
class _Counts:
    """What a load has counted so far, by table."""

    read: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    errors: dict[str, int] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class LoadResult:
    run: str
    core: Core
    errors: dict[str, DataFrame]


def load_csv(spark: SparkSession, source_dir: str, root: str, as_of: date, **options) -> LoadResult:
    """Load the five CSV extracts in ``source_dir`` and publish them under ``root``.

    For extracts that need reader options, pass ``read_csv_extracts(...)`` to ``load``.
    """
    return load(spark, read_csv_extracts(spark, source_dir), root, as_of, **options)


def load(
    spark: SparkSession,
    feed: dict[str, DataFrame],
    root: str,
    as_of: date,
    max_errors: int | None = None,
    layout_rows: int = LAYOUT_ROWS,
    on_violation: str = STOP,
    with_visits: bool = True,
    collation: str | None = None,
    **thresholds: int,
) -> LoadResult:
    """Publish the clean rows of ``feed`` under ``root``, a folder all executors share.

    Everything is written below a new run folder. The run counts as published only once
    its line is in the publish log, which is the last step, so a reader sees the old five
    tables or the new five. Of loads that run side by side under one ``root``, the first to end is published;
    the others get ``OvertakenError``. Unreadable lines are logged; more than ``max_errors`` of an extract stop the
    load, if that is given. What the rules leave and the core cannot take stops the load, or, with
    ``on_violation="quarantine"``, goes to the error log with all that refers to it. ``with_visits`` publishes what the
    treatments and bills of each appointment come to, so that reports need not join them. ``collation``, such as
    ``UTF8_LCASE``, is how keys and references are compared, in the load and in all that reads what it publishes. ``thresholds``
    go to the anti-joins. Every load, published or not, leaves its counts in the load log (``load_log``).
    """
    if on_violation not in (STOP, QUARANTINE):
        raise ValueError(f"on_violation is {on_violation!r}, not {STOP!r} or {QUARANTINE!r}")
    root, run, started = root.rstrip("/"), uuid.uuid4().hex, datetime.now(timezone.utc)
    counts = _Counts()
    try:
        last = latest_run(spark, root)
        staging, rejects = stage(spark, feed, f"{root}/run={run}/staging", max_errors, counts, collation)
        errors_path = f"{root}/run={run}/errors"
        errors = write_errors(spark, staging, rejects, errors_path, as_of, counts, collation, **thresholds)
        guard_not_empty(staging)
        steps = cascade.levels() if on_violation == QUARANTINE else [list(ENTITIES.values())]
        written: dict[str, DataFrame] = {}
        with bounded_tasks(spark, quality.most_rows(staging)):
            for entities in steps:

                def write(entity: Entity) -> DataFrame:
                    if on_violation == QUARANTINE:
                        errors[entity.name] = _log_breaches(
                            staging, errors[entity.name], entity, written, errors_path, counts, collation, **thresholds
                        )
                    _write_core(
                        staging, errors[entity.name], entity, root, run, layout_rows, on_violation, counts, thresholds
                    )
                    return read_core_table(spark, entity, core_path(root, run, entity), collation)

                written |= _for_each_entity(write, entities)
            _check(written)
            if with_visits:
                _write_visits(written, root, run, layout_rows, counts)
        by_month = [e.name for e in ENTITIES.values() if e.month_of and _laid_out(staging, e, layout_rows)]
        _publish(spark, root, run, (last.sequence if last else 0) + 1, by_month, with_visits, collation, counts)
    except Exception as error:
        log.error("load %s failed, nothing was published: %s", run, error)
        _log_load(spark, root, run, started, counts, "failed", str(error))
        raise
    log.info("load %s published", run)
    _log_load(spark, root, run, started, counts, "published", None)
    return LoadResult(run, open_core(spark, root), errors)


def stage(
    spark: SparkSession,
    feed: dict[str, DataFrame],
    path: str,
    max_errors: int | None = None,
    counted: _Counts | None = None,
    collation: str | None = None,
) -> tuple[Staging, dict[str, DataFrame]]:
    """Write the feed as Parquet, replacing what is there; return staged rows and reject rows.

    Staging once means that an extract is parsed once, and that every rule scans only the
    columns it needs.
    """

    def write(entity: Entity) -> tuple[DataFrame, dict]:
        target = f"{path}/{entity.name.lower()}"
        raw, counts = feed[entity.name], Observation(f"staged {entity.name}")
        unreadable = F.count(CORRUPT) if CORRUPT in raw.columns else F.lit(0).cast("bigint")
        counted = raw.observe(counts, F.count("*").alias("rows"), unreadable.alias("unreadable"))
        counted.write.mode("overwrite").options(**PACKED).parquet(target)
        ddl = entity.ddl_with(collation) + (f", {CORRUPT} string" if CORRUPT in raw.columns else "")
        return spark.read.schema(ddl).parquet(target), counts.get

    staging, rejects, rows, unreadable = {}, {}, {}, {}
    with bounded_tasks(spark):
        written = _for_each_entity(write)
    if counted is not None:
        counted.read = {name: counts["rows"] for name, (_, counts) in written.items()}
        counted.rejected = {name: counts["unreadable"] for name, (_, counts) in written.items()}
    for name, (raw, counts) in written.items():
        if CORRUPT in raw.columns:
            rejects[name] = quality.reject_rows(raw, ENTITIES[name])
            if max_errors is not None and counts["unreadable"] > max_errors:
                raise TooManyRejectsError(name, counts["unreadable"], max_errors)
            raw = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        staging[name], rows[name] = raw, counts["rows"] - counts["unreadable"]
        unreadable[name] = counts["unreadable"]
    return Staging(staging, rows, unreadable), rejects


def write_errors(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    rejects: dict[str, DataFrame],
    path: str,
    as_of: date,
    counted: _Counts | None = None,
    collation: str | None = None,
    **thresholds: int,
) -> dict[str, DataFrame]:
    """The five error logs (key, Error_Reason, Logged_At), replacing those of ``path``."""

    def write(entity: Entity) -> DataFrame:
        rows = quality.error_rows(entity, staging, as_of, **thresholds)
        if entity.name in rejects:
            rows = rows.unionByName(rejects[entity.name])
        return _append_errors(rows, entity, path, "overwrite", counted, collation)

    with bounded_tasks(spark, quality.most_rows(staging)):
        return _for_each_entity(write)


def read_errors(spark: SparkSession, root: str, run: str, collation: str | None = None) -> dict[str, DataFrame]:
    """The error logs of a run."""
    path = f"{root.rstrip('/')}/run={run}/errors"
    return {
        e.name: spark.read.schema(_error_schema(e, collation)).parquet(f"{path}/{e.name.lower()}") for e in ENTITIES.values()
    }


def _error_schema(entity: Entity, collation: str | None) -> str:
    key = f"{entity.key} string{f' collate {collation}' if collation else ''}"
    return f"{key}, {quality.REASON} string, Logged_At timestamp"


def _append_errors(rows: DataFrame, entity: Entity, path: str, mode: str, counted: _Counts | None, collation) -> DataFrame:
    target, counts = f"{path}/{entity.name.lower()}", Observation(f"errors {entity.name}")
    rows = rows.withColumn("Logged_At", F.current_timestamp()).observe(counts, F.count("*").alias("rows"))
    rows.write.mode(mode).parquet(target)
    if counted is not None:
        counted.errors[entity.name] = counted.errors.get(entity.name, 0) + counts.get["rows"]
    return rows.sparkSession.read.schema(_error_schema(entity, collation)).parquet(target)


def staging_status(staging: dict[str, DataFrame]) -> DataFrame:
    """(Table_Name, Error_Code, Status) with Status ``empty`` or ``ok``."""
    status = F.when(F.count("*") == 0, "empty").otherwise("ok")
    per_table = [
        staging[name]
        .limit(1)
        .agg(status.alias("Status"))
        .selectExpr(f"'{name}' as Table_Name", f"{EMPTY_STAGING_CODES[name]} as Error_Code", "Status")
        for name in ENTITIES
    ]
    return reduce(DataFrame.unionByName, per_table)


def guard_not_empty(staging: dict[str, DataFrame]) -> None:
    empty = [name for name in EMPTY_STAGING_CODES if not quality.rows_of(staging, name)]
    if empty:
        raise EmptyStagingError(empty[0])


def drop_runs(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the folders of all runs but the last ``keep`` published ones; return the runs that are left.

    Runs that failed, or were published earlier, go with their staging tables and error logs. The last
    published run stays whatever ``keep`` says. Not while a load is running.
    """
    kept = set(published_runs(spark, root)[: max(keep, 1)])
    for folder in list_folders(spark, root):
        if folder.startswith("run=") and folder.removeprefix("run=") not in kept:
            delete_path(spark, f"{root.rstrip('/')}/{folder}")
    return sorted(kept)


def drop_staging(spark: SparkSession, root: str, run: str) -> None:
    """Delete the staged tables of a run; what it published and its error logs stay."""
    delete_path(spark, f"{root.rstrip('/')}/run={run}/staging")


def exclude_quarantined(
    staged: DataFrame,
    errors: DataFrame,
    entity: Entity,
    staged_rows: int | None = None,
    columns: list | None = None,
    **thresholds: int,
) -> DataFrame:
    """Rows whose key has no error. All copies of a key go; rows without a key stay.

    ``columns``, with the key among them, are taken ahead of the join, instead of all.
    """
    rows = staged.select(*(columns or entity.columns))
    bad_keys = errors.count()
    if bad_keys > BROADCAST_ROWS:
        # The log has a row for every copy of a key; few keys can have very many.
        bad_keys = errors.agg(F.count_distinct(entity.key)).first()[0]
    staged_rows = staged.count() if staged_rows is None else staged_rows
    return anti_join(rows, errors, entity.key, entity.key, staged_rows, bad_keys, most_stay=True, **thresholds)


def _laid_out(staging, entity: Entity, layout_rows: int) -> bool:
    return quality.rows_of(staging, entity.name) >= layout_rows


def _log_breaches(staging, errors, entity, written, errors_path, counts, collation, **thresholds) -> DataFrame:
    """The error log of a table with the rows that the core cannot take, though no rule speaks against them."""
    rows = quality.rows_of(staging, entity.name)
    # Every breach is looked for in these rows: they are excluded once, and only with the columns that it takes.
    kept = materialize(
        exclude_quarantined(
            staging[entity.name], _quarantined_by_rules(errors), entity, rows, cascade.judged_columns(entity), **thresholds
        ),
        "kept",
    )
    found = cascade.breaches(entity, kept, written, rows, counts.written, **thresholds)
    return _append_errors(found, entity, errors_path, "append", counts, collation)


def _write_core(staging, errors, entity, root, run, layout_rows, on_violation, counts, thresholds) -> None:
    rows = quality.rows_of(staging, entity.name)
    clean = exclude_quarantined(staging[entity.name], _quarantined_by_rules(errors), entity, rows, **thresholds)
    if on_violation == QUARANTINE:
        # Rows without a key are logged, but no key leaves them out.
        clean = clean.where(F.col(entity.key).isNotNull())
    laid_out, observed = _laid_out(staging, entity, layout_rows), Observation(f"core {entity.name}")
    clean = clean.observe(observed, F.count("*").alias("rows"))
    write_core_table(clean, entity, core_path(root, run, entity), laid_out, rows, staging.rows, staging[entity.name])
    counts.written[entity.name] = observed.get["rows"]


def _write_visits(written, root, run, layout_rows, counts) -> None:
    rows = counts.written["Appointments"]
    chain = facts.visits(Core.of(written))
    laid_out, appointments = rows >= layout_rows, written["Appointments"]
    write_core_table(chain, VISITS, core_path(root, run, VISITS), laid_out, rows, counts.written, appointments)


def _check(written: dict[str, DataFrame]) -> None:
    def violations(entity: Entity) -> list:
        # A handful of counters per table.
        return checks.entity_checks(written, entity).where("Violations > 0").collect()

    broken = [row for rows in _for_each_entity(violations).values() for row in rows]
    if broken:
        raise ConstraintError(broken)


def _quarantined_by_rules(errors: DataFrame) -> DataFrame:
    # An unreadable line never reached staging; it must not take down a good row
    # that happens to have the same key.
    return errors.where(F.col(quality.REASON) != quality.UNPARSEABLE)


def _publish(spark: SparkSession, root: str, run: str, sequence: int, by_month: list[str], with_visits, collation, counts) -> None:
    """Add the next line to the publish log: one file named by its number, which only one load can create."""
    line = {
        "sequence": sequence,
        "run": run,
        "by_month": sorted(by_month),
        "has_visits": with_visits,
        "collation": collation,
        "rows": counts.written,
        "published_at": datetime.now(timezone.utc).isoformat(),
    }
    if not write_new(spark, f"{commit_path(root)}/{sequence:020d}.json", json.dumps(line)):
        raise OvertakenError(sequence)


LOG_SCHEMA = (
    "run string, started_at timestamp, ended_at timestamp, Status string, Message string, Table_Name string, "
    "Read_Rows bigint, Rejected_Rows bigint, Error_Rows bigint, Quarantined_Rows bigint, Published_Rows bigint"
)


def log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_loads"


def load_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per load and table, published or not: rows read, unreadable, logged as errors, left out and published.

    What a load that failed did not get to is NULL; it has published nothing.
    """
    return spark.read.schema(LOG_SCHEMA).json(log_path(root))


def _log_load(spark, root, run, started, counts: _Counts, status: str, message: str | None) -> None:
    lines = []
    for name in ENTITIES:
        read, rejected, written = (d.get(name) for d in (counts.read, counts.rejected, counts.written))
        line = {
            "run": run,
            "started_at": started.isoformat(),
            "ended_at": datetime.now(timezone.utc).isoformat(),
            "Status": status,
            "Message": message,
            "Table_Name": name,
            "Read_Rows": read,
            "Rejected_Rows": rejected,
            "Error_Rows": counts.errors.get(name),
            "Quarantined_Rows": None if written is None else read - rejected - written,
            "Published_Rows": written if status == "published" else 0,
        }
        lines.append(json.dumps(line))
    try:
        write_new(spark, f"{log_path(root)}/{run}.json", "\n".join(lines) + "\n")
    except Exception as error:
        # The load itself has ended, for better or worse, and that is what its caller has to know.
        log.error("load %s could not be logged: %s", run, error)


def _for_each_entity(job, entities: list[Entity] | None = None) -> dict:
    """Run one Spark job per entity side by side; the small tables do not wait for the large ones."""
    entities = list(ENTITIES.values()) if entities is None else entities
    results: dict = {}
    failures: list[Exception] = []

    def call(entity: Entity) -> None:
        try:
            results[entity.name] = job(entity)
        except Exception as error:  # re-raised below, in the calling thread
            failures.append(error)

    threads = [InheritableThread(target=call, args=(entity,)) for entity in entities]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failures:
        raise failures[0]
    return {entity.name: results[entity.name] for entity in entities}
