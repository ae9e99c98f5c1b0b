"""The published core: five clean Parquet tables, and what their appointments come to, behind a log of published runs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schema import ENTITIES, VISITS, Entity
from wardline.session import path_exists

COMMIT_SCHEMA = (
    "sequence bigint, run string, by_month array<string>, has_visits boolean, collation string, rows map<string,bigint>, published_at timestamp"
)
MONTH = "_month"


@dataclass(frozen=True)
class Core:
    patients: DataFrame
    doctors: DataFrame
    appointments: DataFrame
    treatments: DataFrame
    billing: DataFrame
    #: Scans of tables that lie in month folders, with the folder's month, for pruning by date.
    monthly: dict[str, DataFrame] = field(default_factory=dict)
    #: One row per appointment with billed treatments, if the load has published it.
    visits: DataFrame | None = None
    #: Rows of each table, as far as they were counted while it was written.
    rows: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, tables: dict[str, DataFrame], monthly: dict[str, DataFrame] | None = None, **published) -> Core:
        return cls(*(tables[name] for name in ENTITIES), monthly=monthly or {}, **published)

    def row_count(self, name: str) -> int:
        """Rows of a table: known from the load, or else counted."""
        return self.rows[name] if name in self.rows else self.tables()[name].count()

    def by_date(self, name: str) -> DataFrame:
        """The table for a filter on its date: with the month column if it lies in month folders."""
        return self.monthly.get(name, self.tables()[name])

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(ENTITIES, (self.patients, self.doctors, self.appointments, self.treatments, self.billing)))

    def register_views(self) -> None:
        """Make the tables known to ``spark.sql`` under their entity names."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def commit_path(root: str) -> str:
    return f"{root.rstrip('/')}/_published"


def core_path(root: str, run: str, entity: Entity) -> str:
    return f"{root.rstrip('/')}/run={run}/core/{entity.name.lower()}"


def latest_run(spark: SparkSession, root: str):
    """The row of the last published run, or None if nothing was published yet."""
    if not path_exists(spark, commit_path(root)):
        return None
    log = spark.read.schema(COMMIT_SCHEMA).json(commit_path(root))
    # A line that is still being written has no number yet.
    return log.where("sequence is not null").orderBy(F.desc("sequence"), F.desc("published_at"), F.desc("run")).first()


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Published runs, the last first: one line of the log per load."""
    if latest_run(spark, root) is None:
        return []
    log = spark.read.schema(COMMIT_SCHEMA).json(commit_path(root)).where("sequence is not null")
    return [row.run for row in log.orderBy(F.desc("sequence"), F.desc("published_at"), F.desc("run")).collect()]


def open_core(spark: SparkSession, root: str) -> Core:
    """The tables of the last published run under ``root``."""
    commit = latest_run(spark, root)
    if commit is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    paths = {e.name: core_path(root, commit.run, e) for e in ENTITIES.values()}
    collation, visits = commit.collation, core_path(root, commit.run, VISITS)
    return Core.of(
        {e.name: read_core_table(spark, e, paths[e.name], collation) for e in ENTITIES.values()},
        {name: read_monthly(spark, ENTITIES[name], paths[name], collation) for name in commit.by_month},
        visits=read_core_table(spark, VISITS, visits, collation) if commit.has_visits else None,
        rows=commit.rows or {},
    )


def read_core_table(spark: SparkSession, entity: Entity, path: str, collation: str | None = None) -> DataFrame:
    """A core table: the columns of the entity, however its files are laid out."""
    return spark.read.schema(entity.ddl_with(collation)).parquet(path).select(*entity.columns)


def read_monthly(spark: SparkSession, entity: Entity, path: str, collation: str | None = None) -> DataFrame:
    """A core table in month folders, with the month as column ``_month``."""
    return spark.read.schema(f"{entity.ddl_with(collation)}, {MONTH} date").parquet(path)
