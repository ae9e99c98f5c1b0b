"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wardline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", os.path.join(os.environ.get("TMPDIR", "/tmp"), "wardline-warehouse"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Partitions that fit in memory are joined by hashing instead of sorting.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        # In one process a shuffle is cheaper than collecting and hashing a mid-size table.
        .config("spark.sql.autoBroadcastJoinThreshold", "2m")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, one subfolder per application.

    Taken from ``spark.checkpoint.dir``; without it, a folder in the warehouse, which is
    shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/wardline-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to its scratch folder; results read from there end with it."""
    delete_path(spark, scratch_root(spark))


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority of its file system, the default one if it names none."""
    files, place = _file_system(spark, path)
    return files.makeQualified(place).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``, unless there is one of that name: then leave it and return False."""
    files, place = _file_system(spark, path)
    files.mkdirs(place.getParent())
    if files.getScheme() == "file":
        # The local file system of the JVM looks first and creates afterwards.
        try:
            with open(place.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
            return True
        except FileExistsError:
            return False
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if files.exists(place):
            return False
        raise error
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def list_folders(spark: SparkSession, path: str) -> list[str]:
    files, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that later passes neither recompute it nor depend on the
    executors that produced it, and gives later passes a column-pruned scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# What a task takes on: rows of a shuffled table, bytes of a shuffle as AQE puts parts of it together, bytes of a file.
ROWS_A_TASK = 500_000
SHUFFLED_A_TASK = "8m"
READ_A_TASK = "16m"

_lock = threading.Lock()
# By session: how many run inside ``bounded_tasks``, and what was set before the first of them.
_inside: WeakKeyDictionary = WeakKeyDictionary()


@contextmanager
def bounded_tasks(spark: SparkSession, rows: int = 0) -> Iterator[None]:
    """What runs inside is cut into tasks that sort and hash in memory, however large the tables: more tasks, not larger ones.

    ``rows`` are those of the largest table, if known. A hash table of keys that are all different, or a sort, has the size of a task's
    input; when it outgrows the task's memory it is written and read again, several times what the shuffle itself
    moves. What a query has shuffled is removed when it ends: it would else lie on the executors' disks until the driver happens to
    collect garbage. Settings of the session that ask for smaller tasks stay. They are the caller's again afterwards; of several threads
    inside, the last one out restores them.
    """
    partitions, shuffled, read, removed = (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
    )
    with _lock:
        number, before = _inside.get(spark, (0, None))
        if before is None:
            before = {name: spark.conf.get(name) for name in (partitions, shuffled, read, removed)}
        _inside[spark] = number + 1, before
        if int(spark.conf.get(partitions)) < rows // ROWS_A_TASK:
            spark.conf.set(partitions, str(rows // ROWS_A_TASK))
        for name, most in ((shuffled, SHUFFLED_A_TASK), (read, READ_A_TASK)):
            if _bytes(spark.conf.get(name)) > _bytes(most):
                spark.conf.set(name, most)
        spark.conf.set(removed, "true")
    try:
        yield
    finally:
        with _lock:
            number, before = _inside.pop(spark)
            if number > 1:
                _inside[spark] = number - 1, before
            else:
                for name, value in before.items():
                    spark.conf.set(name, value)


def _bytes(size: str) -> int:
    """A size as Spark writes it: a number of bytes, or one with a unit such as ``64m`` or ``128MB``."""
    number, unit = re.fullmatch(r"\s*([0-9]+)\s*([kmgtp]?)(?:i?b)?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")
