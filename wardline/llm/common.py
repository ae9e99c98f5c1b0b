"""Helpers that the text operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.session import materialize

# Texts are handled in groups of about this many bytes inside a task, so that memory does
# not depend on the size of an Arrow batch.
CHUNK_BYTES = 2_000_000
# An Arrow batch holds at most about this many bytes, however long its texts are.
BATCH_BYTES = 2_000_000
DEFAULT_BATCH = "67108864b"
# Rows of a few numbers that one file of an intermediate table may hold.
FILE_ROWS = 1_000_000


def prepare(spark: SparkSession) -> None:
    """Settle what all Python stages need.

    Workers find this package where the driver found it, if they see that folder; a cluster
    that does not brings the package by --py-files or has it installed. Arrow batches are
    bounded by bytes, so that long texts do not make large batches, unless the session
    chose a bound itself.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) == DEFAULT_BATCH:
        spark.conf.set(bound, BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on; a missing text is an empty one."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many signs after it as it takes to be no column of ``df``, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, label: str, rows: int) -> DataFrame:
    """``materialize`` for a table of at most ``rows`` short rows: as many files as these need."""
    return materialize(df.coalesce(max(1, -(-rows // FILE_ROWS))), label)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column without nulls."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def chunks(ids: list, texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Cut the rows of a batch into pieces of about ``limit`` bytes."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield ids[start : i + 1], texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield ids[start:], texts[start:]


def batch_chunks(
    batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES
) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of batches with the columns doc_id and text, in pieces."""
    for batch in batches:
        yield from chunks(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), limit)


def zipped(docs: DataFrame) -> DataFrame:
    """Texts packed for a shuffle, two thirds of what Spark's own codec makes of them: column text becomes zipped."""
    prepare(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([pack.compress(t) for t in text_bytes(batch.column("text"))], pa.binary())
            kept = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), packed], names=[*kept, "zipped"])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("zipped", T.BinaryType())]))


def tidied(work: Callable) -> Callable:
    """``work`` on the batches of a task, which gives back the memory it no longer needs when it ends.

    Worker processes outlive their tasks, and what one stage has freed stays theirs unless they return it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return run


def filter_texts(docs: DataFrame, text_col: str, keeps: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows whose text ``keeps`` marks, all columns as they are; a null text counts as an empty one."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(text_col).fill_null(""))
            marks = [keeps(part) for _, part in chunks(texts, texts)]
            if marks:
                yield batch.filter(pa.array(np.concatenate(marks).astype(bool)))

    return docs.mapInArrow(tidied(run), docs.schema)
