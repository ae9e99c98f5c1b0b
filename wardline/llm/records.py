"""Token ids in files of length-delimited binary records, with an offset index beside them.

A record is framed as: payload length (8 bytes, little-endian), masked CRC-32C of these 8
bytes (4 bytes), payload, masked CRC-32C of the payload (4 bytes). The payload is the id of
the document (8 bytes, signed), a byte that is 0 if the document has no id, a byte with the
width of a token id, and the token ids. Files lie under ``data/`` and hold about
``SHARD_BYTES``; documents are in ascending order of their id within a file, from one file of
a part to the next, and from part to part.

The index is a Parquet table under ``index/``: one row per record with its file, offset,
length and number of tokens. It says where each record is, so that records can be read in
any order, and it is what makes a file count: files are written under fresh names, and only
those of the task attempts that Spark commits are named by the index. What lost or repeated
attempts leave behind is not referred to.

Defined cases: a null or empty text is a record with the end id alone. A null id comes first.
Repeated rows are repeated records, in any order among themselves. A very long text is one
record. An empty table gives an empty index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm import crc32c
from wardline.llm.common import batch_chunks, id_and_text, partitions, read_table, tidied
from wardline.llm.word_bpe import encoder
from wardline.session import qualified_path, scratch_path

SHARD_BYTES = 64_000_000
# Texts encoded in one go. The first group takes a worker from 155 to 230 MB; one of 2 MB takes it to 265.
ENCODED_BYTES = 500_000
# Two records closer than this in a file are read in one go.
READ_BYTES = 8_000_000

HEAD = struct.Struct("<QI")
LABEL = struct.Struct("<qBB")
LABEL_BYTES = LABEL.size

INDEX_SCHEMA = (
    "doc_id bigint, part int, file string, file_offset bigint, length bigint, tokens_before bigint, n_tokens bigint"
)
RECORD_SCHEMA = "doc_id bigint, part int, tokens_before bigint, ids binary"


def write_records(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write records and index; return the index."""
    spark = docs.sparkSession
    ordered = (
        id_and_text(docs, id_col, text_col)
        .repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    )

    # A path without a scheme means the same place to workers as to Spark.
    path = qualified_path(spark, path)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        shard, tokens = None, 0
        codec = encoder(tokenizer)
        end, width = np.array([end_id], codec.id_type).tobytes(), int(codec.id_type[-1])
        try:
            for ids, texts in batch_chunks(batches, ENCODED_BYTES):
                if shard is None or shard.size >= SHARD_BYTES:
                    shard = _close(shard) or _Shard(path)
                tokens_of, limits = codec.encode_all(texts)
                limits = limits.tolist()
                payloads = [
                    _label(i, width) + tokens_of[low:high].tobytes() + end
                    for i, low, high in zip(ids, limits, limits[1:])
                ]
                counts = np.array([(len(p) - LABEL_BYTES) // width for p in payloads], np.int64)
                before = tokens + np.cumsum(counts) - counts
                tokens += int(counts.sum())
                offsets = shard.append(payloads)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array([shard.name] * len(ids), pa.string()),
                        pa.array(offsets),
                        pa.array([len(p) for p in payloads], pa.int64()),
                        pa.array(before),
                        pa.array(counts),
                    ],
                    names=["doc_id", "part", "file", "file_offset", "length", "tokens_before", "n_tokens"],
                )
        finally:
            _close(shard)

    index = f"{path}/index"
    ordered.mapInArrow(tidied(write), INDEX_SCHEMA).write.parquet(index)
    return spark.read.schema(INDEX_SCHEMA).parquet(index)


def read_records(index: DataFrame, path: str) -> DataFrame:
    """The records that the rows of ``index`` name: doc_id, part, tokens_before, ids (unsigned 32 bits each).

    Lengths and checksums are verified; a damaged record is an error.
    """
    path = qualified_path(index.sparkSession, path)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("file", "file_offset", "length"))))
            places = {
                (f, o): (p, b)
                for f, o, p, b in zip(
                    *(batch.column(c).to_pylist() for c in ("file", "file_offset", "part", "tokens_before"))
                )
            }
            for found in _frames(path, rows):
                parts, befores = zip(*(places[place] for place, _ in found))
                decoded = [_decode(payload) for _, payload in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in decoded], pa.int64()),
                        pa.array(parts, pa.int32()),
                        pa.array(befores, pa.int64()),
                        pa.array([ids for _, ids in decoded], pa.binary()),
                    ],
                    names=["doc_id", "part", "tokens_before", "ids"],
                )

    return index.mapInArrow(tidied(read), RECORD_SCHEMA)


def part_starts(index: DataFrame) -> DataFrame:
    """Tokens ahead of each part: one row per written part, far fewer than documents."""
    sums = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("tokens").over(above), F.lit(0)).alias("part_start"))


class _Shard:
    def __init__(self, path: str):
        self._files, root = _file_system(path)
        self._files.create_dir(f"{root}/data", recursive=True)
        self.name = f"data/{uuid.uuid4().hex}.rec"
        self.size = 0
        self._out = self._files.open_output_stream(f"{root}/{self.name}")

    def append(self, payloads: list[bytes]) -> np.ndarray:
        """Write the records; return the offset of each."""
        lengths = [struct.pack("<Q", len(p)) for p in payloads]
        heads = crc32c.masked(crc32c.crc32c(lengths)).astype("<u4")
        sums = crc32c.masked(crc32c.crc32c(payloads)).astype("<u4")
        frames = [n + h.tobytes() + p + s.tobytes() for n, h, p, s in zip(lengths, heads, payloads, sums)]
        sizes = np.array([len(f) for f in frames], np.int64)
        offsets = self.size + np.cumsum(sizes) - sizes
        self._out.write(b"".join(frames))
        self.size += int(sizes.sum())
        return offsets

    def close(self) -> None:
        self._out.close()


def _close(shard: _Shard | None) -> None:
    if shard is not None:
        shard.close()


def _file_system(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _frames(path: str, rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[tuple[str, int], bytes]]]:
    """Read the records at (file, offset, payload length), neighbours together."""
    files, root = _file_system(path)
    at = 0
    while at < len(rows):
        name, start, length = rows[at]
        stop, last = start + length + HEAD.size + 4, at
        while last + 1 < len(rows) and rows[last + 1][0] == name and rows[last + 1][1] - start < READ_BYTES:
            last += 1
            stop = rows[last][1] + rows[last][2] + HEAD.size + 4
        with files.open_input_file(f"{root}/{name}") as source:
            data = source.read_at(stop - start, start)
        group = rows[at : last + 1]
        payloads = [data[o - start + HEAD.size : o - start + HEAD.size + n] for _, o, n in group]
        heads = crc32c.masked(crc32c.crc32c([data[o - start : o - start + 8] for _, o, _ in group]))
        sums = crc32c.masked(crc32c.crc32c(payloads))
        for (_, o, n), head, total in zip(group, heads.tolist(), sums.tolist()):
            stored = HEAD.unpack_from(data, o - start)
            if stored != (n, head) or struct.unpack_from("<I", data, o - start + HEAD.size + n) != (total,):
                raise ValueError(f"damaged record at byte {o} of {name}")
        yield [((name, o), p) for (_, o, _), p in zip(group, payloads)]
        at = last + 1


def _label(doc_id: int | None, width: int) -> bytes:
    return LABEL.pack(doc_id or 0, doc_id is not None, width)


def _decode(payload: bytes) -> tuple[int | None, bytes]:
    doc_id, present, width = LABEL.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=LABEL.size).astype("<u4")
    return doc_id if present else None, ids.tobytes()


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "records")
    docs = read_table(spark, sf_dir, "documents")
    index = write_records(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    batch.column("tokens_before"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                ],
                names=["doc_id", "part", "tokens_before", "n_tokens", "ids_crc32"],
            )

    read = read_records(index.repartition("file"), path)
    digests = read.mapInArrow(digest, "doc_id bigint, part int, tokens_before bigint, n_tokens bigint, ids_crc32 bigint")
    return digests.join(part_starts(index), "part").select(
        "doc_id", (F.col("part_start") + F.col("tokens_before")).alias("start"), "n_tokens", "ids_crc32"
    )
