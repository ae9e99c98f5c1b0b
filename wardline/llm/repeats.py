"""Repeated passages: bytes covered by a string of ``SPAN`` bytes that also starts in an earlier document.

Prefix-free parsing. A rolling hash over ``KEY`` bytes places triggers: positions whose hash is the
least among those of some string of ``SPAN`` bytes. The trigger of a string depends on its bytes alone,
so equal strings have their trigger at the same place. Between triggers lie phrases; the phrase of a trigger,
with as much of its neighbours as strings of ``SPAN`` bytes reach into (the parse), holds
every string that the trigger stands for. So all equal strings meet under one trigger hash,
and the sorted suffixes of the phrases there, compared over ``SPAN`` bytes, are the part of the
corpus' suffix order that belongs to it.

1. Triggers: all texts are parsed; a task hands on each trigger hash once, however many of its
   texts hold it, and learns which of them other tasks hold as well. Most text ends here.
2. Dictionary: phrases of shared triggers. A task hands on a phrase once, for its earliest document; the
   same phrase in a later one is a repeat already. Under each trigger hash the suffixes of all
   phrases are sorted, and each run of equal ones gets its earliest document.
3. Strings whose earliest document is an earlier one are marked, and the marked bytes removed.

Texts that equal an earlier text as a whole are found by their SHA-256 first and take no part in 2.
A phrase that a third of all documents hold reaches the sorting task once per task that read some of them.

Suffixes are compared by two 64-bit hashes.

Defined cases: a null text is empty; texts shorter than ``SPAN`` lose nothing. Matches never
cross documents. Rows with the same id are not earlier than each other; a null id is earlier than all
others. Very long texts are parsed as a whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import id_and_text, partitions, read_table, text_bytes, tidied, zipped
from wardline.llm.words import U64, _powers, byte_values, mix, ranges
from wardline.session import materialize

SPAN = 50
KEY = 24
#: Hashes among which a trigger is the least.
REACH = SPAN - KEY + 1

# Bytes of text that a task parses before it hands on what it found.
GATHERED_BYTES = 32_000_000
BLOCK = 1 << 20
#: Bytes of a trigger hash that are handed on; the part it goes to holds more. More triggers than
#: shared ones may look shared, which costs time and changes nothing.
SENT = 5

FIRST = np.iinfo(np.int64).min

TRIGGER_SCHEMA = "part int, batch bigint, hashes binary, counts binary, doc_ids binary, sames binary"
SHARED_SCHEMA = "batch bigint, ordinal int, hashes binary, doc_id bigint, same bigint"
PHRASE_SCHEMA = "part int, batch bigint, zipped binary, starts binary, ends binary, ordinal int, doc_id bigint, same bigint"
MARK_SCHEMA = "batch bigint, ordinal int, starts binary, ends binary, doc_id bigint, same bigint"


# --- parsing ---


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or largest of each ``width`` neighbours, in a logarithmic number of passes."""
    covered = 1
    while covered * 2 <= width:
        values = pick(values[:-covered], values[covered:])
        covered *= 2
    return pick(values[: len(values) - (width - covered)], values[width - covered :]) if covered < width else values


def _rolled(data: np.ndarray, width: int, salt: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(first place, hashes of the ``width`` bytes from each place on), a block of places at a time."""
    n = len(data) - width + 1
    table = byte_values(False) if not salt else mix(byte_values(False) ^ U64(salt))
    for low in range(0, n, BLOCK):
        high = min(low + BLOCK, n)
        forward, back = _powers(2 * BLOCK)
        sums = np.zeros(high - low + width, U64)
        np.cumsum(table[data[low : high + width - 1]] * forward[: high - low + width - 1], out=sums[1:])
        yield low, mix((sums[width : width + high - low] - sums[: high - low]) * back[: high - low])


def rolling_hashes(data: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on."""
    out = np.empty(max(len(data) - width + 1, 0), U64)
    for low, block in _rolled(data, width, salt):
        out[low : low + len(block)] = block
    return out


def hashes_at(data: np.ndarray, width: int, places: np.ndarray) -> np.ndarray:
    """``rolling_hashes`` at ascending places only: eight bytes for each of these, not for each byte of the data."""
    out = np.empty(len(places), U64)
    for low, block in _rolled(data, width):
        first, end = np.searchsorted(places, (low, low + len(block)))
        out[first:end] = block[places[first:end] - low]
    return out


def parse(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Triggers of a text: place, hash, and the first and last start of the strings that each stands for."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < SPAN:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing.view(U64), nothing, nothing
    hashes = rolling_hashes(data, KEY)
    least = _slide(hashes, REACH, np.minimum)
    # The first place from each start on that holds the least hash: where strings share a trigger, it is one run.
    places = np.flatnonzero(hashes[: len(hashes)] == _reached(least, len(hashes)))
    at = np.searchsorted(places, np.arange(len(least)))
    while True:
        wrong = hashes[places[at]] != least
        if not wrong.any():
            break
        at[wrong] += 1
    used = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    places = places[at[used]]
    return places, hashes[places], used, np.concatenate([used[1:] - 1, [len(least) - 1]])


def _reached(least: np.ndarray, n: int) -> np.ndarray:
    """For each hash the largest least value of the strings that hold it: its own if it is a trigger."""
    padded = np.concatenate([np.zeros(REACH - 1, U64), least, np.zeros(REACH - 1, U64)])
    return _slide(padded, REACH, np.maximum)[:n]


def _parse_all(texts: list[bytes]) -> list[tuple[np.ndarray, ...]]:
    return [parse(t) for t in texts]


# --- triggers that several documents hold ---


def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    """(doc ids, text hashes, texts) of about ``GATHERED_BYTES``."""
    ids, sames, texts, size = [], [], [], 0
    for batch in batches:
        for i, s, t in zip(batch.column("doc_id").to_pylist(), batch.column("same").to_pylist(), text_bytes(batch.column("text"))):
            ids.append(i)
            sames.append(s)
            texts.append(t)
            size += len(t)
            if size >= GATHERED_BYTES:
                yield ids, sames, texts
                ids, sames, texts, size = [], [], [], 0
    if ids:
        yield ids, sames, texts


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> U64(40)) % U64(parts)).astype(np.int64)


def _shared_triggers(docs: DataFrame) -> DataFrame:
    """Per document the trigger hashes that other documents hold too: doc_id, same, hashes (sorted, SENT bytes each)."""
    parts = 4 * partitions(docs.sparkSession)

    def triggers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, (ids, sames, texts) in enumerate(_gather(batches)):
            batch = TaskContext.get().partitionId() << 32 | turn
            found = [np.unique(p[1]) for p in _parse_all(texts)]
            hashes = np.concatenate(found)
            ordinals = np.repeat(np.arange(len(found)), [len(f) for f in found])
            # A hash of several texts of this task is known to be shared: it is sent for the first
            # of them, marked by being listed under one ordinal more than there are texts.
            order = np.argsort(hashes, kind="stable")
            hashes, ordinals = hashes[order], ordinals[order]
            first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            several = np.zeros(len(hashes), bool)
            several[1:] |= ~first[1:]
            several[:-1] |= ~first[1:]
            # Texts' own hashes that need no answer.
            local = np.flatnonzero(several)
            by_text = np.argsort(ordinals[local], kind="stable")
            known = np.split(hashes[local][by_text], np.searchsorted(ordinals[local][by_text], np.arange(1, len(ids))))
            yield _table(
                TRIGGER_SCHEMA,
                part=np.full(len(ids), batch % parts, np.int32),
                batch=np.full(len(ids), batch),
                hashes=[_sent(k) for k in known],
                counts=[int(i).to_bytes(4, "little") for i in range(len(ids))],
                doc_ids=[b"" if i is None else int(i).to_bytes(8, "little", signed=True) for i in ids],
                sames=[int(s).to_bytes(8, "little", signed=True) for s in sames],
            )
            sent = np.where(several, len(ids), ordinals)[first]
            hashes = hashes[first]
            part = _parts_of(hashes, parts)
            order = np.lexsort((sent, part))
            numbers, starts = np.unique(part[order], return_index=True)
            cuts = [*starts.tolist(), len(order)]
            rows = [(order[a:b]) for a, b in zip(cuts, cuts[1:])]
            none = [None] * len(rows)
            yield _table(
                TRIGGER_SCHEMA,
                part=numbers.astype(np.int32),
                batch=np.full(len(rows), batch),
                hashes=[_sent(hashes[r]) for r in rows],
                counts=[np.bincount(sent[r], minlength=len(ids) + 1).astype("<u4").tobytes() for r in rows],
                doc_ids=none,
                sames=none,
            )

    def shared(table: pa.Table) -> pa.Table:
        out = {"batch": [], "ordinal": [], "hashes": [], "doc_id": [], "same": []}
        hashes, batches, ordinals, texts = [], [], [], {}
        for row in zip(*(table.column(c).to_pylist() for c in ("batch", "hashes", "counts", "doc_ids", "sames"))):
            batch, sent, counts, doc_id, same = row
            if same is not None:
                out["batch"].append(batch)
                out["ordinal"].append(int.from_bytes(counts, "little"))
                out["hashes"].append(sent)
                out["doc_id"].append(int.from_bytes(doc_id, "little", signed=True) if doc_id else None)
                out["same"].append(int.from_bytes(same, "little", signed=True))
                continue
            counts = np.frombuffer(counts, "<u4")
            texts[batch] = len(counts) - 1
            hashes.append(_received(sent))
            batches.append(np.full(len(hashes[-1]), batch))
            ordinals.append(np.repeat(np.arange(len(counts)), counts))
        if hashes:
            hashes, batches, ordinals = (np.concatenate(x) for x in (hashes, batches, ordinals))
            order = np.argsort(hashes, kind="stable")
            same_as_next = hashes[order][1:] == hashes[order][:-1]
            held = np.zeros(len(hashes), bool)
            held[order[1:]] |= same_as_next
            held[order[:-1]] |= same_as_next
            limits = np.array([texts[b] for b in batches.tolist()]) if len(texts) > 1 else np.full(len(batches), next(iter(texts.values())))
            # What several texts of a task hold was known there.
            asked = np.flatnonzero(held & (ordinals < limits))
            asked = asked[np.lexsort((hashes[asked], ordinals[asked], batches[asked]))]
            b, o = batches[asked], ordinals[asked]
            starts = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (o[1:] != o[:-1])])) if len(asked) else []
            cuts = [*np.asarray(starts).tolist(), len(asked)]
            for low, high in zip(cuts, cuts[1:]):
                out["batch"].append(int(b[low]))
                out["ordinal"].append(int(o[low]))
                out["hashes"].append(_sent(hashes[asked[low:high]]))
                out["doc_id"].append(None)
                out["same"].append(None)
        return pa.table(_arrays(SHARED_SCHEMA, out))

    answers = docs.mapInArrow(tidied(triggers), TRIGGER_SCHEMA).groupBy("part").applyInArrow(shared, SHARED_SCHEMA)
    answers = materialize(answers, "shared-triggers")
    named = (
        answers.groupBy("batch", "ordinal")
        .agg(F.max("doc_id").alias("doc_id"), F.max("same").alias("same"), F.collect_list("hashes").alias("hashes"))
        .where(F.exists("hashes", lambda h: F.length(h) > 0))
    )
    # Rows that agree in id and text have the same triggers.
    return named.groupBy("doc_id", "same").agg(F.max("hashes").alias("hashes"))


def _sent(hashes: np.ndarray) -> bytes:
    """The lower bytes of hashes."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT]).tobytes()


def _received(sent: bytes) -> np.ndarray:
    out = np.zeros((len(sent) // SENT, 8), np.uint8)
    out[:, :SENT] = np.frombuffer(sent, np.uint8).reshape(-1, SENT)
    return out.reshape(-1).view("<u8").astype(U64)


LOW = U64((1 << (8 * SENT)) - 1)


# --- phrases of shared triggers ---


def _marks(docs: DataFrame) -> DataFrame:
    """Per document the starts and ends of repeated strings: doc_id, same, starts, ends (lists of arrays).

    ``docs`` has doc_id, same, zipped and hashes.
    """
    parts = 4 * partitions(docs.sparkSession)

    def phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        turn, rows, size = 0, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "same", "zipped", "hashes"))
            for doc_id, same, zipped, hashes in zip(*columns):
                rows.append((doc_id, same, unpack.decompress(zipped), _received(b"".join(hashes))))
                size += len(rows[-1][2])
                if size >= GATHERED_BYTES:
                    yield from _phrase_rows(rows, TaskContext.get().partitionId() << 32 | turn, parts)
                    turn, rows, size = turn + 1, [], 0
        if rows:
            yield from _phrase_rows(rows, TaskContext.get().partitionId() << 32 | turn, parts)

    found = docs.mapInArrow(tidied(phrases), PHRASE_SCHEMA).groupBy("part").applyInArrow(_sorted_phrases, MARK_SCHEMA)
    found = materialize(found, "repeat-marks")
    named = (
        found.groupBy("batch", "ordinal")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("same").alias("same"),
            F.collect_list("starts").alias("starts"),
            F.collect_list("ends").alias("ends"),
        )
        .where(F.exists("starts", lambda s: F.length(s) > 0))
    )
    return named.groupBy("doc_id", "same").agg(F.max(F.struct("starts", "ends")).alias("m")).select("doc_id", "same", "m.starts", "m.ends")


def _order(doc_id: int | None) -> int:
    return FIRST if doc_id is None else doc_id


def _phrase_rows(rows: list[tuple], batch: int, parts: int) -> Iterator[pa.RecordBatch]:
    """What a task finds in its texts: a row per text with the repeats that it can tell, and its phrases by part."""
    offsets, hashes, starts, lasts, ordinals = [], [], [], [], []
    limit = 0
    for ordinal, (_, _, text, shared) in enumerate(rows):
        places, own, first, last = parse(text)
        keep = np.flatnonzero(np.isin(own & LOW, shared))
        offsets.append(np.full(len(keep), limit))
        hashes.append(own[keep])
        starts.append(first[keep])
        lasts.append(last[keep])
        ordinals.append(np.full(len(keep), ordinal))
        limit += len(text)
    offsets, hashes, starts, lasts, ordinals = (np.concatenate(x) for x in (offsets, hashes, starts, lasts, ordinals))
    data = np.frombuffer(b"".join([r[2] for r in rows]), np.uint8)
    ids = np.array([_order(r[0]) for r in rows], np.int64)
    lengths = lasts - starts + SPAN
    # Phrases that are the same, earliest document first: only it asks, later ones are repeats.
    content = _range_hashes(data, offsets + starts, lengths)
    order = np.lexsort((ids[ordinals], content, hashes))
    same = np.zeros(len(order), bool)
    same[1:] = (content[order][1:] == content[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else order
    later = same & (ids[ordinals[order]] > ids[ordinals[order[leader]]])
    repeated, asking = order[later], order[~later]

    by_text = repeated[np.argsort(ordinals[repeated], kind="stable")]
    cuts = np.searchsorted(ordinals[by_text], np.arange(len(rows) + 1)).tolist()
    n = len(rows)
    yield _table(
        PHRASE_SCHEMA,
        part=np.full(n, batch % parts, np.int32),
        batch=np.full(n, batch),
        zipped=[None] * n,
        starts=[starts[by_text[a:b]].astype("<i8").tobytes() for a, b in zip(cuts, cuts[1:])],
        ends=[(lasts[by_text[a:b]] + SPAN).astype("<i8").tobytes() for a, b in zip(cuts, cuts[1:])],
        ordinal=np.arange(n, dtype=np.int32),
        doc_id=[r[0] for r in rows],
        same=[r[1] for r in rows],
    )
    part = _parts_of(hashes[asking], parts)
    asking = asking[np.argsort(part, kind="stable")]
    numbers, first = np.unique(np.sort(part), return_index=True)
    cuts = [*first.tolist(), len(asking)]
    pack = zstandard.ZstdCompressor(level=3)
    packed = []
    for low, high in zip(cuts, cuts[1:]):
        a = asking[low:high]
        texts = data[ranges(offsets[a] + starts[a], lengths[a])]
        head = np.array([len(a)], "<i8").tobytes()
        fields = (starts[a].astype("<i8"), ordinals[a].astype("<i4"), ids[ordinals[a]].astype("<i8"), lengths[a].astype("<i4"))
        packed.append(pack.compress(head + b"".join([f.tobytes() for f in fields]) + texts.tobytes()))
    n, none = len(packed), [None] * len(packed)
    yield _table(
        PHRASE_SCHEMA,
        part=numbers.astype(np.int32),
        batch=np.full(n, batch),
        zipped=packed,
        starts=none,
        ends=none,
        ordinal=none,
        doc_id=none,
        same=none,
    )


def _range_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes, by its first and last ``SPAN`` bytes, which cover it, and its length.

    Neither the ranges' starts nor their middles or ends go back.
    """
    middle = (lengths - SPAN) // 2
    first, second, third = (hashes_at(data, SPAN, starts + more) for more in (0, middle, lengths - SPAN))
    return mix(first * U64(3) + second * U64(5) + third * U64(7) + lengths.astype(U64))


def _sorted_phrases(table: pa.Table) -> pa.Table:
    """Sort the suffixes of all phrases of a part; mark strings that an earlier document holds."""
    out = {"batch": [], "ordinal": [], "starts": [], "ends": [], "doc_id": [], "same": []}
    unpack = zstandard.ZstdDecompressor()
    fields: list[list] = [[], [], [], [], [], []]
    columns = (table.column(c).to_pylist() for c in ("batch", "zipped", "starts", "ends", "ordinal", "doc_id", "same"))
    for batch, zipped, starts, ends, ordinal, doc_id, same in zip(*columns):
        if zipped is None:
            for name, value in zip(out, (batch, ordinal, starts, ends, doc_id, same)):
                out[name].append(value)
            continue
        blob = unpack.decompress(zipped)
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        at = 8
        for target, kind in zip(fields, ("<i8", "<i4", "<i8", "<i4")):
            target.append(np.frombuffer(blob, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        fields[4].append(np.frombuffer(blob, np.uint8, offset=at))
        fields[5].append(np.full(n, batch))
    if fields[0]:
        starts, ordinals, ids, lengths, data, batches = (np.concatenate(f) for f in fields)
        begins = np.cumsum(lengths) - lengths
        counts = lengths - SPAN + 1
        suffix = ranges(begins, counts)
        owner = np.repeat(np.arange(len(starts)), counts)
        one, two = rolling_hashes(data, SPAN)[suffix], rolling_hashes(data, SPAN, salt=0x5DEECE66D)[suffix]
        order = np.lexsort((two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        earliest = np.minimum.reduceat(ids[owner[order]], np.flatnonzero(new))
        marked = np.zeros(len(order), bool)
        marked[order] = earliest[np.cumsum(new) - 1] < ids[owner[order]]
        # Runs of marked strings inside a phrase.
        hit = np.flatnonzero(marked)
        if len(hit):
            opens = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])])
            first, last = hit[opens], hit[np.append(np.flatnonzero(opens)[1:] - 1, len(hit) - 1)]
            of = owner[first]
            low = starts[of] + suffix[first] - begins[of]
            high = starts[of] + suffix[last] - begins[of] + SPAN
            by_text = np.lexsort((low, ordinals[of], batches[of]))
            b, o = batches[of][by_text], ordinals[of][by_text]
            cuts = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (o[1:] != o[:-1])])).tolist() + [len(b)]
            for x, y in zip(cuts, cuts[1:]):
                out["batch"].append(int(b[x]))
                out["ordinal"].append(int(o[x]))
                out["starts"].append(low[by_text[x:y]].astype("<i8").tobytes())
                out["ends"].append(high[by_text[x:y]].astype("<i8").tobytes())
                out["doc_id"].append(None)
                out["same"].append(None)
    return pa.table(_arrays(MARK_SCHEMA, out))


# --- removal ---


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint runs that cover the same bytes; runs that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[opens], ends[np.append(np.flatnonzero(opens)[1:] - 1, len(ends) - 1)]


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with their repeated runs: doc_id, zipped, copy (the whole text is an earlier document's), starts, ends."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("same"))
    place = F.coalesce("doc_id", F.lit(int(FIRST)))
    hashed = rows.select("doc_id", "same", place.alias("place"), F.unhex(F.sha2("text", 256)).alias("whole"))
    # Written, so that the join below splits a text with very many copies.
    earliest = materialize(hashed.groupBy("whole").agg(F.min("place").alias("least"), F.count("*").alias("n")), "wholes")
    copies = materialize(
        hashed.join(earliest.where("n > 1"), "whole").where("place > least").select("doc_id", "same").distinct(), "copies"
    )
    shared = materialize(_shared_triggers(rows), "triggers-by-text")
    packed = zipped(rows)
    with_ids = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["same"] == b["same"])
    asked = shared.join(copies, with_ids(shared, copies), "left_anti")
    marks = _marks(packed.join(asked, with_ids(packed, asked)).select(packed["*"], asked["hashes"]))
    found = materialize(
        marks.withColumn("copy", F.lit(False)).unionByName(
            copies.withColumns({"starts": F.array().cast("array<binary>"), "ends": F.array().cast("array<binary>"), "copy": F.lit(True)})
        ),
        "repeats",
    )
    joined = packed.join(found, with_ids(packed, found), "left")
    return joined.select(packed["doc_id"], "zipped", F.coalesce("copy", F.lit(False)).alias("copy"), "starts", "ends")


REMOVED_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, figures, kept in _cut(batches):
            yield _removed(ids, figures, pa.array(kept, pa.binary()), "kept")

    return find_repeats(docs, id_col, text_col).mapInArrow(tidied(run), REMOVED_SCHEMA)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        ids, figures, kept = [], [], []
        for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "zipped", "copy", "starts", "ends"))):
            doc_id, zipped, copy, starts, ends = row
            text = unpack.decompress(zipped)
            runs, left = [], text
            if copy:
                runs, left = ([(0, len(text))], b"") if len(text) >= SPAN else ([], text)
            elif starts:
                low, high = merged(*(np.frombuffer(b"".join(x), "<i8") for x in (starts, ends)))
                runs = list(zip(low.tolist(), high.tolist()))
                edges = [0, *(e for run in runs for e in run), len(text)]
                left = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])
            ids.append(doc_id)
            figures.append((len(text), sum(b - a for a, b in runs), len(runs)))
            kept.append(left)
        yield ids, figures, kept


def _removed(ids: list, figures: list, last: pa.Array, name: str) -> pa.RecordBatch:
    columns = [pa.array([f[k] for f in figures], pa.int64()) for k in range(3)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), *columns, last], names=["doc_id", "n_bytes", "n_removed", "n_spans", name]
    )


def _arrays(schema: str, columns: dict) -> dict:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return {name: pa.array(columns[name], kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))}


def _table(schema: str, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(_arrays(schema, columns))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, figures, kept in _cut(batches):
            yield _removed(ids, figures, pa.array([hashlib.sha256(k).hexdigest() for k in kept]), "kept_sha256")

    found = find_repeats(read_table(spark, sf_dir, "documents"))
    return found.mapInArrow(tidied(digest), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
