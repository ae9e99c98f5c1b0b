"""Alignment of the tokens of two tokenizers, a byte-level BPE (A) and a SentencePiece BPE (B), by the bytes they cover.

Both read a text with a blank ahead of it. In each batch, two as-of joins of pandas, keyed by the
stretch of text that a token lies in, find for the start of each token the token of the other side that covers it. The union of both directions is
all pairs of tokens whose bytes overlap (the links): of two such tokens, the one that starts later starts
inside the other. Offsets where tokens of both sides end cut the tokens into groups.

Texts are taken in stretches that neither tokenizer reaches across: they begin with a line end, or a single blank,
after a character other than white space. A task keeps what it found for the stretches that it meets most, up to ``KEPT_BYTES``. Texts without such places are one stretch each.

Texts are read once. The different pairs of ids that each document links, and how often, are written to the shared
folder beside its other figures, and counted over all documents from there; counting combines before it shuffles. The pairs
that occur most, as many as ``FREQUENT_PAIRS`` allows, go to all tasks, with their counts; links of the others
meet their counts in a join, where no pair has more rows than the least frequent of the former.

Defined cases: a text that is null or empty, or that the bytes of either side's tokens do not give
back (B writes U+2581 for a blank, so texts with that sign are such), has no tokens: all counts are 0 and its groups are ''.
A text of any length is aligned as a whole. Special tokens in a text are plain text. Rows
are independent but for the counts, where each of several equal rows counts; null ids are kept. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import batch_chunks, id_and_text, read_table
from wardline.llm.words import WHITE, Lookup, ranges, span_hashes
from wardline.session import materialize

# Pairs of ids whose counts go to all tasks: 17 bytes each.
FREQUENT_PAIRS = 1 << 18
# What a task keeps of the stretches it has aligned.
KEPT_BYTES = 48_000_000
# New stretches are encoded in runs of about this many bytes.
RUN_BYTES = 200_000

BLANK = "\u2581"
SIGN = BLANK.encode()
SHIFT = 32


# --- the two tokenizers ---


class _Vocabulary:
    """The bytes of each token."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self._starts = np.cumsum(self.lengths) - self.lengths
        self._data = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self._data[ranges(self._starts[ids], self.lengths[ids])]


def _byte_signs() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteSide:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        signs, tokens = _byte_signs(), {i: t for t, i in self._tokenizer.get_vocab().items()}
        spelled = [bytes(signs.get(c, 0x3F) for c in tokens.get(i, "")) for i in range(max(tokens) + 1)]
        self.vocabulary = _Vocabulary(spelled)
        with open(path, encoding="utf-8") as source:
            kind = json.load(source).get("pre_tokenizer") or {}
        #: Whether words are cut off ahead of white space, as the usual byte-level pattern does.
        self.cuts = kind.get("type") == "ByteLevel" and bool(kind.get("use_regex", True))

    def encode(self, spaced: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(spaced, add_special_tokens=False).ids, np.int64)


class PieceSide:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.vocabulary = _Vocabulary([_spelled(model, i, p) for i, p in enumerate(pieces)])
        self.cuts = not any(BLANK in p.lstrip(BLANK) or ("\n" in p and p != "\n") for p in pieces)

    def encode(self, spaced: str) -> np.ndarray:
        """Ids of a text that is given with a blank, or another sign that begins a stretch, ahead; the library adds the blank itself."""
        if spaced.startswith(" "):
            return np.array(self._model.encode(spaced[1:]), np.int64)
        return np.array(self._model.encode(spaced)[1:], np.int64)


def _spelled(model, i: int, piece: str) -> bytes:
    if model.is_byte(i):
        return bytes([int(piece[1:-1], 16)])
    return piece.replace(BLANK, " ").encode()


@lru_cache(maxsize=2)
def sides(byte_tokenizer: str, piece_model: str) -> tuple[ByteSide, PieceSide]:
    """One of each per worker process."""
    return ByteSide(byte_tokenizer), PieceSide(piece_model)


# --- links and groups of a batch ---


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` (document, start; in the order of start) that cover a byte in common, ordered by both."""
    a, b = a.assign(a=np.arange(len(a))), b.assign(b=np.arange(len(b)))
    under = pd.merge_asof(a, b, on="start", by="document")
    over = pd.merge_asof(b, a, on="start", by="document")
    # Tokens that start together are found from both sides.
    found = pd.concat([under[["a", "b"]], over[["a", "b"]]]).drop_duplicates().sort_values(["a", "b"])
    return found["a"].to_numpy(np.int64), found["b"].to_numpy(np.int64)


class _Packed:
    """Arrays of several lengths in one, by number."""

    def __init__(self, dtype):
        self.data = np.zeros(0, dtype)
        self._starts = self.lengths = np.zeros(0, np.int64)

    def extend(self, data: np.ndarray, lengths: np.ndarray) -> None:
        self._starts = np.concatenate([self._starts, len(self.data) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.data = np.concatenate([self.data, data])

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        return self.data[ranges(self._starts[numbers], self.lengths[numbers])]

    def only(self, numbers: np.ndarray) -> _Packed:
        out = _Packed(self.data.dtype)
        out.extend(self.gather(numbers), self.lengths[numbers])
        return out

    @property
    def nbytes(self) -> int:
        return self.data.nbytes + 16 * len(self.lengths)


class Aligner:
    """Aligns texts group by group; one per task."""

    def __init__(self, byte_tokenizer: str, piece_model: str):
        self._a, self._b = sides(byte_tokenizer, piece_model)
        self._cuts = self._a.cuts and self._b.cuts
        # Each id as digits, and room for the mark after it.
        ids = range(max(len(self._a.vocabulary.lengths), len(self._b.vocabulary.lengths)))
        self._digits = _Vocabulary([b"%d," % i for i in ids])
        self._known = Lookup()
        self._uses = np.zeros(0, np.int64)  #: groups of texts that had the stretch
        self.links = _Packed(np.int64)  #: pairs of ids, A above ``SHIFT``, of each stretch
        self._groups = _Packed(np.uint8)  #: of each stretch as text, every group with ';' after it
        self._tallies = np.zeros((0, 4), np.int64)  #: tokens of A, of B, groups, and 1 for a stretch that is not given back

    def _forget(self) -> None:
        """Keep the stretches that were met most, as many as take half of the room."""
        size = 32 + 24 * 3 + 8 * self.links.lengths + self._groups.lengths
        order = np.argsort(-self._uses, kind="stable")
        kept = np.sort(order[np.cumsum(size[order]) <= KEPT_BYTES // 2])
        keys = np.empty(len(self._known), np.uint64)
        keys[self._known.numbers] = self._known.keys
        self._known = Lookup()
        self._known.add(keys[kept])
        self._uses, self._tallies = self._uses[kept], self._tallies[kept]
        self.links, self._groups = self.links.only(kept), self._groups.only(kept)

    def _stretches(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts, a blank ahead of each; starts and ends of the stretches; and where texts begin among them."""
        ahead = [b" " + t if t else b"" for t in texts]
        data = np.frombuffer(b"".join([*ahead, b"  "]), np.uint8)
        limits = np.cumsum([0] + [len(t) for t in ahead])
        size = int(limits[-1])
        begins = np.zeros(size + 1, bool)
        if self._cuts and size > 2:
            begins[2:size] = self._ends_word(data[:size])[1:-1]
            begins[:size] &= (data[:size] == 0x0A) | ((data[:size] == 0x20) & ~WHITE[data[1 : size + 1]])
        begins[limits] = True
        starts = np.flatnonzero(begins[:size])
        return data, starts, np.append(starts[1:], size)[: len(starts)], np.searchsorted(starts, limits)

    @staticmethod
    def _ends_word(data: np.ndarray) -> np.ndarray:
        """Whether a character ends at each byte that is no white space for either side: ASCII signs and letters of two bytes."""
        ends = (data > 0x20) & (data < 0x7F)
        ends[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        return ends

    def align(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each stretch of the texts, where texts begin among them, and tallies by text
        (tokens of A, of B, groups, links); all 0 for a text that is not given back."""
        data, starts, ends, first = self._stretches(texts)
        unique, sample, which = np.unique(span_hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        if self.nbytes > KEPT_BYTES:
            self._forget()
        numbers = self._known.find(unique)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            at = sample[new]
            self._learn([data[low:high].tobytes() for low, high in zip(starts[at].tolist(), ends[at].tolist())], self._ends_word(data)[ends[at] - 1])
            self._known.add(unique[new])
            self._uses = np.concatenate([self._uses, np.zeros(len(new), np.int64)])
            numbers[new] = self._known.find(unique[new])
        self._uses[numbers] += 1
        numbers = numbers[which]
        sums = between(np.column_stack([self._tallies[numbers], self.links.lengths[numbers]]), first)
        sums[sums[:, 3] > 0] = 0
        return numbers, first, sums[:, [0, 1, 2, 4]]

    def spellings(self, numbers: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The groups of each text: ``a1,a2|b1;a3|b2,b3``."""
        joined = self._groups.gather(numbers).tobytes()
        at = np.concatenate([[0], np.cumsum(self._groups.lengths[numbers])])[first].tolist()
        return [joined[low : max(low, high - 1)] for low, high in zip(at, at[1:])]

    @property
    def nbytes(self) -> int:
        return self.links.nbytes + self._groups.nbytes + 40 * len(self._tallies) + 16 * len(self._known)

    # --- new stretches ---

    def _learn(self, stretches: list[bytes], ends_word: np.ndarray) -> None:
        # Another stretch may follow one that ends a word in the same run; texts with the sign for a blank are taken alone.
        ends = ends_word & ~np.array([SIGN in s for s in stretches])
        together, alone = np.flatnonzero(ends), np.flatnonzero(~ends).tolist()
        sizes = np.cumsum([len(stretches[i]) for i in together.tolist()])
        cuts = np.flatnonzero(np.diff(sizes // RUN_BYTES)) + 1 if len(together) else []
        runs = [run.tolist() for run in np.split(together, cuts) if len(run)] + [[i] for i in alone]
        self._keep(len(stretches), [part for run in runs for part in self._encoded(stretches, run)])

    def _encoded(self, stretches: list[bytes], run: list[int]) -> Iterator[tuple]:
        """Tokens of both sides for the stretches of a run: (their numbers, their limits, ids of A, of B), or None for the ids."""
        joined = b"".join([stretches[i] for i in run])
        text = joined.decode("utf-8")
        a, b = self._a.encode(text), self._b.encode(text)
        wanted = np.frombuffer(joined, np.uint8)
        if all(np.array_equal(side.vocabulary.spell(ids), wanted) for side, ids in ((self._a, a), (self._b, b))):
            yield run, np.cumsum([0] + [len(stretches[i]) for i in run]), a, b
        elif len(run) > 1:
            for i in run:
                yield from self._encoded(stretches, [i])
        else:
            yield run, None, None, None

    def _keep(self, n: int, parts: list[tuple]) -> None:
        """Align the stretches of all parts in one go and store what was found under their numbers."""
        bad = [i for run, limits, _, _ in parts if limits is None for i in run]
        good = [p for p in parts if p[1] is not None]
        order = np.array([i for run, *_ in good for i in run] + bad, np.int64)
        tallies = np.zeros((n, 4), np.int64)
        tallies[len(order) - len(bad) :, 3] = 1
        none = np.zeros(0, np.int64)
        offsets = np.cumsum([0] + [int(limits[-1]) for _, limits, _, _ in good])
        a = np.concatenate([none, *(p[2] for p in good)])
        b = np.concatenate([none, *(p[3] for p in good)])
        limits = np.concatenate([none, *(p[1][1:] + at for p, at in zip(good, offsets))])
        ends_a, ends_b = np.cumsum(self._a.vocabulary.lengths[a]), np.cumsum(self._b.vocabulary.lengths[b])
        starts_a, starts_b = ends_a - self._a.vocabulary.lengths[a], ends_b - self._b.vocabulary.lengths[b]
        of_a, of_b = np.searchsorted(limits, starts_a, "right"), np.searchsorted(limits, starts_b, "right")
        at_a, at_b = overlaps(
            pd.DataFrame({"document": of_a, "start": starts_a}), pd.DataFrame({"document": of_b, "start": starts_b})
        )
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        of_group = np.searchsorted(limits, common)
        tallies[: len(limits), :3] = np.column_stack([np.bincount(x, minlength=len(limits)) for x in (of_a, of_b, of_group)])
        links = (a[at_a] << SHIFT) | b[at_b]
        counts = np.bincount(of_a[at_a], minlength=n)
        written, lengths = self._written(a, b, group_a, group_b, np.append(of_a, of_b), n)
        # What was found lies in the order of the parts: back to the order of the stretches.
        back = np.argsort(order, kind="stable")
        self._tallies = np.concatenate([self._tallies, tallies[back]])
        self.links.extend(*_reordered(links, counts, back))
        self._groups.extend(*_reordered(written, lengths, back))


    def _written(self, a, b, group_a, group_b, stretch, n) -> tuple[np.ndarray, np.ndarray]:
        """All groups as text, joined, and how much of it belongs to each stretch."""
        group = np.append(group_a, group_b)
        of_b = np.append(np.zeros(len(a), bool), np.ones(len(b), bool))
        order = np.argsort(group * 2 + of_b, kind="stable")
        ids, group, of_b, stretch = np.append(a, b)[order], group[order], of_b[order], stretch[order]
        sizes = self._digits.lengths[ids]
        out = self._digits.spell(ids)
        last = np.ones(len(ids), bool)
        last[:-1] = (group[1:] != group[:-1]) | (of_b[1:] != of_b[:-1])
        out[np.cumsum(sizes)[last] - 1] = np.where(of_b[last], ord(";"), ord("|"))
        return out, np.bincount(stretch, weights=sizes, minlength=n).astype(np.int64)


def _reordered(data: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum(lengths) - lengths
    return data[ranges(starts[order], lengths[order])], lengths[order]


def between(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows from one start to the next."""
    sums = np.concatenate([np.zeros((1, rows.shape[1]), rows.dtype), np.cumsum(rows, axis=0)])
    return sums[first[1:]] - sums[first[:-1]]


# --- whole tables ---


def align_documents(docs: DataFrame, byte_tokenizer: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, and groups, the ids of A and B of each group in order,
    written ``a1,a2|b1;a3|b2,b3``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_tokenizer, piece_model)
        for ids, texts in batch_chunks(batches):
            numbers, first, tallies = aligner.align(texts)
            groups = [g.decode() if n else "" for g, n in zip(aligner.spellings(numbers, first), tallies[:, 0])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c) for c in tallies.T), pa.array(groups, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"],
            )

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def linked_pairs(docs: DataFrame, byte_tokenizer: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row (a number of its own), doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (of the groups as
    ``align_documents`` writes them; '' without tokens), and pairs and times: the different pairs of ids that it links, the id of A above
    the ``SHIFT`` lowest bits, and how many links hold each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_tokenizer, piece_model)
        for batch in batches:
            at, rows = 0, batch.column("row")
            for ids, texts in batch_chunks([batch]):
                own, at = rows.slice(at, len(ids)), at + len(ids)
                numbers, first, tallies = aligner.align(texts)
                spelled = zip(aligner.spellings(numbers, first), tallies[:, 0])
                pairs, times, limits = _pairs_by_text(aligner, numbers, first, tallies[:, 0] > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        own,
                        pa.array(ids, pa.int64()),
                        *(pa.array(c) for c in tallies.T),
                        pa.array([hashlib.sha256(g).hexdigest() if n else "" for g, n in spelled], pa.string()),
                        pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(pairs)),
                        pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(times, pa.int32())),
                    ],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    schema = (
        "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<bigint>, times array<int>"
    )
    numbered = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return numbered.mapInArrow(run, schema)


def _pairs_by_text(aligner: Aligner, numbers: np.ndarray, first: np.ndarray, given: np.ndarray):
    """The different pairs of each text, joined, how often it links each, and where texts start among them."""
    lengths = aligner.links.lengths[numbers]
    different, pair = np.unique(aligner.links.gather(numbers), return_inverse=True)
    text = np.repeat(np.repeat(np.arange(len(given)), np.diff(first)), lengths)
    keys, times = np.unique((text * len(different) + pair)[given[text]], return_counts=True)
    width = max(len(different), 1)
    return different[keys % width], times, np.searchsorted(keys, np.arange(len(given) + 1) * width)


def count_pairs(linked: DataFrame) -> DataFrame:
    """How many links of all documents hold each pair of ids, and whether no pair with the same id of B has more: pair, n, best."""
    each = linked.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))))
    pairs = materialize(each.groupBy("pair").agg(F.sum("n").alias("n")), "token-pairs")
    id_b = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    # At most one row per token of B.
    highest = pairs.groupBy(id_b.alias("id_b")).agg(F.max("n").alias("highest"))
    return pairs.join(F.broadcast(highest), id_b == F.col("id_b")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def link_scores(linked: DataFrame, pairs: DataFrame, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """The rows of ``linked`` with n_best (links whose pair is the best of its id of B) and count_sum (of all links), without their pairs."""
    least = _least_frequent(pairs, frequent_pairs)
    # At most ``frequent_pairs`` rows of three numbers.
    frequent = pairs.where(F.col("n") >= least).orderBy("pair").toPandas()
    table = [frequent[c].to_numpy(np.int64) for c in ("pair", "n", "best")]
    shared = linked.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _scored(shared.value, batch)

    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ", ".join(f"{c} {dict(linked.dtypes)[c]}" for c in kept)
    more = "n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>"
    scored = materialize(linked.mapInArrow(run, f"{schema}, {more}"), "token-scores")
    others = scored.where(F.size("pairs") > 0).select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    added = (
        others.join(pairs.where(F.col("n") < least), "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more"))
    )
    total = {
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
    }
    return scored.join(added, "row", "left").withColumns(total).select(*kept, *total)


def _least_frequent(pairs: DataFrame, most: int) -> int:
    """The least power of two that no more than ``most`` pairs reach in count."""
    # One row per power of two.
    sizes = {r["power"]: r["count"] for r in pairs.groupBy(F.length(F.bin("n")).alias("power")).count().collect()}
    power, above = 64, 0
    while power > 1 and above + sizes.get(power - 1, 0) <= most:
        power -= 1
        above += sizes.get(power, 0)
    return 1 << (power - 1)


def _scored(table: list[np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
    """Figures from the pairs that the table has; the others stay in the lists."""
    known_pairs, counts, best = table
    lists = batch.column("pairs")
    pairs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    scores = np.zeros((len(pairs), 3), np.int64)
    known = np.zeros(len(pairs), bool)
    if len(known_pairs):
        at = np.minimum(np.searchsorted(known_pairs, pairs), len(known_pairs) - 1)
        known = known_pairs[at] == pairs
        scores[:, 0], scores[:, 1] = best[at] * times * known, counts[at] * times * known
    scores[:, 2] = ~known
    sums = between(scores, first)
    limits = pa.array(np.concatenate([[0], np.cumsum(sums[:, 2])]), pa.int32())
    rest = [pa.ListArray.from_arrays(limits, pa.array(x[~known], t)) for x, t in ((pairs, pa.int64()), (times, pa.int32()))]
    names = [c for c in batch.schema.names if c not in ("pairs", "times")]
    columns = [batch.column(c) for c in names]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(sums[:, 0]), pa.array(sums[:, 1]), *rest], names=[*names, "n_best", "count_sum", "pairs", "times"]
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    linked = materialize(linked_pairs(read_table(spark, sf_dir, "documents"), *paths), "token-links")
    pairs = materialize(count_pairs(linked), "token-pair-counts")
    return link_scores(linked, pairs).drop("row")
