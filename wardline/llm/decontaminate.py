"""Benchmark decontamination: items that stand in documents up to a share of edited words.

An item of n words leaks into a document if some stretch of the document's words has an edit
distance (words inserted, removed, replaced) of at most ``floor(n * EDITED)`` to it. Words are runs of
bytes other than ASCII white space, A-Z as a-z; each character of a script that is written
without blanks (Chinese, Japanese, Thai and others) is a word.

Candidates come from the CGK embedding. A random walk over a string emits its current word at each step and
moves on or stays, as a hash of step and word says; strings at a small edit distance
fall into step again after an edit, so their emitted sequences are at a small Hamming distance.
The longer a walk, the likelier it is to be out of step for long, so items are embedded in pieces of
``PIECE_WORDS`` to twice as many words: one piece at least has no more than its part of the edits. Windows
of the size of the pieces, one from every word on, are embedded as well; each
table of the locality-sensitive hashing has a walk of its own and takes ``SAMPLED`` positions of the
sequences, and a window meets the pieces that agree with it there. ``TABLES`` is chosen by what a
piece with a share ``EDITED`` of edited words was seen to need, inserted, removed or replaced. A leak
without edits agrees everywhere. Every meeting is verified by the exact edit
distance around the window.

Windows that cannot be near any piece are not embedded: an edit changes one word, so a
window needs its size less the edits of a piece in words that occur in items at all, and must lie
where a stretch of an item's size holds enough of them as well.

Items are sent to all tasks while their texts take no more than ``SENT_BYTES``; more are handled
in so many passes over the documents.

Defined cases: an item of fewer than ``LEAST_WORDS`` words leaks as an exact copy, if it has
``LEAST_CHARS`` characters or more; shorter ones, null and empty ones say nothing and never leak. Null and empty documents hold no leak. Items with the same words leak alike; repeated
rows report alike. Of equally near places the first counts. Very long texts are searched as a whole.
An empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import batch_chunks, filter_texts, id_and_text, read_table
from wardline.llm.words import BASE, U64, Words, mix, ranges, split_words

# Parameters of the search.
EDITED = 0.2
LEAST_WORDS = 5
#: Characters besides white space that make an item of fewer words worth looking for.
LEAST_CHARS = 20
SAMPLED, TABLES = 2, 24
#: Items are cut into pieces of this many words or more, fewer than twice as many.
PIECE_WORDS = 12
#: Items of as many pieces whose sizes differ by no more than this factor share windows.
SIZE_STEP = 1.15
SENT_BYTES = 32_000_000

LEAK_SCHEMA = "doc_id bigint, item_id bigint, distance int, n_words int, first_word int, last_word int"
NOTHING = U64(0)
#: Windows that walk together, so that they stay in a processor's cache.
WALKED = 8_192


def edits_allowed(n: int) -> int:
    return int(n * EDITED + 1e-9)


def _characters(text: bytes) -> int:
    return len(b"".join(text.split()).decode("utf-8", "replace"))


def _pieces(n: int) -> int:
    return max(1, n // PIECE_WORDS)


@dataclass
class SizeClass:
    """Items of similar size and as many pieces: the size of their windows and how many positions are sampled from."""

    least: int
    most: int
    pieces: int
    steps: int
    samples: np.ndarray  #: per table the sampled positions
    keys: list[np.ndarray] = field(default_factory=list)  #: per table the sorted keys of the pieces
    holders: list[np.ndarray] = field(default_factory=list)  #: whose they are
    offsets: list[np.ndarray] = field(default_factory=list)  #: and where in the item they begin

    @property
    def size(self) -> int:
        return self.least // self.pieces

    @property
    def edits(self) -> int:
        """The best piece of an item has no more."""
        return edits_allowed(self.most) // self.pieces


@dataclass
class ItemIndex:
    ids: list
    words: list[np.ndarray]  #: hashes of the words of each item
    vocabulary: np.ndarray
    classes: list[SizeClass]

    @classmethod
    def build(cls, ids: list, texts: list[bytes]) -> ItemIndex:
        split = split_words(texts, unspaced=True)
        words = [split.hashes[a:b] for a, b in zip(split.first[:-1], split.first[1:])]
        kept = [i for i, w in enumerate(words) if len(w) >= LEAST_WORDS or _characters(texts[i]) >= LEAST_CHARS]
        ids, words = [ids[i] for i in kept], [words[i] for i in kept]
        vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, U64)
        index = cls(ids, words, vocabulary, [])
        sizes = np.array([len(w) for w in words])
        rest = np.argsort(sizes, kind="stable")
        while len(rest):
            least = int(sizes[rest[0]])
            most = min(max(least, int(least * SIZE_STEP)), (_pieces(least) + 1) * PIECE_WORDS - 1)
            own = rest[sizes[rest] <= most]
            rest = rest[len(own) :]
            index.classes.append(index._size_class(least, int(sizes[own].max()), own))
        return index

    def _size_class(self, least: int, most: int, own: np.ndarray) -> SizeClass:
        pieces = _pieces(least)
        size = least // pieces
        # On average a walk moves on at every second step: most sampled positions lie within the window.
        steps = max(SAMPLED, 2 * size - size // 4)
        random = np.random.default_rng(least)
        samples = np.stack([np.sort(random.choice(steps, SAMPLED, replace=False)) for _ in range(TABLES)])
        found = SizeClass(least, most, pieces, steps, samples)
        # A piece's walk may run on into the words behind the piece, as it does in a document.
        text = np.concatenate([np.append(self.words[i], NOTHING) for i in own])
        lengths = np.array([len(self.words[i]) for i in own])
        begins = np.repeat(np.cumsum(lengths + 1) - lengths - 1, pieces)
        offsets = np.tile(np.arange(pieces), len(own)) * np.repeat(lengths // pieces, pieces)
        holders = np.repeat(own, pieces)
        for keys in _table_keys(text, begins + offsets, found):
            order = np.argsort(keys, kind="stable")
            found.keys.append(keys[order])
            found.holders.append(holders[order])
            found.offsets.append(offsets[order])
        return found

    def leaks(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, last word), the nearest place of each item in each text."""
        words = split_words(texts, unspaced=True)
        if not len(words.hashes) or not self.classes:
            return []
        at = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        numbers = np.where(self.vocabulary[at] == words.hashes, at, len(self.vocabulary))
        known = np.concatenate([[0], np.cumsum(numbers < len(self.vocabulary))])
        lengths = np.diff(words.first)
        begins, limits = np.repeat(words.first[:-1], lengths), np.repeat(words.first[1:], lengths)
        padded = np.insert(words.hashes, words.first[1:], NOTHING)
        meetings = [self._meetings(padded, words.documents(), known, begins, limits, c) for c in self.classes]
        meetings = [m for m in meetings if len(m[0])]
        if not meetings:
            return []
        starts, items = (np.concatenate(x) for x in zip(*meetings))
        return self._verify(words, numbers, starts, items)

    def _meetings(
        self,
        padded: np.ndarray,
        documents: np.ndarray,
        known: np.ndarray,
        begins: np.ndarray,
        limits: np.ndarray,
        own: SizeClass,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Items that a window agrees with in a table, and the words that they would begin with."""
        starts = _windows(known, limits, own)
        pairs = []
        if len(starts):
            least = begins[starts]
            # Each text ahead has an end of its own there.
            walked = _table_keys(padded, starts + documents[starts], own)
            tables = zip(walked, own.keys, own.holders, own.offsets)
            for keys, table, holders, offsets in tables:
                low, high = np.searchsorted(table, keys, "left"), np.searchsorted(table, keys, "right")
                met = np.repeat(np.arange(len(starts)), high - low)
                at = ranges(low, high - low)
                first = np.maximum(starts[met] - offsets[at], least[met])
                pairs.append(np.unique(first * len(self.ids) + holders[at]))
        found = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        return found // len(self.ids), found % len(self.ids)

    def _verify(
        self, words: Words, numbers: np.ndarray, starts: np.ndarray, items: np.ndarray
    ) -> list[tuple[int, int, int, int, int]]:
        texts = np.searchsorted(words.first, starts, "right") - 1
        # Meetings of one item in one text that lie close are verified as one stretch.
        order = np.lexsort((starts, texts, items))
        starts, items, texts = starts[order], items[order], texts[order]
        sizes = np.array([len(w) for w in self.words])[items]
        opens = np.ones(len(starts), bool)
        opens[1:] = (items[1:] != items[:-1]) | (texts[1:] != texts[:-1]) | (starts[1:] - starts[:-1] > sizes[1:])
        first = np.flatnonzero(opens)
        last = np.append(first[1:] - 1, len(starts) - 1)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        there = np.zeros(len(self.vocabulary) + 1, bool)
        own = {i: np.searchsorted(self.vocabulary, self.words[i]) for i in np.unique(items).tolist()}
        for a, b in zip(first.tolist(), last.tolist()):
            item, text = int(items[a]), int(texts[a])
            wanted = self.words[item]
            reach = edits_allowed(len(wanted))
            low = max(int(starts[a]) - len(wanted) - reach, int(words.first[text]))
            high = min(int(starts[b]) + 2 * len(wanted) + reach, int(words.first[text + 1]))
            # Each edit costs one word at most: enough of the item's words must be there at all.
            there[numbers[low:high]] = True
            held = np.count_nonzero(there[own[item]])
            there[numbers[low:high]] = False
            if held < len(wanted) - reach:
                continue
            distance, end = _nearest(wanted, words.hashes[low:high])
            if distance <= reach and (found := best.get((text, item), (1 << 30,)))[0] >= distance:
                begin = end - _length(wanted, words.hashes[low : low + end])
                place = (distance, low + begin - int(words.first[text]), low + end - 1 - int(words.first[text]))
                if place < found:
                    best[text, item] = place
        return [(text, item, *place) for (text, item), place in sorted(best.items())]


def _windows(known: np.ndarray, limits: np.ndarray, own: SizeClass) -> np.ndarray:
    """The first words of windows that hold enough words of items.

    ``known`` counts the words of items ahead of each word.
    """
    n, reach = len(limits), edits_allowed(own.most)
    # Where an item may begin; a piece of it begins no further on than the item can reach.
    whole = _rich(known, limits, np.arange(n), own.least, reach)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, np.maximum(whole - own.size, 0), 1)
    np.add.at(marks, np.minimum(whole + own.most + reach, n), -1)
    return _rich(known, limits, np.flatnonzero(np.cumsum(marks[:n])), own.size, own.edits)


def _rich(known: np.ndarray, limits: np.ndarray, starts: np.ndarray, size: int, edits: int) -> np.ndarray:
    """Those of ``starts`` from where on ``size`` words hold all but ``edits`` words of items."""
    # Counted across text ends first; few are left to be looked at closely.
    ends = np.minimum(starts + size, len(limits))
    starts = starts[known[ends] - known[starts] >= size - edits]
    ends = np.minimum(starts + size, limits[starts])
    return starts[known[ends] - known[starts] >= size - edits]


def _table_keys(padded: np.ndarray, starts: np.ndarray, own: SizeClass) -> Iterator[np.ndarray]:
    """The key of each window in each table. ``NOTHING`` ends a text; a walk stays there, as its product is 0."""
    multipliers = mix(np.arange(1, TABLES * own.steps + 1, dtype=U64)).reshape(TABLES, own.steps) | U64(1)
    for sampled, walk in zip(own.samples.tolist(), multipliers):
        keys = np.zeros(len(starts), U64)
        for low in range(0, len(starts), WALKED):
            place, part = starts[low : low + WALKED].copy(), keys[low : low + WALKED]
            word = np.empty(len(place), U64)
            for step in range(sampled[-1] + 1):
                np.take(padded, place, out=word, mode="clip")
                if step in sampled:
                    part *= U64(BASE)
                    part += word
                # The highest bit of a product: as good as drawn anew for each step and word.
                word *= walk[step]
                word >>= U64(63)
                place += word.view(np.int64)
        yield keys


def _nearest(wanted: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance between ``wanted`` and a stretch of ``text``, and where that ends; the first of equals."""
    row, steps = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for word in wanted:
        row = _next_row(row, text != word, steps)
    end = int(np.argmin(row))
    return int(row[end]), end


def _length(wanted: np.ndarray, text: np.ndarray) -> int:
    """The length of the shortest nearest stretch that ends where ``text`` ends."""
    steps = np.arange(len(text) + 1)
    row = steps.copy()
    for word in wanted[::-1]:
        row = _next_row(row, text[::-1] != word, steps)
    return int(np.argmin(row))


def _next_row(row: np.ndarray, differs: np.ndarray, steps: np.ndarray) -> np.ndarray:
    new = row + 1
    np.minimum(new[1:], row[:-1] + differs, out=new[1:])
    # Words of the text that are left out, however many.
    return np.minimum.accumulate(new - steps) + steps


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, distance, n_words, first_word, last_word."""
    rows = id_and_text(docs, id_col, text_col)
    leaks = [rows.mapInArrow(_searcher(own), LEAK_SCHEMA) for own in _indexes(items, item_id_col, item_text_col, sent_bytes)]
    return reduce(DataFrame.unionByName, leaks)


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """The rows that no item leaks into, all columns as they are."""
    for own in _indexes(items, item_id_col, item_text_col, sent_bytes):
        docs = filter_texts(docs, text_col, partial(_clean, own))
    return docs


def _clean(shared, texts: list[bytes]) -> np.ndarray:
    clean = np.ones(len(texts), bool)
    clean[[text for text, *_ in shared.value.leaks(texts)]] = False
    return clean


def _indexes(items: DataFrame, id_col: str, text_col: str, sent_bytes: int) -> list:
    """The items in as many broadcast indexes as their size asks for, one at least."""
    named = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"))
    named = named.where(F.length("text") > 0)
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    turns = max(1, -(-size // sent_bytes))
    out = []
    for turn in range(turns):
        part = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(turns)) == turn).collect()
        index = ItemIndex.build([r["item_id"] for r in part], [r["text"].encode("utf-8") for r in part])
        out.append(items.sparkSession.sparkContext.broadcast(index))
    return out


def _searcher(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for ids, texts in batch_chunks(batches):
            leaks = index.leaks(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[text] for text, *_ in leaks], pa.int64()),
                    pa.array([index.ids[item] for _, item, *_ in leaks], pa.int64()),
                    pa.array([d for _, _, d, _, _ in leaks], pa.int32()),
                    pa.array([len(index.words[item]) for _, item, *_ in leaks], pa.int32()),
                    pa.array([a for *_, a, _ in leaks], pa.int32()),
                    pa.array([b for *_, b in leaks], pa.int32()),
                ],
                names=["doc_id", "item_id", "distance", "n_words", "first_word", "last_word"],
            )

    return run


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
