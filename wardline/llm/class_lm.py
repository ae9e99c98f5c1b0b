"""Scoring texts by a class-based bigram model whose classes come from exchange clustering.

Words are counted over all training documents. Clustering goes from coarse to fine. First the symbols are the
``TOP_WORDS`` most frequent words, one symbol for all other words with the same ending, and the end of a
document; their bigrams are counted over all training documents, and the exchange algorithm moves
symbols between ``CLASSES`` classes as long as the likelihood of the class bigrams grows. Then all other words that occur
``LEAST_COUNT`` times or more, as far as tasks hold them (``HEAD_WORDS``), take part: the classes on either side of each
are counted over all training documents, in a shuffle by word (packed: a row for many words of a task), and each word goes to
the class under which its neighbours are likeliest; class bigrams are counted anew, and so on until their likelihood no longer
grows by ``SETTLED`` a token. So both levels go on until the exchange has come to rest, however many sweeps and rounds that
takes. Texts are cut into words once for all rounds, which read them as numbers. Seldom words stay with their ending. A word has the
probability

    P(class | class before) * P(word | class),

the first smoothed by the class frequencies, the second by ``DELTA`` added to the count of each
training word of the class and to one place for all unseen words with endings of the class.

Word counts grow with the corpus, so they are not sent to every task. Those of at most
``HEAD_WORDS`` frequent words are (some 6 MB); counts of other words meet the texts that hold
them in a shuffle by word, each task having summed up a text's uses of a word before. No frequent
word takes part in that shuffle, so none of its keys is hot.

Words are told apart by 64-bit hashes; among 10^9 different words the chance that any two
share one is 3 %.

Defined cases: a null or empty text is its end alone. Rows are scored one by one, so repeated
ids and null ids stay apart; a null id counts as the text '' where the split is decided. Without training
documents the base probability is that of an unseen token in an empty corpus. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import BATCH_BYTES, batch_chunks, crc_mod, id_and_text, partitions, read_table, tidied
from wardline.llm.words import U64, Words, mix, split_words
from wardline.session import materialize

# Parameters of the model.
TOP_WORDS = 1_024
LEAST_COUNT = 2
ENDINGS = 256
CLASSES = 48
HEAD_WORDS = 1 << 18
DELTA = 0.1
#: Weight of the class frequencies against the counts that follow a class.
PRIOR = 10.0
#: Words have come to rest when a round adds less than this to the log-likelihood (natural) of a token.
SETTLED = 0.001

END = ENDINGS + TOP_WORDS
SYMBOLS = END + 1

# Bytes of text that a task looks at together; its arrays are many times as large.
TEXT_BYTES = 500_000
# Entries for the shuffle that a task gathers before it hands them on.
GATHERED = 1_000_000
COUNT_SCHEMA = "word bigint, ending int, n bigint"
# Units (4 bytes each) in a row of an intermediate table; readers hold thousands of rows at once.
UNITS_A_ROW = 4_096
UNIT_SCHEMA = "units binary"
PAIR_SCHEMA = "pair bigint, n bigint"
NEIGHBOUR_SCHEMA = "part int, keys binary, times binary"
LOCAL_SCHEMA = (
    "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, "
    "part int, words binary, rows binary, times binary"
)


def _endings(words: Words, which: np.ndarray) -> np.ndarray:
    """A number below ``ENDINGS`` for the last two bytes of each word."""
    last = words.data[words.ends[which] - 1].astype(np.int64)
    before = words.data[np.maximum(words.ends[which] - 2, 0)].astype(np.int64)
    before = np.where(words.ends[which] - words.starts[which] > 1, before, 0)
    return ((last | 0x20) * 31 + (before | 0x20) * 7) % ENDINGS


# --- counting ---


def count_words(docs: DataFrame) -> DataFrame:
    """How often each word occurs: word (hash), ending, n."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batch_chunks(batches):
            words = split_words(texts)
            unique, sample, n = np.unique(words.hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(unique.view(np.int64)),
                    pa.array(_endings(words, sample).astype(np.int32)),
                    pa.array(n.astype(np.int64)),
                ],
                names=["word", "ending", "n"],
            )

    counted = docs.mapInArrow(tidied(count), COUNT_SCHEMA)
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> DataFrame:
    """The most frequent words, at most ``limit``: all words that occur so often that no more do."""
    step = F.floor(F.log2("n") * 64)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    least, total = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["words"]
        if total > limit:
            break
        least = row["step"]
    return counts.where(F.lit(False) if least is None else step >= least)


def as_units(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Texts as numbers of units (see ``Vocabulary.units``), in rows that each begin with the unit that the row before ends with."""
    if docs.columns == ["units"]:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batch_chunks(batches, TEXT_BYTES):
            units = shared.value.units(split_words(texts))[0].astype(np.int32)
            rows = [units[at : at + UNITS_A_ROW + 1].tobytes() for at in range(0, len(units) - 1, UNITS_A_ROW)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["units"])

    return docs.mapInArrow(tidied(cut), UNIT_SCHEMA)


def _neighbours(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units and those that follow them, about ``limit`` bytes of them at a time."""
    rows, size = [], 0
    for batch in batches:
        for units in batch.column("units").to_pylist():
            rows.append(np.frombuffer(units, np.int32))
            size += len(units)
            if size >= limit:
                yield np.concatenate([r[:-1] for r in rows]), np.concatenate([r[1:] for r in rows])
                rows, size = [], 0
    if rows:
        yield np.concatenate([r[:-1] for r in rows]), np.concatenate([r[1:] for r in rows])


def _bigrams(docs: DataFrame, vocabulary: Vocabulary, of_units: np.ndarray, size: int) -> np.ndarray:
    """The matrix of how often one symbol (or class) follows another, from the symbol of each unit."""
    shared = docs.sparkSession.sparkContext.broadcast(of_units)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for first, second in _neighbours(batches, TEXT_BYTES):
            total += np.bincount(shared.value[first] * size + shared.value[second], minlength=len(total))
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total[pairs])], names=["pair", "n"])

    counted = as_units(docs, vocabulary).mapInArrow(tidied(count), PAIR_SCHEMA).groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((size, size))
    table.ravel()[counted["pair"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    return table


def count_pairs(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Bigrams of symbols over all documents."""
    return _bigrams(docs, vocabulary, vocabulary.of_units(), SYMBOLS)


@dataclass
class Vocabulary:
    """Frequent words in sorted hash order, with their counts and symbols."""

    words: np.ndarray
    counts: np.ndarray
    endings: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, head) -> Vocabulary:
        """From the columns of ``frequent_words``."""
        words = head["word"].to_numpy(np.int64).view(U64)
        counts, endings = head["n"].to_numpy(np.int64), head["ending"].to_numpy(np.int64)
        top = np.lexsort((words, -counts))[:TOP_WORDS]
        symbols = endings.copy()
        symbols[top] = ENDINGS + np.arange(len(top))
        order = np.argsort(words)
        return cls(words[order], counts[order], endings[order], symbols[order])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def units(self, words: Words) -> tuple[np.ndarray, ...]:
        """All texts as numbers - of held words, then those of the endings of all others, then that of the end -, an end ahead of
        the first and after each; the place of each word in them, the different words, which of them each word is, and where
        these are found."""
        unique, sample, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        found = self.find(unique)
        of_unique = np.where(found >= 0, found, len(self.words) + _endings(words, sample))
        units = np.full(len(words.hashes) + len(words.first), len(self.words) + ENDINGS, np.int64)
        places = np.arange(len(words.hashes)) + words.documents() + 1
        units[places] = of_unique[which]
        return units, places, unique, which, found

    def of_units(self, classes: Classes | None = None) -> np.ndarray:
        """The symbol, or class, of each unit."""
        if classes is None:
            return np.concatenate([self.symbols, np.arange(ENDINGS), [END]])
        return np.concatenate([classes.of_word, classes.of_ending, [classes.of_end]])

    def sequence(self, words: Words, classes: Classes | None = None) -> tuple[np.ndarray, ...]:
        """What ``units`` returns, with symbols (or classes) for units."""
        units, *rest = self.units(words)
        return self.of_units(classes)[units], *rest


@dataclass
class Classes:
    """The class of each word of a vocabulary, of the other words by their endings, and of the end."""

    of_word: np.ndarray
    of_ending: np.ndarray
    of_end: int


# --- clustering ---


def exchange_clusters(pairs: np.ndarray, classes: int = CLASSES, sweeps: int | None = None) -> np.ndarray:
    """The class of each symbol, from the matrix of symbol bigrams; the last symbol, the end, keeps a class of its own.

    Each sweep offers every symbol, the frequent first, all classes, and takes the one with which
    sum N(a, b) log N(a, b) - sum N(a) log N(a) - sum N(b) log N(b) over class bigrams is largest.
    Only symbols are moved, never counted again: the class table is kept up to date. Sweeps go on until no symbol moves, or
    for ``sweeps``, if given.
    """
    size, own = len(pairs), classes - 1
    totals = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-totals[:-1], kind="stable")
    member = np.zeros(size, np.int64)
    member[order] = np.arange(size - 1) % own
    member[-1] = own
    table = _by_class(pairs, member, classes)
    # A gain has to exceed what rounding may add; else two symbols could change places for ever.
    least = max(1e-9, 1e-12 * float(_xlogx(pairs.sum())))
    moved = sweeps is None or sweeps > 0
    while moved:
        moved = 0
        for symbol in order[totals[order] > 0]:
            moved += _exchange(pairs, member, table, symbol, own, least)
        if sweeps is not None:
            sweeps -= 1
            moved = moved and sweeps
    return member


def _by_class(pairs: np.ndarray, member: np.ndarray, classes: int) -> np.ndarray:
    """Bigrams of classes, from those of symbols."""
    own = np.zeros((classes, len(pairs)))
    own[member, np.arange(len(pairs))] = 1
    return own @ pairs @ own.T


def _exchange(pairs, member, table, symbol, own, least) -> bool:
    classes = len(table)
    follows = np.bincount(member, weights=pairs[symbol], minlength=classes)
    leads = np.bincount(member, weights=pairs[:, symbol], minlength=classes)
    loop = float(pairs[symbol, symbol])
    old = member[symbol]
    follows[old] -= loop
    leads[old] -= loop
    rest = table.copy()
    rest[old] -= follows
    rest[:, old] -= leads
    rest[old, old] -= loop
    # The change of the likelihood if the symbol joins class c: row c, column c and their crossing.
    gain = (_xlogx(rest + follows) - _xlogx(rest)).sum(1) + (_xlogx(rest + leads[:, None]) - _xlogx(rest)).sum(0)
    cross = rest.diagonal()
    gain += _xlogx(cross + follows + leads + loop) - _xlogx(cross + follows) - _xlogx(cross + leads) + _xlogx(cross)
    out, into = follows.sum() + loop, leads.sum() + loop
    # How often a class is the first or the second of two: its bigrams with the symbol count whatever class that joins.
    first, second = rest.sum(1) + leads, rest.sum(0) + follows
    gain -= _xlogx(first + out) - _xlogx(first) + _xlogx(second + into) - _xlogx(second)
    new = int(np.argmax(gain[:own]))
    if gain[new] <= gain[old] + least:
        return False
    member[symbol] = new
    rest[new] += follows
    rest[:, new] += leads
    rest[new, new] += loop
    table[:] = rest
    return True


def count_neighbours(docs: DataFrame, vocabulary: Vocabulary, classes: Classes, moves: np.ndarray, parts: int) -> DataFrame:
    """How often each of the words to be moved stands beside a class, in rows of many counts: part (the word's number modulo
    ``parts``), keys (the number divided by ``parts``, times 2 * ``CLASSES``, plus the class after the word, or ``CLASSES`` and the
    class ahead of it) and times, as arrays. Other rows may hold more of a key's count."""
    moving = np.concatenate([moves, np.zeros(ENDINGS + 1, bool)])
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.of_units(classes), moving))
    width = 2 * CLASSES

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_units, moving = shared.value
        gathered, held = [], 0
        for first, second in _neighbours(batches, TEXT_BYTES):
            own, next_own = moving[first], moving[second]
            after = first[own].astype(np.int64) * width + of_units[second[own]]
            ahead = second[next_own].astype(np.int64) * width + CLASSES + of_units[first[next_own]]
            gathered.append(np.unique(np.concatenate([after, ahead]), return_counts=True))
            held += len(gathered[-1][0])
            if held > GATHERED:
                gathered = [_summed(gathered)]
                held = len(gathered[0][0])
                # Fewer are kept, as most of what comes later is among them.
                if held > GATHERED // 2:
                    yield from _pieces(_neighbour_rows(*gathered.pop(), parts))
                    held = 0
        if held:
            yield from _pieces(_neighbour_rows(*_summed(gathered), parts))

    return as_units(docs, vocabulary).mapInArrow(tidied(count), NEIGHBOUR_SCHEMA)


def _summed(gathered: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys, each once, with the sums of their counts."""
    keys, n = (np.concatenate(x) for x in zip(*gathered))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _neighbour_rows(keys: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """Counts of words and classes beside them, a row for each part of the shuffle."""
    word, beside = np.divmod(keys, 2 * CLASSES)
    numbers, (keys, n) = _packed(word % parts, word // parts * (2 * CLASSES) + beside, n)
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers.astype(np.int32)), pa.array(keys, pa.binary()), pa.array(n, pa.binary())], names=["part", "keys", "times"]
    )


def count_classes(docs: DataFrame, vocabulary: Vocabulary, classes: Classes) -> np.ndarray:
    """Bigrams of classes over all documents."""
    return _bigrams(docs, vocabulary, vocabulary.of_units(classes), CLASSES)


def best_classes(beside: np.ndarray, table: np.ndarray, own: int) -> np.ndarray:
    """The class of each word, from the classes after and ahead of it (a row each): that under which the words of its bigrams
    are likeliest, all else as it is. No word joins the class of the end."""
    smooth = table + PRIOR / len(table)
    log_next = np.log(smooth / smooth.sum(1, keepdims=True))
    after, ahead = beside[:, : len(table)], beside[:, len(table) :]
    gain = after @ log_next.T + ahead @ log_next - after.sum(1)[:, None] * np.log(smooth.sum(0))
    gain[:, own] = -np.inf
    return np.argmax(gain, axis=1)


def move_words(docs: DataFrame, vocabulary: Vocabulary, classes: Classes, table: np.ndarray, moves: np.ndarray) -> Classes:
    """Every word to be moved in its best class."""
    tasks = partitions(docs.sparkSession)
    parts = 8 * tasks
    of_end, size = classes.of_end, -(-len(vocabulary.words) // parts)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row for each word of the parts that the task has, however many counts come in.
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, keys, times in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "times"))):
                if part not in tables:
                    tables[part] = np.zeros(size * 2 * CLASSES)
                # A row has no key twice.
                tables[part][np.frombuffer(keys, np.int64)] += np.frombuffer(times, np.int64)
        for part in sorted(tables):
            beside = tables.pop(part).reshape(size, 2 * CLASSES)
            at = np.flatnonzero(beside.any(1))
            chosen = best_classes(beside[at], table, of_end)
            yield pa.RecordBatch.from_arrays([pa.array(at * parts + part), pa.array(chosen)], names=["word", "class"])

    counted = count_neighbours(docs, vocabulary, classes, moves, parts)
    # At most HEAD_WORDS rows.
    chosen = counted.repartition(tasks, "part").mapInArrow(tidied(choose), "word bigint, class bigint").toPandas()
    of_word = classes.of_word.copy()
    of_word[chosen["word"].to_numpy(np.int64)] = chosen["class"].to_numpy(np.int64)
    return Classes(of_word, classes.of_ending, of_end)


def likelihood(table: np.ndarray) -> float:
    """What the classes add to the log-likelihood of the words, from the class bigrams: what the exchange makes large."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def exchange_words(
    docs: DataFrame, vocabulary: Vocabulary, classes: Classes, table: np.ndarray, moves: np.ndarray
) -> tuple[Classes, np.ndarray]:
    """Classes between which the words to be moved have been exchanged until they came to rest, and their bigrams.

    In a round all words move at once. Words that are better off alone may be worse off together: if the likelihood does
    not grow by it, half of them stay, by their hashes, then half of the rest, and so on.
    """
    settled, reached = SETTLED * table.sum(), likelihood(table)
    while moves.any():
        moved = move_words(docs, vocabulary, classes, table, moves)
        going, halved = moved.of_word != classes.of_word, 0
        while going.any():
            tried = Classes(np.where(going, moved.of_word, classes.of_word), classes.of_ending, classes.of_end)
            found = count_classes(docs, vocabulary, tried)
            if (gain := likelihood(found) - reached) > 0:
                break
            going &= (mix(vocabulary.words) >> U64(halved)) & U64(1) == 0
            halved += 1
        if not going.any():
            break
        classes, table, reached = tried, found, reached + gain
        if gain < settled:
            break
    return classes, table


def _xlogx(values: np.ndarray) -> np.ndarray:
    return values * np.log(np.maximum(values, 1))


# --- the model ---


@dataclass
class ClassModel:
    vocabulary: Vocabulary
    classes: Classes
    log_next: np.ndarray  #: log10 P(class | class before)
    log_room: np.ndarray  #: per class log10 of what counts in it are divided by
    log_end: float  #: log10 P(end | its class)
    end_count: int
    tokens: int
    log_base_room: float

    @classmethod
    def learn(cls, docs: DataFrame) -> tuple[ClassModel, DataFrame]:
        """The model, and the counts of the words that it does not hold."""
        counts = materialize(count_words(docs), "lm-counts")
        sums = counts.groupBy("ending").agg(F.count("*").alias("words"), F.sum("n").alias("n")).toPandas()
        vocabulary = Vocabulary.of(frequent_words(counts, HEAD_WORDS).toPandas())
        rare = counts.where(F.col("n") < (int(vocabulary.counts.min()) if len(vocabulary.counts) else 1 << 62))

        units = materialize(as_units(docs, vocabulary), "lm-units")
        pairs = count_pairs(units, vocabulary)
        # Each group of texts was counted with an end ahead of it: what follows an end is a text.
        end_count = int(pairs[:, END].sum())
        coarse = exchange_clusters(pairs)
        classes = Classes(coarse[vocabulary.symbols], coarse[:ENDINGS], int(coarse[END]))
        classes, after = exchange_words(
            units, vocabulary, classes, _by_class(pairs, coarse, CLASSES), vocabulary.counts >= LEAST_COUNT
        )

        # Tokens and different words of each class: of its words, of the endings of all others, of the end.
        tokens, kinds = np.zeros(ENDINGS), np.zeros(ENDINGS)
        tokens[sums["ending"]], kinds[sums["ending"]] = sums["n"], sums["words"]
        tokens -= np.bincount(vocabulary.endings, weights=vocabulary.counts, minlength=ENDINGS)
        kinds -= np.bincount(vocabulary.endings, minlength=ENDINGS)
        in_class, kinds_in_class = (
            np.bincount(classes.of_word, weights=of_words, minlength=CLASSES)
            + np.bincount(classes.of_ending, weights=of_endings, minlength=CLASSES)
            for of_words, of_endings in ((vocabulary.counts, tokens), (np.ones(len(vocabulary.counts)), kinds))
        )
        in_class[classes.of_end] += end_count
        kinds_in_class[classes.of_end] += end_count > 0
        room = in_class + DELTA * (kinds_in_class + 1)
        total = int(in_class.sum())
        share = (in_class + 0.5) / (total + 0.5 * CLASSES)
        following = (after + PRIOR * share) / (after.sum(1, keepdims=True) + PRIOR)
        distinct = int(kinds_in_class.sum())
        base_room = total + DELTA * (distinct + 1)
        own_room = room[classes.of_end]
        model = cls(
            vocabulary,
            classes,
            np.log10(following),
            np.log10(room),
            float(np.log10((end_count + DELTA) / own_room)),
            end_count,
            total,
            float(np.log10(base_room)),
        )
        return model, rare

    def score(self, texts: list[bytes]):
        """What a task knows of each text - tokens, known tokens, base and model log-probability - and
        the uses of words that it does not hold: (word, text, times). Their counts are still to be added to both."""
        words = split_words(texts)
        classes, places, unique, which, found = self.vocabulary.sequence(words, self.classes)
        gains = np.zeros(len(classes))
        gains[1:] = self.log_next[classes[:-1], classes[1:]]
        held = found >= 0
        counted = np.zeros(len(unique))
        counted[held] = np.log10(self.vocabulary.counts[found[held]] + DELTA)
        gains[places] += counted[which] - self.log_room[classes[places]]
        starts = words.first[:-1] + np.arange(len(texts)) + 1
        score = np.add.reduceat(gains, starts) + self.log_end
        sums = np.concatenate([[0], np.cumsum(counted[which])])
        known = np.concatenate([[0], np.cumsum(held[which])])[words.first]
        n_tokens = np.diff(words.first) + 1
        base = np.diff(sums[words.first]) + np.log10(self.end_count + DELTA) - n_tokens * self.log_base_room
        n_known = np.diff(known) + (self.end_count > 0)
        rare = np.flatnonzero(~held[which])
        use, times = np.unique(words.documents()[rare] * len(unique) + which[rare], return_counts=True)
        return n_tokens, n_known, base, score, (unique[use % max(len(unique), 1)], use // max(len(unique), 1), times)


def score_documents(docs: DataFrame, model: ClassModel, rare: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    parts = 8 * partitions(spark)
    shared = spark.sparkContext.broadcast(model)

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, gathered, held = TaskContext.get().partitionId() << 33, [], 0
        for ids, texts in batch_chunks(batches, TEXT_BYTES):
            n_tokens, n_known, base, score, (word, text, times) = shared.value.score(texts)
            rows = row + np.arange(len(ids))
            row += len(ids)
            gathered.append((word, rows[text], times))
            held += len(word)
            nothing = pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows),
                    pa.array(ids, pa.int64()),
                    *(pa.array(x.astype(np.int64)) for x in (n_tokens, n_known)),
                    pa.array(base),
                    pa.array(score),
                    pa.nulls(len(ids), pa.int32()),
                    nothing,
                    nothing,
                    nothing,
                ],
                schema=_local_schema(),
            )
            if held >= GATHERED:
                yield from _pieces(_by_part(gathered, parts))
                gathered, held = [], 0
        if held:
            yield from _pieces(_by_part(gathered, parts))

    scored = materialize(id_and_text(docs, id_col, text_col).mapInArrow(tidied(local), LOCAL_SCHEMA), "lm-local")
    texts = scored.where(F.col("part").isNull()).select("row", "doc_id", "n_tokens", "n_known", "base", "score")
    uses = scored.where(F.col("part").isNotNull()).select("part", "words", "rows", "times")
    keyed = rare.select(F.pmod("word", F.lit(parts)).cast("int").alias("part"), "word", "n")

    def add_counts(uses: pa.Table, counts: pa.Table) -> pa.Table:
        words, rows, times = (
            np.frombuffer(b"".join(uses.column(c).to_pylist()), np.int64) for c in ("words", "rows", "times")
        )
        known = counts.column("word").to_numpy()
        order = np.argsort(known)
        known, n = known[order], counts.column("n").to_numpy()[order]
        if len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            n = np.where(known[at] == words, n[at], 0)
        else:
            n = np.zeros(len(words))
        unique, which = np.unique(rows, return_inverse=True)
        added = np.bincount(which, weights=np.log10(n + DELTA) * times, minlength=len(unique)).astype(np.float64)
        known_tokens = np.bincount(which, weights=(n > 0) * times, minlength=len(unique))
        return pa.table({"row": unique, "added": added, "known": known_tokens.astype(np.int64)})

    added = (
        uses.groupBy("part")
        .cogroup(keyed.groupBy("part"))
        .applyInArrow(add_counts, "row bigint, added double, known bigint")
    )
    nothing = F.lit(None)
    both = texts.withColumns({"added": nothing.cast("double"), "known": nothing.cast("bigint")}).unionByName(
        added.select(
            "row",
            *(nothing.cast(t).alias(c) for c, t in texts.dtypes if c != "row"),
            "added",
            "known",
        )
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return both.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + total("known")).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.max("base") + total("added")).alias("base_score"),
        (F.max("score") + total("added")).alias("score"),
    ).drop("row")


def _local_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in LOCAL_SCHEMA.split(", "))])


def _by_part(gathered: list[tuple[np.ndarray, ...]], parts: int) -> pa.RecordBatch:
    """Uses of words, a row for each part of the shuffle."""
    words, rows, times = (np.concatenate(x) for x in zip(*gathered))
    numbers, columns = _packed(words.view(np.int64) % parts, words, rows, times)
    n = len(numbers)
    empty = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    return pa.RecordBatch.from_arrays(
        [*empty, pa.array(numbers.astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)],
        schema=_local_schema(),
    )


def _packed(part: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """The different parts, and for each column the bytes of its values in each of them."""
    order = np.argsort(part, kind="stable")
    numbers, first = np.unique(part[order], return_index=True)
    cuts = [*first.tolist(), len(order)]
    packed = []
    for column in columns:
        dealt = column[order]
        packed.append([dealt[a:b].tobytes() for a, b in zip(cuts, cuts[1:])])
    return numbers, packed


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about ``BATCH_BYTES`` at a time."""
    rows = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def training_documents(docs: DataFrame) -> DataFrame:
    return docs.where(crc_mod("doc_id", 10) != 0)


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model, rare = ClassModel.learn(training_documents(id_and_text(docs)))
    return score_documents(docs, model, rare).select(
        "doc_id",
        (crc_mod("doc_id", 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
