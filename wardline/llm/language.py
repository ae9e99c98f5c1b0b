"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

One model per language value, learned from a bounded sample of labelled documents
(``SAMPLE_DOCS`` per language in expectation, whole texts, chosen by a hash of the id). The
n-grams lie within a word and the blanks around it, so the log-probability of a text is the
sum over its words, and a worker scores each different word once. Words without a letter say
nothing and are left out. The lowest cross-entropy per character wins. A text is rejected if
even the lowest is nearer to that of evenly drawn characters than to the median of the
language's own sample, and above the 99.9 % quantile of the sample. Every language with a labelled
document is learned; one with fewer than ``FEW_DOCS`` knows its own sample by heart and takes the
widest limit of all. Per language only its own n-grams are stored.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and rejected.
Unseen characters get the uniform share of the lowest order. Ties go to the language that
sorts first. Rows are independent, so very long texts, repeated rows and null ids need no
rule; without any labelled document everything is ``und``, and ``accepted`` keeps all rows. Labels are read for learning only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import CHUNK_BYTES, batch_chunks, chunks, crc_mod, filter_texts, id_and_text, prepare, read_table, text_bytes, tidied
from wardline.llm.words import U64, Lookup, mix, ranges, split_words
from wardline.session import materialize

# Parameters of the model.
ORDER = 4
SAMPLE_DOCS = 1_500
# Languages with fewer documents in the sample than this are not judged by the sample's entropies.
FEW_DOCS = 5
# The score compares languages by their probability of this many characters of the text.
SCORE_CHARS = 20

UNDECIDED = "und"
KEPT_WORDS = 1_000_000
# Numbers that a table of words or characters by languages may hold.
CELLS = 2_000_000
NGRAM_SCHEMA = "lang string, size int, key bigint, tail bigint, head bigint, opens boolean, n bigint"


# --- n-grams of words ---


@dataclass
class Letters:
    """The characters of words as one array, a blank ahead of each word and after the last."""

    values: np.ndarray  #: code points
    blank: np.ndarray  #: for each character the place of the blank ahead of its word

    @classmethod
    def of(cls, words: list[str]) -> Letters:
        joined = " ".join(["", *words, ""]).encode("utf-32-le", "surrogatepass")
        values = np.frombuffer(joined, "<u4").astype(U64)
        # A word holds no blank: the runs it comes from are cut at white space.
        places = np.where(values == 32, np.arange(len(values)), 0)
        before = np.concatenate([[0], np.maximum.accumulate(places)[:-1]])
        return cls(values, before)

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the n-gram that ends at each character, and whether it lies in the word."""
        spread, total = mix(self.values + U64(1)), np.zeros(len(self.values), U64)
        for back in range(size):
            total[back:] += spread[: len(spread) - back] * U64(pow(0x9E3779B97F4A7C15, back + 1, 1 << 64))
        inside = np.arange(len(self.values)) - self.blank >= size - 1
        inside[0] = False
        return mix(total + U64(size)), inside


def _ngram_counts(words: list[str], counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, ...]]:
    """Per size: the n-grams of the words with their tail and head (one character less) and counts."""
    letters = Letters.of(words)
    word_of = np.cumsum(letters.values == 32) - 1
    word_of = np.where(letters.values == 32, word_of - 1, word_of)
    shorter = None
    for size in range(1, ORDER + 1):
        keys, inside = letters.keys(size)
        at = np.flatnonzero(inside)
        unique, sample, which = np.unique(keys[at], return_index=True, return_inverse=True)
        total = np.bincount(which, weights=counts[word_of[at]], minlength=len(unique)).astype(np.int64)
        at = at[sample]
        nothing = np.zeros(len(at), U64)
        tail, head = (shorter[at], shorter[at - 1]) if size > 1 else (nothing, nothing)
        yield size, unique, tail, head, letters.values[at - size + 1] == 32, total
        shorter = keys


def _runs(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Different words in lower case, which word each run is, the hash of each word, and where texts start."""
    words = split_words(texts)
    unique, sample, which = np.unique(words.hashes, return_index=True, return_inverse=True)
    return words, unique, sample, which


# --- learning ---


def _sample(docs: DataFrame) -> DataFrame:
    """Labelled documents, about ``SAMPLE_DOCS`` of each language, by a hash of the id."""
    labelled = docs.where(F.col("lang").isNotNull())
    counts = labelled.groupBy("lang").agg((SAMPLE_DOCS * 1_000_000 / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    chosen = labelled.join(F.broadcast(counts), "lang").where(place < F.col("share"))
    return materialize(chosen.select(*labelled.columns), "lang-sample")


def _count_ngrams(sample: DataFrame) -> DataFrame:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = text_bytes(batch.column("text"))
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for _, part in chunks(own, own):
                    words, _, first, which = _runs(part)
                    if not len(first):
                        continue
                    strings = [words.text(i).decode("utf-8").lower() for i in first.tolist()]
                    for size, key, tail, head, opens, n in _ngram_counts(strings, np.bincount(which)):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(key), pa.string()),
                                pa.array(np.full(len(key), size, np.int32)),
                                *(pa.array(x.view(np.int64)) for x in (key, tail, head)),
                                pa.array(opens),
                                pa.array(n),
                            ],
                            names=["lang", "size", "key", "tail", "head", "opens", "n"],
                        )

    counted = sample.select("lang", "text").mapInArrow(tidied(count), NGRAM_SCHEMA)
    return counted.groupBy("lang", "size", "key", "tail", "head", "opens").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModels:
    """The models of all languages: per n-gram size sorted hashes, and under each the languages that have it."""

    languages: list[str]
    keys: list[np.ndarray]
    first: list[np.ndarray]  #: per size where the entries of each n-gram start, and their number at the end
    column: list[np.ndarray]  #: of each entry its language
    log_p: list[np.ndarray]  #: of each entry
    log_rest: list[np.ndarray]  #: what a context leaves to the next smaller size; 0 where it is none
    first_rest: np.ndarray
    log_uniform: float
    limits: np.ndarray = field(default_factory=lambda: np.zeros(0))  #: cross-entropy above which a text is rejected
    _known: Lookup = field(default_factory=Lookup, repr=False)
    _sums: np.ndarray | None = field(default=None, repr=False)
    _chars: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def learn(cls, counts) -> LanguageModels:
        """From the columns of ``_count_ngrams``: discounted counts, interpolated down to uniform."""
        languages = sorted(set(counts["lang"]))
        sizes = [counts[counts["size"] == size] for size in range(1, ORDER + 1)]
        column = [s["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.int64) for s in sizes]
        raw = [{c: s[c].to_numpy(np.int64).view(U64) for c in ("key", "tail", "head")} for s in sizes]
        keys = [np.unique(r["key"]) for r in raw]
        uniform = 1.0 / (len(keys[0]) + 1)
        # An entry is an n-gram of a language, in the order of these numbers.
        width = len(languages)
        codes = [np.searchsorted(k, r["key"]) * width + c for k, r, c in zip(keys, raw, column)]
        entries = [np.unique(c) for c in codes]
        log_p = [np.zeros(len(e)) for e in entries]
        log_rest = [np.zeros(len(e)) for e in entries]
        first_rest = np.zeros(width)
        for size in range(ORDER):
            rows, lang = raw[size], column[size]
            own = np.searchsorted(entries[size], codes[size])
            n = sizes[size]["n"].to_numpy(np.float64)
            if size + 1 < ORDER:
                # Below the largest size an n-gram counts once for each character seen ahead of it.
                tails = np.searchsorted(keys[size], raw[size + 1]["tail"]) * width + column[size + 1]
                ahead = np.bincount(np.searchsorted(entries[size], tails), minlength=len(entries[size]))
                n = np.where(sizes[size]["opens"].to_numpy(bool), n, np.maximum(ahead[own], 1))
            if size:
                # A language that has an n-gram has its head and its tail as well.
                heads = np.searchsorted(keys[size - 1], rows["head"]) * width + lang
                context, contexts = np.searchsorted(entries[size - 1], heads), len(entries[size - 1])
            else:
                context, contexts = lang, width
            total = np.bincount(context, weights=n, minlength=contexts)
            kinds = np.bincount(context, minlength=contexts)
            once = np.bincount(lang[n == 1], minlength=width)
            twice = np.bincount(lang[n == 2], minlength=width)
            discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
            whose = entries[size - 1] % width if size else np.arange(width)
            rest = np.divide(discount[whose] * kinds, total, out=np.ones(contexts), where=total > 0)
            if size:
                tails = np.searchsorted(keys[size - 1], rows["tail"]) * width + lang
                below = np.exp(log_p[size - 1][np.searchsorted(entries[size - 1], tails)])
                log_rest[size - 1] = np.log(rest)
            else:
                below, first_rest = uniform, np.log(rest)
            p = np.maximum(n - discount[lang], 0) / total[context] + rest[context] * below
            log_p[size][own] = np.log(p)
        first = [np.searchsorted(e, np.arange(len(k) + 1) * width) for e, k in zip(entries, keys)]
        return cls(languages, keys, first, [e % width for e in entries], log_p, log_rest, first_rest, float(np.log(uniform)))

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word and the blank after it, in each language."""
        out, block = [np.zeros((0, len(self.languages)))], max(1, CELLS // len(self.languages))
        low, ends = 0, self._blanks(words)
        while low < len(words):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + block, "right")) - 1)
            # A blank that starts the array says nothing: with an empty word ahead, all words have one that does.
            sums = np.cumsum(self.character_scores(["", *words[low:high]]), axis=0)
            out.append(np.diff(sums[ends[low : high + 1] - ends[low] + 1], axis=0))
            low = high
        return np.concatenate(out)

    @staticmethod
    def _blanks(words: list[str]) -> np.ndarray:
        return np.cumsum([0, *(len(w) + 1 for w in words)])

    def character_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of each character of the words, a blank ahead of each and after the last."""
        letters = Letters.of(words)
        p = np.full((len(letters.values), len(self.languages)), self.log_uniform) + self.first_rest
        shorter = None
        for size in range(1, ORDER + 1):
            keys, inside = letters.keys(size)
            table = self.keys[size - 1]
            at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
            found = np.where(inside & (table[at] == keys), at, -1)
            if size > 1:
                context = np.concatenate([[-1], shorter[:-1]])
                known = np.flatnonzero(inside & (context >= 0))
                at, entry = self._entries(size - 2, known, context[known])
                p[at, self.column[size - 2][entry]] += self.log_rest[size - 2][entry]
            here = np.flatnonzero(found >= 0)
            at, entry = self._entries(size - 1, here, found[here])
            p[at, self.column[size - 1][entry]] = self.log_p[size - 1][entry]
            shorter = found
        p[0] = 0
        return p

    def _entries(self, size: int, at: np.ndarray, ngrams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of n-grams, and for each the one of ``at`` that it belongs to."""
        low = self.first[size][ngrams]
        n = self.first[size][ngrams + 1] - low
        return np.repeat(at, n), ranges(low, n)

    @property
    def chunk_bytes(self) -> int:
        """Texts that are judged together: their words by languages take a bounded table."""
        return max(1, min(CHUNK_BYTES, 4 * CELLS // len(self.languages)))

    def entropies(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the cross-entropy per character in each language, and whether it has a letter."""
        words, unique, sample, which = _runs(texts)
        kept = min(KEPT_WORDS, CELLS // len(self.languages))
        if self._sums is None or len(self._known) + len(unique) > kept:
            self._known, self._sums, self._chars = Lookup(), np.zeros((0, len(self.languages))), np.zeros((0, 2))
        numbers = self._known.find(unique)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            strings = [words.text(i).decode("utf-8").lower() for i in sample[new].tolist()]
            self._known.add(unique[new])
            has_letter = np.array([any(map(str.isalpha, s)) for s in strings], float)[:, None]
            lengths = np.array([len(s) + 1 for s in strings], float)[:, None]
            self._sums = np.concatenate([self._sums, self.score_words(strings) * has_letter])
            self._chars = np.concatenate([self._chars, np.hstack([lengths * has_letter, has_letter])])
            numbers[new] = self._known.find(unique[new])
        numbers = numbers[which]
        sums = _sums_between(self._sums[numbers], words.first)
        chars = _sums_between(self._chars[numbers], words.first)
        return -sums / np.maximum(chars[:, :1], 1), chars[:, 1] > 0


def _sums_between(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows from one start to the next."""
    out = np.zeros((len(first) - 1, rows.shape[1]))
    filled = np.flatnonzero(np.diff(first))
    if len(filled):
        out[filled] = np.add.reduceat(rows, first[:-1][filled], axis=0)
    return out


def learn_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModels | None:
    """Models from labelled documents; None if there are none to learn from."""
    labelled = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(lang_col).alias("lang"),
    )
    prepare(docs.sparkSession)
    sample = _sample(labelled)
    counts = _count_ngrams(sample).toPandas()
    if not len(counts):
        return None
    models = LanguageModels.learn(counts)
    sampled = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    fitted = identify(sample.select("doc_id", "text"), models).where(F.col("lang_pred") != UNDECIDED)
    quantiles = {
        r["lang_pred"]: r["q"]
        for r in fitted.groupBy("lang_pred").agg(F.percentile_approx("entropy", [0.5, 0.999], 10_000).alias("q")).collect()
    }
    enough = {lang: q for lang, q in quantiles.items() if sampled.get(lang, 0) >= FEW_DOCS}
    widest = max(enough.values(), default=[-models.log_uniform] * 2)
    chosen = [enough.get(lang, widest) for lang in models.languages]
    limits = np.array([max(high, (middle - models.log_uniform) / 2) for middle, high in chosen])
    few = [lang not in enough for lang in models.languages]
    models.limits = np.where(few, limits.max(), limits)
    return models


# --- use ---

RESULT_SCHEMA = "doc_id bigint, lang_pred string, score double, entropy double, rejected boolean"


def identify(docs: DataFrame, models: LanguageModels | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, entropy (nats per character), rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for ids, texts in batch_chunks(batches, models.chunk_bytes if models else CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *_judge(models, texts)], names=RESULT_NAMES)

    return id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), RESULT_SCHEMA)


RESULT_NAMES = ["doc_id", "lang_pred", "score", "entropy", "rejected"]


def _judge(models: LanguageModels | None, texts: list[bytes]) -> list[pa.Array]:
    if models is None:
        n = len(texts)
        return [pa.array([UNDECIDED] * n), pa.array(np.zeros(n)), pa.array([None] * n, pa.float64()), pa.array([True] * n)]
    entropy, has_letter = models.entropies(texts)
    best = np.argmin(entropy, axis=1)
    lowest = entropy[np.arange(len(texts)), best]
    odds = np.exp(-SCORE_CHARS * (entropy - lowest[:, None]))
    score = np.where(has_letter, 1 / odds.sum(axis=1), 0.0)
    limits = models.limits if len(models.limits) else np.full(len(models.languages), np.inf)
    names = np.array([*models.languages, UNDECIDED], object)[np.where(has_letter, best, len(models.languages))]
    return [
        pa.array(names.tolist(), pa.string()),
        pa.array(score),
        pa.array(lowest, mask=~has_letter),
        pa.array(~has_letter | (lowest > limits[best])),
    ]


def accepted(docs: DataFrame, models: LanguageModels | None, text_col: str = "text") -> DataFrame:
    """The rows whose language is accepted, all columns as they are; all rows if there is no model to judge by."""
    if models is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def keeps(texts: list[bytes]) -> np.ndarray:
        judged = [_judge(shared.value, part)[-1] for _, part in chunks(texts, texts, shared.value.chunk_bytes)]
        return ~pa.concat_arrays(judged).to_numpy(zero_copy_only=False)

    return filter_texts(docs, text_col, keeps)


def learned_documents(docs: DataFrame) -> DataFrame:
    """Documents that the models may learn from."""
    return docs.where(crc_mod("doc_id", 4) != 2)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    models = learn_languages(learned_documents(docs))
    return identify(docs, models).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )
