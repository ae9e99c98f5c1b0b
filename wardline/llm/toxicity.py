"""Toxicity by compression: how much shorter a window gets with a dictionary of toxic text.

Dictionaries are made from a bounded sample of labelled documents (about
``SAMPLE_DOCS`` texts of each label, chosen by a hash of the id). Windows of two sizes are compressed.

Passages: windows of ``WINDOW_WORDS`` words, one from every ``WINDOW_STEP``-th word on, under two separate
dictionaries, one trained on passages of ordinary texts and one on passages of toxic texts. These find
what is toxic by the order of words that occur in ordinary text as well. The toxic dictionary learns from
one half of the sample's toxic texts, and calibration looks at the other half: a text knows its own passages.

Words: toxic words that stand one by one in ordinary prose drown in a longer window. A second toxic dictionary
continues the ordinary one with a list of words: those of toxic documents that begin like no ordinary words do,
judged by the documents that use such beginnings. A window is one word between two pieces of carrier text,
the first known to both dictionaries and
the other to none; without them zstandard would store it as it is. A worker compresses each
different word once.

The largest share that a window of the text saves is its evidence, one for each size. Its score is the share
of toxic documents among labelled ones with that evidence, made monotone and weighted back to the rate of
all labels; the larger of the two counts.

Defined cases: a null or empty text, and one without a word, has evidence 0. Documents without
a label and null labels teach nothing. Without toxic or without ordinary examples every score is 0.
Rows are independent, so very long texts, ties, repeated rows and null ids need no rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import batch_chunks, crc_mod, id_and_text, read_table
from wardline.llm.words import LOWER, Lookup, Words, split_words
from wardline.session import materialize

# Parameters of the model.
SAMPLE_DOCS = 4_000
PASSAGE_WORDS = 16
PASSAGES = 20_000
ORDINARY_BYTES = 14_000
TOXIC_BYTES = 2_048
CARRIER_BYTES = 24
LEVEL = 9
#: A toxic word has this many standard errors of contrast, and this share of the largest.
LEAST_CONTRAST = 6.0
CONTRAST_SHARE = 0.16
#: The beginnings of words that are compared besides whole words, in characters.
STEM_CHARS = (4, 5, 6, 7)
#: Two texts are taken for copies by runs of so many words.
COPY_WORDS = 5
#: How often one word counts in training at most.
REPEATS = 60

#: Evidence is the share of a window's compressed length that is saved, in this many steps.
STEPS = 20
LEAST_LENGTH = 6

#: Windows of passages; the pieces of a window of very long words are compressed one by one.
WINDOW_WORDS, WINDOW_STEP, WINDOW_BYTES = 8, 4, 512
WINDOW_LEVEL = 3
WINDOW_STEPS = 100

CUTOFF = 0.7
KEPT_WORDS = 1_000_000
LARGEST_WORD = 256


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes  #: the list of words
    ordinary_passages: bytes
    toxic_passages: bytes
    scores: np.ndarray = field(default_factory=lambda: np.zeros(1))  #: by evidence from 0 on
    passage_scores: np.ndarray = field(default_factory=lambda: np.zeros(1))
    _known: Lookup = field(default_factory=Lookup, repr=False)
    _gains: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64), repr=False)
    _pair: tuple | None = field(default=None, repr=False)
    _passage_pair: tuple | None = field(default=None, repr=False)
    _carrier: tuple[bytes, bytes] = field(default=(b"", b""), repr=False)
    _empty: list[int] = field(default_factory=list, repr=False)

    def __getstate__(self):
        kept = ("ordinary", "toxic", "ordinary_passages", "toxic_passages", "scores", "passage_scores")
        return {name: getattr(self, name) for name in kept}

    def __setstate__(self, state):
        self.__init__(**state)

    def evidence(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The largest saving of a word and of a passage in each text, at least 0."""
        words = split_words(texts)
        return self._word_evidence(words), self._passage_evidence(words)

    def _passage_evidence(self, words: Words) -> np.ndarray:
        if self._passage_pair is None:
            self._passage_pair = tuple(_compressor(c, WINDOW_LEVEL) for c in (self.ordinary_passages, self.toxic_passages))
        ordinary, toxic = self._passage_pair
        data = LOWER[words.data].tobytes()
        starts, ends, first = words.starts.tolist(), words.ends.tolist(), words.first.tolist()
        out = np.zeros(len(first) - 1, np.int64)
        for text, (low, high) in enumerate(zip(first, first[1:])):
            best = 0.0
            for word in range(low, max(high - WINDOW_STEP, low + 1) if high > low else low, WINDOW_STEP):
                begin, end = starts[word], ends[min(word + WINDOW_WORDS, high) - 1]
                for at in range(begin, max(end - WINDOW_BYTES // 2, begin + 1), WINDOW_BYTES // 2):
                    window = data[at : min(at + WINDOW_BYTES, end)]
                    length = len(ordinary.compress(window))
                    best = max(best, (length - len(toxic.compress(window))) / max(length, LEAST_LENGTH))
            out[text] = min(round(best * WINDOW_STEPS), WINDOW_STEPS)
        return out

    def _word_evidence(self, words: Words) -> np.ndarray:
        unique, sample, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self._known) + len(unique) > KEPT_WORDS:
            self._known, self._gains = Lookup(), np.zeros(0, np.int64)
        numbers = self._known.find(unique)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            gains = [self._gain(LOWER[words.data[words.starts[i] : words.ends[i]]].tobytes()) for i in sample[new].tolist()]
            self._known.add(unique[new])
            self._gains = np.concatenate([self._gains, gains])
            numbers[new] = self._known.find(unique[new])
        out = np.zeros(len(words.first) - 1, np.int64)
        filled = np.flatnonzero(np.diff(words.first))
        if len(filled):
            out[filled] = np.maximum.reduceat(self._gains[numbers[which]], words.first[:-1][filled])
        return np.maximum(out, 0)

    def score(self, evidence: np.ndarray, passages: np.ndarray) -> np.ndarray:
        by_word = self.scores[np.minimum(evidence, len(self.scores) - 1)]
        return np.maximum(by_word, self.passage_scores[np.minimum(passages, len(self.passage_scores) - 1)])

    def _gain(self, word: bytes) -> int:
        """The share of its length that a window saves with the toxic dictionary, in steps; the best of a long word's."""
        if self._pair is None:
            middle = len(self.ordinary) // 2
            carrier = self.ordinary[middle : middle + CARRIER_BYTES]
            self._carrier = carrier, carrier[::-1]
            self._pair = _compressor(self.ordinary), _compressor(self.ordinary + self.toxic)
            self._empty = [len(c.compress(b"%b  %b" % self._carrier)) for c in self._pair]
        first, last = self._carrier
        best = 0.0
        for at in range(0, len(word), LARGEST_WORD // 2):
            window = b"%b %b %b" % (first, word[at : at + LARGEST_WORD], last)
            ordinary, toxic = (len(c.compress(window)) - empty for c, empty in zip(self._pair, self._empty))
            best = max(best, (ordinary - toxic) / max(ordinary, LEAST_LENGTH))
            if at + LARGEST_WORD >= len(word):
                break
        return min(round(best * STEPS), 2 * STEPS)


def _compressor(content: bytes, level: int = LEVEL) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=dictionary, level=level, write_content_size=False, write_checksum=False)


def _trained(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary trained on the samples; the samples themselves if they are too few to train on."""
    try:
        content = zstandard.train_dictionary(2 * size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)
    return content[-size:]


# --- learning ---


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """Texts and labels of a bounded sample, and by label how many documents one of them stands for."""
    known = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000))
    weights = {label: max(1.0, n / SAMPLE_DOCS) for label, n in counts.items()}
    share = F.when(F.col("label") == 1, 1e6 / weights.get(1, 1.0)).otherwise(1e6 / weights.get(0, 1.0))
    # About 2 * SAMPLE_DOCS rows of two numbers.
    chosen = known.where(place < share).select("doc_id", "label").dropDuplicates(["doc_id"])
    words = F.array_distinct(F.filter(_words("text"), lambda w: w != ""))
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("all") - COPY_WORDS + 1, F.lit(1))),
        lambda i: F.xxhash64(F.slice("all", i, COPY_WORDS)),
    )
    # Copies would make words of one text look frequent: of texts that share their least run of words one is kept.
    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text", _words("text").alias("all"))
    texts = texts.withColumn("run", F.array_min(runs)).dropDuplicates(["run"])
    return materialize(texts.select("doc_id", "label", "text", words.alias("words")), "toxicity-sample"), weights


def _words(column: str) -> Column:
    return F.split(F.lower(column), r"[\x20\x09-\x0D]+")


def _toxic_words(sample: DataFrame) -> list[tuple[str, int]]:
    """Words of toxic documents whose beginning is significantly more frequent there than in
    ordinary documents, the most telling first, with the number of their toxic documents."""
    toxic, ordinary = (F.count(F.when(F.col("label") == label, 1)) for label in (1, 0))
    sizes = sample.agg(toxic.alias("toxic"), ordinary.alias("ordinary")).first()
    starts = F.array_distinct(
        F.flatten(F.transform("words", lambda w: F.array(w, *(F.substring(w, 1, n) for n in STEM_CHARS))))
    )
    counted = (
        sample.select("label", F.explode(starts).alias("stem"))
        .where(F.length("stem") >= min(STEM_CHARS))
        .groupBy("stem")
        .agg(toxic.alias("toxic"), ordinary.alias("ordinary"))
        .where("toxic > 1")
    )
    odds = F.log((F.col("toxic") + 0.2) / (sizes["toxic"] + 0.4)) - F.log(
        (F.col("ordinary") + 0.2) / (sizes["ordinary"] + 0.4)
    )
    rated = counted.select("stem", (odds * F.sqrt("toxic")).alias("contrast"))
    rated = rated.where(F.col("contrast") >= LEAST_CONTRAST)
    # A dictionary of TOXIC_BYTES holds no more stems than that.
    stems = {row["stem"]: row["contrast"] for row in rated.orderBy(F.desc("contrast"), "stem").limit(TOXIC_BYTES).collect()}
    least = max(stems.values(), default=0.0) * CONTRAST_SHARE
    telling = [stem for stem, contrast in stems.items() if contrast >= least]
    if not telling:
        return []
    begins = F.array(*(F.lit(stem) for stem in telling))
    found = (
        sample.where("label = 1")
        .select(F.explode("words").alias("word"))
        .where(F.exists(begins, lambda stem: F.startswith("word", stem)))
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"), "word")
        .limit(TOXIC_BYTES)
        .collect()
    )
    return [(row["word"], row["count"]) for row in found]


def _half() -> Column:
    """Whether a text of the sample teaches passages; the others calibrate them."""
    return F.pmod(F.xxhash64("doc_id", F.lit("passages")), F.lit(2)) == 0


def _passages(sample: DataFrame) -> list[bytes]:
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(PASSAGE_WORDS))
    passages = (
        sample.select(_words("text").alias("words"))
        .select("words", F.explode(starts).alias("start"))
        .select(F.concat_ws(" ", F.slice("words", F.col("start") + 1, PASSAGE_WORDS)).alias("passage"))
    )
    chosen = passages.orderBy(F.xxhash64("passage"), "passage").limit(PASSAGES)
    return [row["passage"].encode("utf-8") for row in chosen.collect()]


def learn_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """From documents (doc_id, text) and labels (doc_id, label); None without examples of both labels."""
    sample, weights = _sample(id_and_text(docs), labels)
    taught = {label: _passages(sample.where((F.col("label") == label) & _half())) for label in (0, 1)}
    passages = _passages(sample.where("label = 0"))
    if not taught[0] or not taught[1]:
        return None
    words = _toxic_words(sample)
    # Training looks at one stretch of the samples after another: each should hold all frequent words.
    toxic = [f" {word} ".encode() for turn in range(REPEATS) for word, n in reversed(words) if n > turn]
    model = ToxicityModel(
        _trained(passages, ORDINARY_BYTES),
        _trained(toxic, TOXIC_BYTES),
        *(_trained(taught[label], ORDINARY_BYTES) for label in (0, 1)),
    )

    counts = {0: np.zeros(2 * STEPS + 1), 1: np.zeros(2 * STEPS + 1)}
    unseen = {0: np.zeros(WINDOW_STEPS + 1), 1: np.zeros(WINDOW_STEPS + 1)}
    rows = _evidence(sample.select("doc_id", "text"), model).join(sample.select("doc_id", "label"), "doc_id")
    for row in rows.groupBy("label", "evidence", "passages", _half().alias("half")).count().collect():
        weight = row["count"] * weights[row["label"]]
        counts[row["label"]][row["evidence"]] += weight
        if not row["half"]:
            unseen[row["label"]][row["passages"]] += weight
    if words:
        model.scores = _monotone(counts[1], counts[0] + counts[1])
    model.passage_scores = _monotone(unseen[1], unseen[0] + unseen[1])
    return model


def _monotone(hits: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Shares that do not fall, by pooling neighbours; the base rate counts as half a case at each place."""
    rate = hits.sum() / max(totals.sum(), 1)
    blocks: list[list[float]] = []
    for hit, total in zip((hits + 0.5 * rate).tolist(), (totals + 0.5).tolist()):
        blocks.append([hit, total, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            hit, total, width = blocks.pop()
            blocks[-1] = [blocks[-1][0] + hit, blocks[-1][1] + total, blocks[-1][2] + width]
    return np.concatenate([np.full(int(width), hit / total) for hit, total, width in blocks])


# --- use ---


def _evidence(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in batch_chunks(batches):
            evidence, passages = shared.value.evidence(texts)
            score = shared.value.score(evidence, passages)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(evidence), pa.array(passages), pa.array(score)],
                names=["doc_id", "evidence", "passages", "score"],
            )

    return docs.mapInArrow(run, "doc_id bigint, evidence bigint, passages bigint, score double")


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, evidence (of its words), passages (evidence of these), score."""
    rows = id_and_text(docs, id_col, text_col)
    if model is None:
        return rows.select("doc_id", *(F.lit(0).cast("bigint").alias(c) for c in ("evidence", "passages")), F.lit(0.0).alias("score"))
    return _evidence(rows, model)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    model = learn_toxicity(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return score_toxicity(docs, model).select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )
