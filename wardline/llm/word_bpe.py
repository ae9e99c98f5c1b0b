"""Token ids of whole texts by a public word-level BPE tokenizer, with the ids of known words kept.

The tokenizer looks at no more than the run of characters between two pieces of ASCII white
space, so a text is encoded run by run, a closing full stop or comma apart. Runs that a worker
has met before are looked up, all runs of a group of texts at once.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from wardline.llm.words import Lookup, Words, ranges, split_words

# A worker keeps the ids of at most this many runs, about 40 bytes each.
KEPT_RUNS = 600_000

END_OF_WORD = "</w>"


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per worker process and tokenizer file."""
    return WordEncoder(path)


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        #: Little-endian type of an id in a file: two bytes if all ids fit.
        self.id_type = "<u2" if size <= 65536 else "<u4"
        self._ends_word = np.zeros(size, bool)
        self._ends_word[[i for t, i in self._tokenizer.get_vocab().items() if t.endswith(END_OF_WORD)]] = True
        self._forget()

    def _forget(self) -> None:
        self._known = Lookup()
        self._ids = np.zeros(0, self.id_type)
        self._starts = self._counts = np.zeros(0, np.int64)

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, joined, and where each text starts in them (one more than texts)."""
        # The tokenizer ignores case, except in the marks that it knows as special tokens.
        marked = any(b"<|" in t for t in texts)
        words = split_words(texts, lower=not marked, marks=not marked)
        unique, sample, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self._known) + len(unique) > KEPT_RUNS:
            self._forget()
        numbers = self._known.find(unique)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            self._learn(words, unique[new], sample[new])
            numbers[new] = self._known.find(unique[new])
        numbers = numbers[which]
        counts = self._counts[numbers]
        ids = self._ids[ranges(self._starts[numbers], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[words.first]

    def _learn(self, words: Words, keys: np.ndarray, samples: np.ndarray) -> None:
        runs = [words.text(i).decode("utf-8") for i in samples.tolist()]
        plain = np.fromiter(map(str.isalpha, runs), bool, len(runs))
        pieces, counts, order, others = [], [], [], np.flatnonzero(~plain).tolist()
        # Runs of letters only are one word each: encoded in one go, told apart by their last pieces.
        plain = np.flatnonzero(plain)
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096].tolist()
            ids = self._encode(" ".join([runs[i] for i in part]))
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            if len(ends) == len(part):
                pieces.append(ids)
                counts.append(np.diff(ends, prepend=0))
                order += part
            else:
                others += part
        for i in others:
            pieces.append(self._encode(runs[i]))
            counts.append([len(pieces[-1])])
        counts = np.concatenate(counts).astype(np.int64)
        self._known.add(keys[np.array(order + others, np.int64)])
        self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(counts) - counts])
        self._counts = np.concatenate([self._counts, counts])
        self._ids = np.concatenate([self._ids, *pieces])

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self.id_type)
