"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a string there is one piece that ends its encoding. The table holds that
piece: an automaton over all pieces names the candidates that end at a position, and a
candidate is the one if it is compatible with the last piece of the prefix before it, that
is, if the two stay apart when they are encoded as one string. The ids are then read off
backwards. Compatibility of two pieces is found out once by merging them and remembered.

A text is cut where no piece can reach across: between two characters that stand side by side
in no piece, which holds for whatever comes ahead of a blank. What lies between two cuts is
encoded once per worker and kept, as long as it is among the segments that most groups of texts have; the cuts of many texts are found and looked up at once.

Defined cases: a null or empty text has the end id alone and decodes to ''. Any other text,
however long, is encoded as a whole, blanks at its ends and line ends included. Characters
outside the vocabulary become byte pieces. Rows are independent, so repeated rows, null ids
and empty tables need no rule.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wardline.llm.common import batch_chunks, id_and_text, read_table, tidied
from wardline.llm.words import Lookup, ranges, span_hashes

# Fixed value: the character that stands for a blank.
BLANK = "\u2581"

# A worker keeps at most this many segments, and as many answers about pairs of pieces.
KEPT_SEGMENTS = 400_000
KEPT_PAIRS = 400_000
# Texts are encoded in groups of about this many bytes.
GROUP_BYTES = 2_000_000


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One per worker process and model file."""
    return PieceCodec(path)


class PieceCodec:
    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.end_id = model.eos_id()
        self._scores: dict[str, float] = {}
        self._ids: dict[str, int] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self._scores[piece], self._ids[piece] = model.get_score(i), i
        self._bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._texts = {i: piece.replace(BLANK, " ").encode() for piece, i in self._ids.items()}
        self._texts |= {i: bytes([b]) for b, i in enumerate(self._bytes)}
        self._side_by_side = {piece[i : i + 2] for piece in self._ids for i in range(len(piece) - 1)}
        self._automaton = ahocorasick.Automaton()
        # Characters count as pieces of their own: merging starts from them.
        for piece in self._ids.keys() | {c for piece in self._ids for c in piece}:
            self._automaton.add_word(piece, piece)
        self._automaton.make_automaton()
        self._compatible: dict[tuple[str, str], bool] = {}
        self._cut = self._cut_table()
        self._forget()

    def encode(self, text: str) -> list[int]:
        """Ids of a text without the end id."""
        digits, _, _, _ = self.encode_all([text.encode("utf-8")])
        return [int(i) for i in digits.split()]

    def decode(self, ids: list[int]) -> str:
        joined = b"".join([self._texts.get(i, b"") for i in ids])
        return joined.removeprefix(b" ").decode("utf-8", "replace")

    def encode_all(self, texts: list[bytes]) -> tuple[bytes, list[int], bytes, list[int]]:
        """Decimal ids of all texts, a blank after each, where each text starts in them, and the
        same for what the ids decode to, the blank ahead of each text included."""
        ahead = [b" " + t.replace(BLANK.encode(), b" ") if t else b"" for t in texts]
        data = np.frombuffer(b"\n".join([*ahead, b""]), np.uint8)
        limits = np.cumsum([0] + [len(t) + 1 for t in ahead])
        starts = np.concatenate([[0], 1 + np.flatnonzero(self._cut[data[:-1], data[1:]])])
        ends = np.append(starts[1:], len(data))
        separates = np.zeros(len(data), bool)
        separates[limits[1:] - 1] = True
        real = ~separates[starts]
        starts, ends = starts[real], ends[real]
        unique, sample, which = np.unique(
            span_hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True
        )
        if len(self._known) + len(unique) > KEPT_SEGMENTS:
            self._keep_frequent(KEPT_SEGMENTS // 2)
        numbers = self._known.find(unique)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            self._learn([data[starts[i] : ends[i]].tobytes() for i in sample[new].tolist()], unique[new])
            numbers[new] = self._known.find(unique[new])
        self._uses[numbers] += 1
        numbers = numbers[which]
        first = np.searchsorted(starts, limits)
        digits, digit_limits = self._digits.gather(numbers, first)
        decoded, text_limits = self._decoded.gather(numbers, first)
        return digits, digit_limits, decoded, text_limits

    def _cut_table(self) -> np.ndarray:
        """For two bytes whether no piece reaches across them; for parts of longer characters, only at blanks and line ends."""
        cut = np.zeros((256, 256), bool)
        signs = [BLANK if b == 0x20 else chr(b) for b in range(128)]
        for a in range(128):
            cut[a, :128] = [signs[a] + sign not in self._side_by_side for sign in signs]
        used = {c for pair in self._side_by_side for c in pair}
        ahead_of_blank = any(pair[1] == BLANK and not pair[0].isascii() and pair[0] != BLANK for pair in self._side_by_side)
        cut[128:, 0x20] = not ahead_of_blank
        cut[0x0A, :] = cut[:, 0x0A] = "\n" not in used
        return cut

    def _forget(self) -> None:
        self._known, self._digits, self._decoded = Lookup(), _Strings(), _Strings()
        #: How many groups of texts had each segment.
        self._uses = np.zeros(0, np.int32)

    def _keep_frequent(self, most: int) -> None:
        """Forget all but the segments that most groups of texts had; of these, half of the uses."""
        kept = np.sort(np.argsort(-self._uses, kind="stable")[:most])
        keys = np.empty(len(self._known), self._known.keys.dtype)
        keys[self._known.numbers] = self._known.keys
        self._known = Lookup()
        self._known.add(keys[kept])
        self._digits, self._decoded = self._digits.only(kept), self._decoded.only(kept)
        self._uses = self._uses[kept] // 2

    def _learn(self, segments: list[bytes], keys: np.ndarray) -> None:
        encoded = [self._encode_segment(s.decode("utf-8").replace(" ", BLANK)) for s in segments]
        self._known.add(keys)
        self._uses = np.concatenate([self._uses, np.zeros(len(keys), np.int32)])
        self._digits.extend([b"".join([b"%d " % i for i in ids]) for ids in encoded])
        self._decoded.extend([b"".join([self._texts[i] for i in ids]) for ids in encoded])

    def _encode_segment(self, segment: str) -> list[int]:
        beside, start, ids = self._side_by_side, 0, []
        for i in range(1, len(segment) + 1):
            if i == len(segment) or segment[i - 1 : i + 1] not in beside:
                ids += self._encode_joined(segment[start:i])
                start = i
        return ids

    def _encode_joined(self, string: str) -> list[int]:
        last: list[str | None] = [None] * (len(string) + 1)
        for end, piece in self._automaton.iter(string):
            start = end + 1 - len(piece)
            if last[end + 1] is None and self._fits(last[start] if start else "", piece):
                last[end + 1] = piece
        at, pieces = len(string), []
        while at:
            piece = last[at] or string[at - 1]
            pieces.append(piece)
            at -= len(piece)
        return [i for piece in reversed(pieces) for i in self._id(piece)]

    def _id(self, piece: str) -> list[int]:
        known = self._ids.get(piece)
        return [known] if known is not None else [self._bytes[b] for b in piece.encode("utf-8")]

    def _fits(self, before: str | None, piece: str) -> bool:
        if before is None:
            return False
        fits = self._compatible.get((before, piece))
        if fits is None:
            fits = self._merge(before + piece) == ([before, piece] if before else [piece])
            if len(self._compatible) >= KEPT_PAIRS:
                self._compatible.clear()
            self._compatible[before, piece] = fits
        return fits

    def _merge(self, string: str) -> list[str]:
        """Merge the best neighbours, the leftmost of equals, until none are left."""
        parts = list(string)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class _Strings:
    """Byte strings in one buffer, by number."""

    def __init__(self):
        self._data = np.zeros(0, np.uint8)
        self._starts = self._lengths = np.zeros(0, np.int64)

    def extend(self, strings: list[bytes]) -> None:
        lengths = np.array([len(s) for s in strings], np.int64)
        self._starts = np.concatenate([self._starts, len(self._data) + np.cumsum(lengths) - lengths])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._data = np.concatenate([self._data, np.frombuffer(b"".join(strings), np.uint8)])

    def only(self, numbers: np.ndarray) -> _Strings:
        """The strings with these numbers, renumbered in that order."""
        out = _Strings()
        out._lengths = self._lengths[numbers]
        out._starts = np.cumsum(out._lengths) - out._lengths
        out._data = self._data[ranges(self._starts[numbers], out._lengths)]
        return out

    def gather(self, numbers: np.ndarray, first: np.ndarray) -> tuple[bytes, list[int]]:
        """The strings with these numbers, joined, and where the first-th of them start."""
        lengths = self._lengths[numbers]
        joined = self._data[ranges(self._starts[numbers], lengths)].tobytes()
        return joined, np.concatenate([[0], np.cumsum(lengths)])[first].tolist()


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of each whole text, the end id last, and the text that they decode to: doc_id, ids, decoded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for ids, found in _encoded(batches, pieces):
            numbers = [[int(i) for i in digits.split()] + [pieces.end_id] for digits, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(numbers, pa.list_(pa.int32())),
                    pa.array([text.decode("utf-8") for _, text in found], pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), "doc_id bigint, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_documents``, but counts and digests in the place of ids and texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        end = b"%d" % pieces.end_id
        for ids, found in _encoded(batches, pieces):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([digits.count(b" ") + 1 for digits, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(digits + end).hexdigest() for digits, _ in found]),
                    pa.array([hashlib.sha256(text).hexdigest() for _, text in found]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        tidied(run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _encoded(batches, pieces):
    """Per group of texts their ids and (decimal ids, decoded text) pairs."""
    for ids, texts in batch_chunks(batches, GROUP_BYTES):
        digits, digit_at, decoded, text_at = pieces.encode_all(texts)
        yield (
            ids,
            [
                (digits[a:b], decoded[c:d].removeprefix(b" "))
                for a, b, c, d in zip(digit_at, digit_at[1:], text_at, text_at[1:])
            ],
        )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
