"""Operators that look at one text at a time, next to the libraries or to plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm.samples import table
from pyspark.sql import functions as F

from wardline.llm import crc32c, personal, piece_bpe, records, words
from wardline.llm.word_bpe import WordEncoder

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [
    "a", "The", "É", "é.", "..", ",", "x.", "1.", "'s", " ", "  ", "\n", "\t", "<|endoftext|>", "<|ENDOFTEXT|>", "×.",
    "ñ,", "́", "ß", "中.", "\xa0", "İ", "ΑΣ", "▁", "ing", "tion", "----", "<0x0A>", "</s>", "\x00", "🙂", "    ",
]


def strings(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 20))) for _ in range(n)]


def test_words_are_runs_between_ascii_white_space():
    texts = ["", " a  b\tÄb\x0bC ", " x", "\n"]
    found = words.split_words([t.encode() for t in texts])
    assert [found.text(i).decode() for i in range(len(found.hashes))] == ["a", "b", "Äb", "C", " x"]
    assert found.first.tolist() == [0, 0, 4, 5, 5]
    same = words.split_words([b"Abc abc ABC abd"]).hashes
    assert len(set(same[:3].tolist())) == 1 and same[3] != same[0]


def test_crc32c_matches_known_and_bitwise_values():
    def slow(data: bytes) -> int:
        register = 0xFFFFFFFF
        for byte in data:
            register ^= byte
            for _ in range(8):
                register = (register >> 1) ^ (0x82F63B78 if register & 1 else 0)
        return register ^ 0xFFFFFFFF

    data = [b"123456789", b"", *(random.Random(n).randbytes(n) for n in (1, 255, 256, 257, 1000))]
    assert crc32c.crc32c(data).tolist() == [slow(d) for d in data]
    assert crc32c.crc32c([b"123456789"]).tolist() == [0xE3069283]


def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(WORD_FILE), WordEncoder(WORD_FILE)
    texts = strings(1500, 1)
    ids, limits = own.encode_all([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert ids[limits[i] : limits[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_piece_codec_equals_the_library():
    from sentencepiece import SentencePieceProcessor

    library, own = SentencePieceProcessor(model_file=PIECE_FILE), piece_bpe.PieceCodec(PIECE_FILE)
    for text in strings(1500, 2):
        ids = library.encode(text)
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids), text


def test_a_codec_that_forgets_encodes_as_before(monkeypatch):
    from sentencepiece import SentencePieceProcessor

    monkeypatch.setattr(piece_bpe, "KEPT_SEGMENTS", 120)
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, codec = SentencePieceProcessor(model_file=path), piece_bpe.PieceCodec(path)
    for group in range(20):
        texts = [f"of the same words {group * 7 + i} Wort{group}x{i} naïve\n" for i in range(12)]
        digits, at, decoded, text_at = codec.encode_all([t.encode() for t in texts])
        for text, a, b, c, d in zip(texts, at, at[1:], text_at, text_at[1:]):
            ids = library.encode(text)
            assert [int(i) for i in digits[a:b].split()] == ids and decoded[c:d].removeprefix(b" ").decode() == library.decode(ids)


def test_piece_encoding_round_trip(docs, rows, nothing, clashing):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECE_FILE)
    wanted = sorted(
        ((i, library.encode(t or "") + [2], library.decode(library.encode(t or ""))) for i, t, *_ in rows), key=str
    )
    assert table(piece_bpe.encode_documents(docs, PIECE_FILE)) == wanted
    digests = table(piece_bpe.digest_documents(clashing, PIECE_FILE, "id", "body"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert digests == sorted(((i, len(n), sha(" ".join(map(str, n))), sha(d)) for i, n, d in wanted), key=str)
    assert piece_bpe.encode_documents(nothing, PIECE_FILE).isEmpty()


def test_records_read_back_what_was_encoded(spark, docs, rows, nothing, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_FILE)
    path = str(tmp_path / "records")
    index = records.write_records(docs, path, WORD_FILE, end_id=2)
    read = records.read_records(index.repartition("file"), path).collect()
    found = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in read), key=str)
    assert found == sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, *_ in rows), key=str)
    # Some records, in any order, by the index alone.
    some = index.where("n_tokens > 20").orderBy(F.desc("n_tokens")).limit(3)
    assert records.read_records(some, path).count() == 3
    starts = index.join(records.part_starts(index), "part").selectExpr("doc_id", "part_start + tokens_before as start", "n_tokens")
    at = 0
    for row in sorted(starts.collect(), key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    ids = [r.doc_id for r in sorted(starts.collect(), key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    empty = records.write_records(nothing, str(tmp_path / "none"), WORD_FILE, end_id=2)
    assert empty.isEmpty() and records.part_starts(empty).isEmpty()


def test_a_damaged_record_is_an_error(docs, tmp_path):
    path = str(tmp_path / "records")
    index = records.write_records(docs.limit(5).coalesce(1), path, WORD_FILE, end_id=2)
    for file in (tmp_path / "records" / "data").iterdir():
        data = bytearray(file.read_bytes())
        data[14] ^= 1
        file.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        records.read_records(index, path).collect()


# The kinds, as they are described.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str) -> list[tuple]:
    def luhn(digits: str) -> bool:
        doubled = [int(d) * 2 - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
        return sum(doubled) % 10 == 0

    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def personal_texts() -> list[str]:
    rng = random.Random(3)
    parts = ["a@b.c", "%d@e.f-g.h", "@", ".", "1.2.3.4", "255.0.0.256", "4111 1111 1111 1111", "-", " ", "+1", "(212) ",
             "555-0100", "+49 30 123456", "00", "é", "🙂", "12345678901234", "x", "_", "5"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(400)] + ["1 " * 20_000, "a." * 20_000 + "@b.c", "a@b" + ".c" * 20_000]


def test_base_spans_equal_leftmost_matches(spark, docs, rows, nothing, clashing):
    texts = personal_texts()
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in personal.find_personal_data(made).collect():
        assert [(s.kind, s.start, s.end) for s in row.base] == base_spans(texts[row.doc_id]), texts[row.doc_id][:80]
    found = personal.find_personal_data(clashing, "id", "body").collect()
    assert sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.base]) for r in found) == sorted(
        (str(i), base_spans(t or "")) for i, t, *_ in rows
    )
    assert personal.find_personal_data(nothing).isEmpty()


def test_terms_that_stand_by_one_entity_are_removed(spark):
    told = [f"{'lorem ipsum dolor ' * k}Ask Marlowe at pm@example.com, {'sit amet ' * k}" for k in range(1, 5)]
    other = [f"lorem ipsum dolor sit amet number {k}" for k in range(40)]
    found = personal.find_personal_data(spark.createDataFrame(list(enumerate(told + other)), "doc_id bigint, text string"))
    clean = {r.doc_id: r.text for r in personal.sanitise(found).collect()}
    assert all("Marlowe" not in clean[k] and "[EMAIL]" in clean[k] and "lorem" in clean[k] for k in range(4))
    assert clean[10] is None


def test_terms_disclose_wherever_they_stand_in_the_document(spark):
    """Terms that are far from the entity, short, repeated or in base spans, next to counts by brute force."""
    rng = random.Random(11)
    filler = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "of"]) for _ in range(n))
    texts = [f"Dear Marlowe, {filler(60)}\nyours, Marlowe Bo\n{filler(40)}\npm@example.com" for _ in range(5)]
    texts += [f"{filler(9)} tell q{'abc'[k % 3]}@host.example {filler(50)} Vimes, Quill" for k in range(9)]
    texts += [texts[-1]] * 3 + [f"Zorn, once {filler(20)} zorn@z.example"] * 4 + [filler(rng.randint(1, 60)) for _ in range(60)]
    texts += ["Bo elsewhere", "Quill by itself", "quill again"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in personal.find_personal_data(made).collect()}
    entities = [{s.value for s in found[d].base} for d in range(len(texts))]

    def places(d: int) -> list[tuple]:
        spans = [(s.start, s.end) for s in found[d].base]
        matches = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]+", texts[d])]
        return [m for m in matches if not any(a < m[1] and b > m[0] for a, b in spans)]

    terms = [{t for *_, t in places(d)} for d in range(len(texts))]
    n_t, n_e = Counter(t for own in terms for t in own), Counter(e for own in entities for e in own)
    n_te, support = Counter(), {}
    for text, own, es in zip(texts, terms, entities):
        for pair in {(t, e) for t in own for e in es}:
            n_te[pair] += 1
            support.setdefault(pair, set()).add(text)
    disclosing = {
        (t, e)
        for (t, e), n in n_te.items()
        if len(support[t, e]) >= personal.LEAST_DOCUMENTS
        and math.log(len(texts) * n / (n_t[t] * n_e[e])) >= personal.DISCLOSED * math.log(len(texts) / n_e[e])
    }
    assert ("marlowe", "pm@example.com") in disclosing and ("zorn", "zorn@z.example") not in disclosing
    alone = Counter(t for t, _ in disclosing)
    for d in range(len(texts)):
        wanted = [
            (a, b, personal.REMOVED if alone[t] == 1 else personal.GENERALISED)
            for a, b, t in places(d)
            if any((t, e) in disclosing for e in entities[d])
        ]
        assert [(s.start, s.end, s.value) for s in found[d].added] == wanted, texts[d]
    clean = {r.doc_id: r.text for r in personal.sanitise(personal.find_personal_data(made)).collect()}
    assert "Marlowe" not in clean[0] and "[EMAIL]" in clean[0]


def test_digest_columns_follow_from_the_ids(docs, rows):
    from sentencepiece import SentencePieceProcessor

    ids = SentencePieceProcessor(model_file=PIECE_FILE).encode(rows[8][1]) + [2]
    row = piece_bpe.digest_documents(docs.where("doc_id = 8"), PIECE_FILE).first()
    assert row.n_tokens == len(ids)
