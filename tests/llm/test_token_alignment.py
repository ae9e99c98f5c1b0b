"""Token alignment next to the libraries' tokens of whole texts, walked token by token."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.samples import SCHEMA, table

from wardline.llm import token_alignment as alignment

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]

ODD = [
    None, "", " ", "  ", "a", "\n", "\n\n", " \n", "a\n", "a \n b", "a  b", "x  y", "é b", "É.\nb", "a▁b", "▁",
    "<|endoftext|> </s> <s>", "\x00 a\x00", "日本語 テキスト", "a　 b", "🙂 🙂x", "x" * 7000, "a\r\nb", "tab\tb \t c", "’ a",
    "it's 12 34,5", "a " * 3000, "\u0085 a\u0085 b", "﻿a b", "a​ b", "\x1f a\x1f b", "a\x7f b", " '", "  x  y",
]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATHS[1])


def spans(ids: list[int], spelled: list[bytes]) -> list[tuple[int, int, int]]:
    ends = np.cumsum([0, *map(len, spelled)]).tolist()
    return list(zip(ends, ends[1:], ids))


def by_hand(libraries, text: str | None):
    """Spans of both sides, links and groups, or None for a text without tokens."""
    a, b = libraries
    if not text:
        return None
    signs = alignment._byte_signs()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelled_a = [bytes(signs[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [(i, b.id_to_piece(i)) for i in ids_b]
    spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
    if not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode():
        return None
    spans_a, spans_b = spans(ids_a, spelled_a), spans(ids_b, spelled_b)
    links, low = [], 0
    for start, end, x in spans_a:
        while spans_b[low][1] <= start:
            low += 1
        at = low
        while at < len(spans_b) and spans_b[at][0] < end:
            links.append((x, spans_b[at][2]))
            at += 1
    cuts = sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b})
    groups = [
        "|".join(",".join(str(x) for s, e, x in side if low <= s and e <= high) for side in (spans_a, spans_b))
        for low, high in zip([0, *cuts], cuts)
    ] if len(cuts) < 500 else None
    return ids_a, ids_b, links, groups, len(cuts)


def expected(libraries, rows: list[tuple]) -> list[tuple]:
    found = [(doc_id, by_hand(libraries, text)) for doc_id, text in rows]
    counts = Counter(link for _, f in found if f for link in f[2])
    highest: dict[int, int] = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for doc_id, f in found:
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[link] == highest[link[1]] for link in f[2])
        groups = None if f[3] is None else hashlib.sha256(";".join(f[3]).encode()).hexdigest()
        out.append((doc_id, len(f[0]), len(f[1]), f[4], len(f[2]), best, sum(counts[link] for link in f[2]), groups))
    return out


def compare(found: list[tuple], wanted: list[tuple]) -> None:
    """Groups of very long texts are not built by hand."""
    key = lambda r: str(r[:7])
    found, wanted = sorted(found, key=key), sorted(wanted, key=key)
    assert [r[:7] for r in found] == [r[:7] for r in wanted]
    assert all(w[7] is None or f[7] == w[7] for f, w in zip(found, wanted))


def test_whole_table(spark, rows, libraries, tmp_path):
    """The query over odd rows, repeated rows, null ids and columns with names of its own."""
    rows = [*rows, *((1000 + i, t, None, None, None) for i, t in enumerate(ODD))]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as pairs", "'x' as groups")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = table(alignment.op12_token_alignment(spark, str(tmp_path)).select(*names))
    wanted = expected(libraries, [r[:2] for r in rows])
    compare(found, wanted)


@pytest.mark.parametrize("frequent", [0, 40])
def test_counts_of_seldom_pairs_come_by_join(spark, libraries, frequent):
    rows = [(i, f"the cat {i} sat über {'Häuser ' * (i % 4)}") for i in range(30)] + [(None, "the cat")] * 3
    linked = alignment.linked_pairs(spark.createDataFrame(rows, "doc_id bigint, text string"), *PATHS)
    pairs = alignment.count_pairs(linked)
    found = table(alignment.link_scores(linked, pairs, frequent_pairs=frequent).drop("row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ))
    compare(found, expected(libraries, rows))


def test_groups_as_text(spark, libraries, nothing):
    texts = [(1, "Unbelievable tokenisation, naïve!"), (2, None), (3, "a▁b")]
    found = table(alignment.align_documents(spark.createDataFrame(texts, "doc_id bigint, text string"), *PATHS))
    by_text = by_hand(libraries, texts[0][1])
    assert found[0] == (1, len(by_text[0]), len(by_text[1]), by_text[4], len(by_text[2]), ";".join(by_text[3]))
    assert [r[1:] for r in found[1:]] == [(0, 0, 0, 0, "")] * 2
    linked = alignment.linked_pairs(nothing, *PATHS)
    assert alignment.link_scores(linked, alignment.count_pairs(linked)).isEmpty()


def test_a_full_store_forgets_what_is_seldom(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_BYTES", 6_000)
    aligner = alignment.Aligner(*PATHS)
    for part in range(12):
        texts = [f"the same words again {part * 50 + i} Wort{part}x{i}" for i in range(50)]
        numbers, first, tallies = aligner.align([t.encode() for t in texts])
        for text, spelled, tally in zip(texts, aligner.spellings(numbers, first), tallies.tolist()):
            wanted = by_hand(libraries, text)
            assert spelled.decode() == ";".join(wanted[3]) and tally == [len(wanted[0]), len(wanted[1]), wanted[4], len(wanted[2])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30))
def test_overlaps(sizes_a, sizes_b):
    """Two documents of the same tokens; tokens beyond the shorter side are left out."""
    size = min(sum(sizes_a), sum(sizes_b))
    frames, spans_of = [], []
    for sizes in (sizes_a, sizes_b):
        starts = [s for s in np.cumsum([0, *sizes[:-1]]).tolist() if s < size]
        ends = [*starts[1:], size]
        spans_of.append([(d, d * size + s, d * size + e) for d in (0, 1) for s, e in zip(starts, ends)])
        frames.append(pd.DataFrame({"document": [s[0] for s in spans_of[-1]], "start": [s[1] for s in spans_of[-1]]}))
    a, b = alignment.overlaps(*frames)
    wanted = [
        (i, j)
        for i, (d, low, high) in enumerate(spans_of[0])
        for j, (e, start, end) in enumerate(spans_of[1])
        if d == e and low < end and start < high
    ]
    assert list(zip(a.tolist(), b.tolist())) == wanted
