"""A small table with every odd case, and comparison of results."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(("river", "stone", "Cloud", "a", "winter.", "of", "old,", "über", "niño")) + str(rng.randrange(40)) for _ in range(n))


def make_rows() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows, personal data."""
    rng = random.Random(7)
    base = words_of(rng, 120).split(" ")
    passage = words_of(rng, 30)
    texts: list[str | None] = [None, "", " \n\t", "one", "two three", "two three", None]
    for k in range(12):
        edited = list(base)
        for _ in range(k // 3):
            edited[rng.randrange(len(edited))] = f"edit{k}"
        texts.append(" ".join(edited))
    texts += [" ".join(base)] * 3
    texts += [f"{words_of(rng, 20)} {passage} {words_of(rng, 20)}" for _ in range(6)]
    texts += [words_of(rng, n) for n in (4, 5, 6, 49, 50, 51, 200)]
    texts.append(words_of(rng, 30_000))
    texts.append("x" * 70_000)
    texts += [
        "Write to a.b+c@mail.example.com, or a@b.c%d@e.f now; 10.0.0.1 and 300.1.1.1 and 1.2.3.4.5.6.7.8",
        "Card 4111 1111 1111 1111 or 4111-1111-1111-1112, call +1 (212) 555-0100 or +12 or +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
        "é🙂 user@host.example 🙂 +49 30 1234567 8",
    ]
    texts += ["line of text that is common to very many documents of this small table\n" + words_of(rng, 12) for _ in range(5)]
    rows = [(i, t, ("en", "de", None)[i % 3], "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[20])
    rows.append((None, " ".join(base), "en", None, None))
    rows.append((None, None, None, None, None))
    return rows


def table(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
